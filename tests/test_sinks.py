import datetime as dt

import pytest
from pyspark.sql import functions as F

from vaultspark.operators import ods
from vaultspark.plans import pipeline
from vaultspark.sources import schemas
from vaultspark.sources.sinks import PARTITION_COLUMN, Warehouse


def test_static_overwrite_clears_partition_with_empty_batch(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    schema = pipeline._with_part(schemas.ODS_ISSUE)
    wh.create_if_missing("ods_issue", schema, PARTITION_COLUMN)
    rows = [("5", dt.datetime(2014, 3, 1), dt.datetime(2014, 3, 1, 1), "error", "{}", "svc1")]
    stg = spark.createDataFrame(rows, schemas.STG_ISSUE)
    wh.overwrite_partition("ods_issue", "2014", ods.ods_issue(stg, 2014))
    wh.overwrite_partition("ods_issue", "2014", ods.ods_issue(stg, 2014))  # rerun: replaced, not doubled
    assert wh.read("ods_issue", schema).count() == 1
    empty = stg.limit(0)
    wh.overwrite_partition("ods_issue", "2014", ods.ods_issue(empty, 2014))
    assert wh.read("ods_issue", schema).where("part = '2014'").count() == 0


def test_partition_read_prunes(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    schema = pipeline._with_part(schemas.ODS_ISSUE)
    rows = [("5", dt.datetime(y, 3, 1), dt.datetime(y, 3, 1, 1), "error", "{}", "svc1") for y in (2013, 2014)]
    stg = spark.createDataFrame(rows, schemas.STG_ISSUE)
    for y in (2013, 2014):
        wh.overwrite_partition("ods_issue", str(y), ods.ods_issue(stg, y))
    df = pipeline.ods_slice(wh, "issue", 2014)
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "part" in plan


def test_full_load_routes_every_label(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    rows = [("1", dt.datetime(y, 1, 1), None, "t", "d", "s") for y in (1999, 2005, 2013, 2031)]
    pipeline.load_ods_full(wh, {"issue": spark.createDataFrame(rows, schemas.STG_ISSUE)}, "issue")
    labels = sorted(r[0] for r in wh.read("ods_issue").select(PARTITION_COLUMN).collect())
    assert labels == ["2013", "badyear", "badyear", "before_2013"]


def test_append_create_and_write_once(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    s = schemas.hub_schema("user")
    assert wh.create_if_missing("hub_user", s)
    assert not wh.create_if_missing("hub_user", s)
    assert wh.read("hub_user", s).count() == 0
    row = spark.createDataFrame([("pk", "1", dt.datetime(2013, 1, 1), "X")], s)
    wh.append("hub_user", row)
    wh.append("hub_user", row)
    assert wh.read("hub_user", s).count() == 2
    assert wh.write_once("ods_user", row) and not wh.write_once("ods_user", row)


def test_register_source_only_once(spark, tmp_path):
    from vaultspark.sources import readers

    p = str(tmp_path / "payment")
    spark.createDataFrame([], schemas.STG_PAYMENT).write.parquet(p)
    name = "stg_payment_test"
    assert readers.register_source(spark, name, p, schemas.STG_PAYMENT)
    assert not readers.register_source(spark, name, p, schemas.STG_PAYMENT)
    assert spark.table(name).columns == [f.name for f in schemas.STG_PAYMENT.fields]
    spark.sql(f"DROP TABLE {name}")


def test_validation_batches(spark, tmp_path):
    from vaultspark.sources import readers

    p = str(tmp_path / "b")
    df = spark.range(2000).withColumnRenamed("id", "a")
    df.write.parquet(p)
    assert readers.batch_from_path(spark, p).count() == 2000
    assert readers.batch_from_dataframe(df) is df
    assert readers.limit_batch(df, 1000).count() == 1000
    assert readers.batch_from_query(spark, "select 1 as x").count() == 1
    df.createOrReplaceTempView("batch_view")
    assert readers.batch_from_table(spark, "batch_view").count() == 2000


def test_results_are_kept(spark, tmp_path):
    from vaultspark.operators import quality as Q

    wh = Warehouse(spark, str(tmp_path))
    df = spark.createDataFrame([(1,)], "a int")
    res = Q.validate(df, "s", [{"expectation_type": Q.NOT_NULL, "kwargs": {"column": "a"}}], "r1",
                     dt.datetime(2021, 1, 1))
    Q.store_results(wh, res)
    Q.store_results(wh, res)  # the same run again: replaced as a unit
    assert Q.stored_results(wh).collect() == res.collect()
    other = Q.validate(df, "s", [{"expectation_type": Q.NOT_NULL, "kwargs": {"column": "a"}}] * 2, "r/2 =",
                       dt.datetime(2021, 1, 2))
    Q.store_results(wh, other.unionByName(Q.validate(df, "t", [], "r1")))
    assert Q.stored_results(wh).count() == 3 and Q.stored_results(wh, run_name="r/2 =").count() == 2
    Q.store_results(wh, other.limit(1))
    assert Q.stored_results(wh, run_name="r/2 =").count() == 1 and Q.stored_results(wh, run_name="r1").count() == 1
    assert wh.names() == ["validation_results"] or not [n for n in wh.names() if n.startswith("_")]


def test_bucketed_hub_is_read_without_shuffle(spark, tmp_path):
    from vaultspark.operators import vault

    wh = Warehouse.for_vault(spark, str(tmp_path), n=4)
    s = schemas.hub_schema("account")
    rows = [(f"{i:032x}", str(i), dt.datetime(2013, 1, 1), "X") for i in range(50)]
    wh.create_if_missing("hub_account", s)
    wh.append("hub_account", spark.createDataFrame(rows[:30], s))
    hub = wh.read("hub_account", s)
    new = spark.createDataFrame(rows, s)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = vault.new_hub_rows(new, "ACCOUNT_PK", "ACCOUNT_KEY", hub)
        assert out.count() == 20
        plan = out._jdf.queryExecution().executedPlan().toString()
        scan = [ln for ln in plan.split("\n") if "FileScan" in ln and "vs_" in ln]
        assert scan and "Bucketed: true" in scan[0]
        wh.append("hub_account", out)
        # a fresh warehouse object over the same root re-attaches the table
        again = Warehouse.for_vault(spark, str(tmp_path), n=4)
        spark.sql(f"DROP TABLE {again.table_name('hub_account')}")  # drop catalog entry only (external)
        assert again.read("hub_account", s).count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_backfill_equals_yearly_reloads(spark, tmp_path):
    from conftest import SF_SMALL
    from vaultspark.sources import fixtures

    raw = fixtures.raw_sources(spark, SF_SMALL)
    years = [2013, 2014, 2016]
    one = Warehouse(spark, str(tmp_path / "yearly"))
    for y in years:
        pipeline.load_ods(one, raw, y)
    two = Warehouse(spark, str(tmp_path / "backfill"))
    # a stale row in a backfilled year must disappear, as with the static reload
    two.create_if_missing("ods_issue", pipeline._with_part(schemas.ODS_ISSUE), PARTITION_COLUMN)
    stale = [("1", dt.datetime(2013, 5, 5), None, "t", "d", "s")]
    two.overwrite_partition("ods_issue", "2013", ods.ods_issue(spark.createDataFrame(stale, schemas.STG_ISSUE)))
    pipeline.load_ods_backfill(two, raw, years)
    for src in ("billing", "issue", "payment", "traffic"):
        schema = pipeline._with_part(schemas.ODS[src])
        a = sorted(map(tuple, one.read(f"ods_{src}", schema).collect()), key=repr)
        b = sorted(map(tuple, two.read(f"ods_{src}", schema).collect()), key=repr)
        assert a == b, src


def _forget(spark, wh, name):
    spark.sql(f"DROP TABLE {wh.table_name(name)}")  # the catalog entry only (external)


def test_bucket_number_is_kept_with_the_table(spark, tmp_path):
    import pytest

    from vaultspark.operators import vault

    s = schemas.hub_schema("account")
    rows = spark.createDataFrame([(f"{i:032x}", str(i), dt.datetime(2013, 1, 1), "X") for i in range(500)], s)
    first = Warehouse.for_vault(spark, str(tmp_path), n=8)
    first.create_if_missing("hub_account", s)
    first.append("hub_account", rows)
    for _ in range(2):  # reopened by sessions that would choose 4: read, rerun and append keep all keys once
        _forget(spark, first, "hub_account")
        again = Warehouse.for_vault(spark, str(tmp_path), n=4)
        again.append("hub_account", rows.limit(0))
        hub = again.read("hub_account", s)
        assert hub.select("ACCOUNT_PK").distinct().count() == 500
        assert vault.new_hub_rows(rows, "ACCOUNT_PK", "ACCOUNT_KEY", hub).count() == 0
        assert again.bucket_count("hub_account") == 8
    _forget(spark, first, "hub_account")
    spark.sql(f"CREATE TABLE {first.table_name('hub_account')} (ACCOUNT_PK string) USING parquet "
              f"CLUSTERED BY (ACCOUNT_PK) INTO 4 BUCKETS LOCATION '{tmp_path}/hub_account'")
    with pytest.raises(ValueError, match="number of buckets"):
        again.append("hub_account", rows)
    _forget(spark, first, "hub_account")


def test_remains_of_a_killed_write_are_no_table(spark, tmp_path):
    wh = Warehouse.for_vault(spark, str(tmp_path), n=4)
    for name in ("ods_user", "hub_account", "ods_issue"):
        (tmp_path / name / "_temporary" / "0").mkdir(parents=True)
        assert not wh.exists(name)
    s = schemas.hub_schema("account")
    row = spark.createDataFrame([("pk", "1", dt.datetime(2013, 1, 1), "X")], s)
    assert wh.write_once("ods_user", row) and wh.read("ods_user").count() == 1
    assert wh.create_if_missing("hub_account", s) and wh.create_if_missing("ods_issue", schemas.ODS_ISSUE)
    wh.append("hub_account", row)
    assert wh.read("hub_account", s).count() == 1 and not wh.create_if_missing("hub_account", s)
    _forget(spark, wh, "hub_account")


def test_shared_folder_of_another_default_file_system_is_qualified(spark):
    from vaultspark.sources.sinks import qualified

    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = conf.get("fs.defaultFS")
    assert qualified(spark, "/user/x") == "/user/x" and qualified(spark, "s3a://b/x") == "s3a://b/x"
    try:
        conf.set("fs.defaultFS", "hdfs://127.0.0.1:9")
        assert qualified(spark, "/user/x") == "hdfs://127.0.0.1:9/user/x"
        assert qualified(spark, "file:/mnt/shared") == "/mnt/shared"
    finally:
        conf.set("fs.defaultFS", old)


@pytest.mark.parametrize("atomic", [False, True])
def test_hash_keys_take_half_their_hex_on_disk(spark, tmp_path, atomic):
    wh = Warehouse.for_vault(spark, str(tmp_path), n=2, atomic=atomic)
    rows = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("PAYMENT_PK"), F.lit("2013").alias(PARTITION_COLUMN))
    wh.append("link_payment", rows)  # bucketed
    wh.append("plain", rows)
    wh.replace("replaced", rows)
    wh.write_once("once", rows)
    wh.overwrite_partition("one_year", "2013", rows)
    wh.overwrite_partitions("all_years", rows)
    for name in ("link_payment", "plain", "replaced", "once", "one_year", "all_years"):
        size = sum(f.stat().st_size for folder in tmp_path.glob(f"{name}*") for f in folder.rglob("*.parquet"))
        assert 0 < size < 0.75 * 32 * rows.count(), name
        assert wh.read(name).count() == rows.count()
