"""Plans and stored states of the yearly loads: what is exchanged, what is read, what is kept."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vaultspark.operators import marts, quality, vault
from vaultspark.plans import pipeline
from vaultspark.plans import queries as Q
from vaultspark.sources import fixtures, schemas
from vaultspark.sources.sinks import Warehouse


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    """Shuffles of a plan text, from the top."""
    return re.findall(r"Exchange (\w+partitioning\([^)]*\))", plan)


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n in names:
        spark.conf.unset(n)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Two years of the feeds with quirks, staging of the second kept in tables."""
    wh = Warehouse.for_vault(spark, str(tmp_path_factory.mktemp("plans")), n=4)
    feeds = fixtures.quirk_sources(spark, SF_SMALL)
    for y in (2013, 2014):
        pipeline.run_year(spark, wh, feeds, y, build_marts=False)
    return wh


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# -- link and hubs --------------------------------------------------------------------

def test_a_link_batch_is_exchanged_once(spark, loaded, no_broadcast):
    """By the link key: DISTINCT, anti join with the bucketed link and the bucketed write stand on it."""
    staged = loaded.read("mv_payment_2014")
    new = vault.link_payment_rows(staged, loaded.read("link_payment", schemas.LINK_PAYMENT))
    plan = executed(new.repartition(4, "PAYMENT_PK"))
    assert "LeftAnti" in plan and "Bucketed: true" in plan
    assert [e for e in exchanges(plan)] == [e for e in exchanges(plan) if e.startswith("hashpartitioning(PAYMENT_PK")]
    assert len(exchanges(plan)) == 1, plan
    assert "partial_collect_set" in plan


def test_nothing_is_sorted_below_the_first_exchange_of_a_hub(spark, loaded):
    staged = loaded.read("mv_payment_2014")
    plan = executed(vault.hub_rows("user", [staged, loaded.read("mv_billing_2014")]))
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "HashAggregate" in below and "Sort" not in below


# -- satellites -----------------------------------------------------------------------

def test_history_meets_the_batch_before_its_first_aggregate(spark, loaded, no_broadcast):
    sat = loaded.read("sat_payment", schemas.SAT_PAYMENT)
    states, last = pipeline.known_states(loaded, "sat_payment", sat, 2015)
    assert last == 2014
    new = vault.sat_payment_rows(loaded.read("mv_payment_2014"), states, as_of=dt.datetime(2015, 1, 1))
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    semi = plan.index("Join LeftSemi")
    # the plan is a tree: the aggregates of the states are above the semi join, only its key side has one below
    assert "max(LOAD_DATE" in plan[:semi] and "max(LOAD_DATE" not in plan[semi:].split("Relation")[0]


def test_a_bloom_filter_of_the_batch_keys_reaches_the_history(spark, loaded, no_broadcast):
    names = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
             "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        history = vault.history_as_of(loaded.read("sat_payment", schemas.SAT_PAYMENT), dt.datetime(2015, 1, 1),
                                      loaded.read("mv_payment_2014"), "PAYMENT_PK")
        assert "might_contain" in history._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for n in names:
            spark.conf.unset(n)


def test_files_of_a_satellite_hold_ranges_of_its_key(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
        wh.append("sat", df, cluster_by=["k", "v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = sorted(wh.read("sat").groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
                   .select("lo", "hi").collect())
    assert len(spans) > 1 and all(a.hi <= b.lo for a, b in zip(spans, spans[1:]))


def full_latest(wh, name, year):
    schema, _, _, pk, hd = pipeline.SATS[name]
    return rows(vault.latest_states(vault.history_as_of(wh.read(name, schema), dt.datetime(year, 1, 1)), pk, hd))


def test_chain_of_states_equals_the_history_and_stays_small(spark, tmp_path, monkeypatch):
    """Loads, a rerun, an older year again, a lost version: the chain always gives the history's latest states,
    and holds at most one base and the open deltas."""
    monkeypatch.setattr(pipeline, "OPEN_DELTAS", 2)
    wh = Warehouse.for_vault(spark, str(tmp_path), n=4)
    feeds = fixtures.quirk_sources(spark, SF_SMALL)
    name = "sat_user"
    schema, _, _, pk, hd = pipeline.SATS[name]
    pipeline.load_ods_backfill(wh, feeds, range(2013, 2019))

    def load(year):
        stg = pipeline.load_staging(wh, year, pipeline.load_date_of(year))
        before = wh.read(name, schema) if wh.exists(name) else None
        old = before.collect() if before is not None else []
        expected = vault.sat_user_rows(stg["payment"], spark.createDataFrame(old, schema), as_of=pipeline.load_date_of(year))
        want = sorted(map(tuple, [*old, *expected.collect()]), key=repr)
        pipeline.load_sat(wh, name, stg["payment"], pipeline.load_date_of(year))
        assert rows(wh.read(name, schema)) == want, year
        states, _ = pipeline.known_states(wh, name, wh.read(name, schema), year + 1)
        got = rows(vault.latest_states(vault.history_as_of(states, pipeline.load_date_of(year)), pk, hd))
        assert got == full_latest(wh, name, year)
        lschema = pipeline._latest_schema(pk, hd)
        bases = pipeline._versions(wh, f"{name}_base", lschema)
        deltas = pipeline._versions(wh, f"{name}_latest", lschema)
        assert len(bases) <= 1 and len(deltas) <= 2
        return bases, deltas

    assert load(2013) == ([], [2013])
    assert load(2014) == ([], [2013, 2014])
    assert load(2015) == ([2015], [])
    assert load(2016) == ([2015], [2016])
    assert load(2016) == ([2015], [2016])  # a rerun
    wh.drop_partitions(f"{name}_latest", ["2016"], column=pipeline.VERSION)  # a crash before the delta was written
    assert load(2017) == ([2015], [2017])
    assert load(2014) == ([], [2014])  # an older year again: its version rests on the history
    load(2018)


def test_keys_travel_as_bytes_and_come_back(spark):
    from vaultspark.functions.hashing import packed, unpacked

    texts = ["", "a", "0" * 32, "0" * 31, "A" * 32, "a" * 32, "g" * 32, "\u00e9" * 32, "\0" * 16, None, "d41d8cd98f00b204e9800998ecf8427e"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed("t").alias("p"))
    got = df.select("t", "p", unpacked("p").alias("u")).collect()
    assert all(r.t == r.u for r in got) and len({bytes(r.p) for r in got if r.p is not None}) == len(texts) - 1
    assert {len(r.p) for r in got if r.t in ("0" * 32, "a" * 32)} == {16}


def test_rows_of_ordinary_keys_are_exchanged_once(spark, monkeypatch):
    """Only a large key is cut into segments; the result is that of a plain lag."""
    monkeypatch.setattr(vault, "LEAST_PIECE", 20)
    plain = spark.range(400).select((F.col("id") % 40).cast("string").alias("k"), (F.col("id") % 7).alias("d"),
                                    F.col("id").alias("t"), (F.col("id") % 3).alias("v"))
    hot = plain.unionByName(plain.withColumn("k", F.lit("hot")).withColumn("t", F.col("t") + 1000))
    monkeypatch.setattr(vault, "KEY_SHARES", 1)
    got = vault.collapse_repeats(plain, "k", "v", ["d", "t"])
    assert len(exchanges(executed(got))) == 1
    for df in (plain, hot):
        assert rows(vault.collapse_repeats(df, "k", "v", ["d", "t"])) == rows(vault._collapse_in_one(df, "k", "v", ["d", "t"]))
    assert "_b0" in executed(vault.collapse_repeats(hot, "k", "v", ["d", "t"]))


def test_states_of_ordinary_keys_are_merged_in_one_exchange(spark, no_broadcast, monkeypatch):
    """By the key, for both maxima; a large key's states stay spread.  The result is that of ``latest_states``."""
    monkeypatch.setattr(vault, "LEAST_PIECE", 20)
    monkeypatch.setattr(vault, "KEY_SHARES", 1)
    day = F.make_date(2013 + (F.col("id") % 5).cast("int"), F.lit(1), F.lit(1)).cast("timestamp_ntz")
    plain = spark.range(400).select(F.when(F.col("id") % 41 > 0, (F.col("id") % 41).cast("string")).alias("k"),
                                    F.when(F.col("id") % 37 > 0, (F.col("id") % 3).cast("string")).alias("h"),
                                    F.when(F.col("id") % 31 > 0, day).alias("LOAD_DATE"))
    hot = plain.unionByName(plain.withColumn("k", F.lit("hot")))
    assert len(exchanges(executed(vault.merged_states(plain, "k", "h")))) == 1
    for df in (plain, hot, plain.limit(0), plain.where("k = '7'")):
        assert rows(vault.merged_states(df, "k", "h")) == rows(vault.latest_states(df, "k", "h", with_load_date=True))
    assert "LeftSemi" in executed(vault.merged_states(hot, "k", "h"))


def test_tables_hold_repeated_texts_by_their_length(spark, loaded):
    """The user keys of neighbouring staged rows repeat; pages of the second version store no byte of a repeat."""
    import pyarrow.parquet as pq
    from pathlib import Path

    for name in ("mv_payment_2014", "sat_payment", "link_payment"):
        files = [f for f in Path(loaded.path(name)).glob("*.parquet") if pq.ParquetFile(f).metadata.num_rows]
        metas = [pq.ParquetFile(f).metadata for f in files]
        keys = {m.row_group(0).column(m.schema.names.index("PAYMENT_PK")).encodings for m in metas}
        assert files and all("DELTA_BYTE_ARRAY" in k or "RLE_DICTIONARY" in k for k in keys), keys


def test_rows_of_a_satellite_are_exchanged_for_distinct_and_anti_join_together(spark, loaded, no_broadcast):
    sat = loaded.read("sat_payment", schemas.SAT_PAYMENT)
    plan = executed(vault.sat_payment_rows(loaded.read("mv_payment_2014"), sat, as_of=dt.datetime(2014, 1, 1)))
    assert not [e for e in exchanges(plan) if "pay_doc_num" in e]


def test_rows_of_a_satellite_are_written_into_it_only(spark, loaded):
    assert [n for n in loaded.names() if "_new" in n] == []
    for name, (schema, *_) in pipeline.SATS.items():
        assert loaded.read(name).columns == schema.names
        assert loaded.read(name).select("LOAD_DATE").distinct().count() >= 1


def test_users_are_packed_in_the_sums_of_a_year(spark, loaded, no_broadcast):
    sums = marts.user_year_sums(loaded.read("link_payment", schemas.LINK_PAYMENT), loaded.read("sat_payment", schemas.SAT_PAYMENT),
                                loaded.read("hub_billing_period", schemas.hub_schema("billing_period")))
    plan = executed(sums)
    assert plan.index("unhex(USER_PK") > plan.index("Exchange hashpartitioning(USER_PK")  # the tree is read from its top
    assert {len(r.USER_PK) for r in sums.select("USER_PK").distinct().collect()} == {32}


def test_marts_without_any_payment(spark, tmp_path):
    feeds = fixtures.quirk_sources(spark, SF_SMALL)
    for atomic in (False, True):
        wh = Warehouse.for_vault(spark, str(tmp_path / str(atomic)), n=2, atomic=atomic)
        pipeline.run_year(spark, wh, {**feeds, "payment": feeds["payment"].where("pay_doc_num < 0")}, 2013)
        assert wh.read("report_tmp", schemas.REPORT).count() == 0


def test_a_dynamic_overwrite_tells_its_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "2013"), (2, "2014")], "a int, part string")
    for atomic in (False, True):
        wh = Warehouse(spark, str(tmp_path / str(atomic)), atomic=atomic)
        assert wh.overwrite_partitions("t", df) == {"2013", "2014"}
        assert wh.overwrite_partitions("t", df.where("a = 2")) == {"2014"}
        assert wh.overwrite_partitions("t", df.where("a = 3")) == set()


# -- marts ----------------------------------------------------------------------------

def test_payments_are_never_exchanged_on_billing_periods(spark, loaded, no_broadcast):
    df = marts.payment_report(loaded.read("link_payment", schemas.LINK_PAYMENT), loaded.read("sat_payment", schemas.SAT_PAYMENT),
                              loaded.read("hub_billing_period", schemas.hub_schema("billing_period")),
                              loaded.read("hub_user", schemas.hub_schema("user")), loaded.read("ods_user", schemas.ODS_USER), order=False)
    plan = executed(df)
    assert not [e for e in exchanges(plan) if "BILLING_PERIOD_PK" in e] and "BroadcastHashJoin" in plan


def test_periods_beyond_the_bound_join_by_a_shuffle(spark, loaded, monkeypatch):
    args = (loaded.read("link_payment", schemas.LINK_PAYMENT), loaded.read("sat_payment", schemas.SAT_PAYMENT),
            loaded.read("hub_billing_period", schemas.hub_schema("billing_period")))
    want = rows(marts.user_year_sums(*args))
    monkeypatch.setattr(marts, "PERIODS_MAX", 1)
    assert rows(marts.user_year_sums(*args)) == want


def test_report_from_deltas_equals_a_rebuild_after_a_rerun(spark, tmp_path):
    wh = Warehouse.for_vault(spark, str(tmp_path), n=4)
    feeds = fixtures.quirk_sources(spark, SF_SMALL)
    late = {**feeds, "payment": feeds["payment"].where("pay_doc_num % 10 <> 3")}

    def same():
        pipeline.load_marts(wh)
        whole = marts.payment_report(wh.read("link_payment", schemas.LINK_PAYMENT), wh.read("sat_payment", schemas.SAT_PAYMENT),
                                     wh.read("hub_billing_period", schemas.hub_schema("billing_period")),
                                     wh.read("hub_user", schemas.hub_schema("user")), wh.read("ods_user", schemas.ODS_USER))
        assert rows(wh.read("report_tmp", schemas.REPORT)) == rows(whole)
    pipeline.run_year(spark, wh, late, 2013, build_marts=False)
    pipeline.run_year(spark, wh, feeds, 2014, build_marts=False)
    same()
    before = wh.read("dim_legal_type").collect()
    pipeline.run_year(spark, wh, feeds, 2013, build_marts=False)  # the late payments come in
    assert wh.partitions(pipeline.REPORT_STATE, pipeline.STATE_YEAR) == ["2014"]  # not counted until the next marts
    same()
    assert sorted(wh.partitions(pipeline.REPORT_STATE, pipeline.STATE_YEAR)) == ["2013", "2014"]
    pipeline.load_marts(wh, keep_ids=True)
    after = {r.legal_type_key: r.id for r in wh.read("dim_legal_type").collect()}
    assert all(after[r.legal_type_key] == r.id for r in before)


def test_a_year_of_traffic_reads_one_partition(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path))
    feeds = fixtures.quirk_sources(spark, SF_SMALL)
    for y in (2013, 2014):
        pipeline.run_hive_year(spark, wh, feeds, y)
    seen = []
    keep = marts.traffic_mart
    monkeypatch.setattr(marts, "traffic_mart", lambda df: seen.append(df) or keep(df))
    pipeline.run_hive_year(spark, wh, {**feeds, "traffic": feeds["traffic"].where("bytes_received % 3 = 0")}, 2013)
    read = {r[0].split("year=")[1].split("/")[0] for r in seen[0].select(F.input_file_name()).distinct().collect()}
    assert len(seen) == 1 and read == {"2013"} and "PartitionFilters: [isnotnull(year" in executed(seen[0])
    whole = keep(wh.read("hive_ods_traffic", pipeline.hive_schema("traffic")))
    assert rows(pipeline.traffic_mart(wh)) == rows(whole) and whole.select(F.year("month")).distinct().count() == 2


def test_ids_of_any_number_of_values(spark):
    values = spark.range(3000).select(F.when(F.col("id") == 5, None).otherwise(F.md5(F.col("id").cast("string"))).alias("v"))
    got = sorted(marts.numbered_values(values, "v", start=10).collect())
    texts = sorted(r.v for r in values.collect() if r.v is not None)
    assert [(r.id, r.v) for r in got] == [*zip(range(11, 3010), texts), (3010, None)]


def test_dimension_keeps_known_ids(spark):
    old = spark.createDataFrame([(1, "B"), (2, "D"), (3, None)], "id smallint, legal_type_key string")
    report = spark.createDataFrame([("A",), ("B",), (None,), ("C",), ("B",)], "legal_type string")
    got = sorted(map(tuple, marts.dimension(report, "legal_type", old).collect()))
    assert got == [(1, "B"), (2, "D"), (3, None), (4, "A"), (5, "C")]


# -- quality --------------------------------------------------------------------------

def test_repeated_keys_are_found_behind_clashing_hashes(spark):
    data = [("a", 1), ("a", 2), ("b", 1), ("a", 1), (None, 1), (1 and None, 1), (None, None), (None, None), ("1", None), ("c", 7)]
    df = spark.createDataFrame(data, "t string, n int")
    for digest in (F.xxhash64, lambda *c: F.lit(0), lambda *c: F.length(F.coalesce(c[0], F.lit("x")))):
        r = quality.repeated_keys(df, ["t", "n"], digest).first()
        assert (r._e, r._u) == (10, 4)
    r = quality.repeated_keys(df.limit(0), ["t", "n"]).first()
    assert (r._e, r._u) == (0, 0)


def test_uniqueness_exchanges_hashes_first(spark):
    df = spark.createDataFrame([("a", 1)], "pay_doc_type string, pay_doc_num int")
    plan = executed(quality.repeated_keys(df, ["pay_doc_type", "pay_doc_num"]))
    assert "hashpartitioning(_h" in plan and "LeftSemi" in plan


def test_heads_and_limits_are_ordered(spark):
    from vaultspark.sources import readers

    df = spark.range(100).select((F.lit(99) - F.col("id")).alias("a"))
    assert [r.a for r in readers.batch_head(df, 3).collect()] == [0, 1, 2]
    assert [r.a for r in readers.limit_batch(df, 2, ["a"]).collect()] == [0, 1]


def test_the_loaded_vault_keeps_no_years_of_copies(spark):
    wh = Q.loaded_vault(spark, SF_SMALL)
    for name, (_, _, _, pk, hd) in pipeline.SATS.items():
        schema = pipeline._latest_schema(pk, hd)
        assert len(pipeline._versions(wh, f"{name}_latest", schema)) <= pipeline.OPEN_DELTAS
        assert len(pipeline._versions(wh, f"{name}_base", schema)) <= 1


# -- what may be broadcast ----------------------------------------------------------------

def test_tables_that_grow_are_never_broadcast_by_the_size_of_their_files(spark, loaded):
    """Hubs, links and the MDM snapshot hold a row in a few bytes: however small their files, they are not sent to the driver."""
    staged, hub = loaded.read("mv_payment_2014"), loaded.read("hub_user", schemas.hub_schema("user"))
    link, sat = loaded.read("link_payment", schemas.LINK_PAYMENT), loaded.read("sat_payment", schemas.SAT_PAYMENT)
    for new in (vault.hub_rows("user", [staged, loaded.read("mv_mdm")], hub), vault.link_payment_rows(staged, link)):
        plan = executed(new)
        assert "LeftAnti" in plan and "Broadcast" not in plan
    sums = marts.user_year_sums(link, sat, loaded.read("hub_billing_period", schemas.hub_schema("billing_period")))
    assert executed(sums).count("BroadcastExchange") == 1  # the billing periods, whose number is checked
    flat = sums.sparkSession.createDataFrame(sums.collect(), sums.schema)
    assert "Broadcast" not in executed(marts.report_of_sums(flat, hub, loaded.read("ods_user", schemas.ODS_USER)))


def test_states_behind_the_cut_are_compared_in_one_pass(spark, no_broadcast, monkeypatch):
    """The cut to the keys of the batch is made once, and states equal those of the two aggregates, large keys or not."""
    import random

    rnd = random.Random(11)
    year = lambda: rnd.choice([None, *(dt.datetime(y, 1, 1) for y in range(2013, 2017))])
    keys = [None, "hot", *(f"k{i}" for i in range(40))]
    rows_ = [("hot" if i % 3 == 0 else rnd.choice(keys), rnd.choice(["x", "y", "z", None]), year()) for i in range(900)]
    history = spark.createDataFrame(rows_, "pk string, hd string, LOAD_DATE timestamp_ntz").repartition(3)
    for least, batch_keys in ((20, keys[2:30]), (20, keys), (10_000, keys)):
        monkeypatch.setattr(vault, "LEAST_PIECE", least)
        batch = spark.createDataFrame([(k,) for k in batch_keys] * 4 + [("hot",)] * (200 if "hot" in batch_keys else 0), "pk string")
        cut = history.join(batch.distinct(), "pk", "left_semi")
        got = vault.compared_states(cut, "pk", "hd", batch)
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in vault.latest_states(cut, "pk", "hd").collect()}
        if "hot" not in batch_keys:
            cuts = [df._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") for df in (got, vault.latest_states(cut, "pk", "hd"))]
            assert cuts == [1, 2]
