"""Plan shapes the scale design relies on (regression guards)."""

import datetime as dt
from decimal import Decimal

from vaultspark.operators import marts, staging, vault
from vaultspark.sources import schemas


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _staged(spark, n=60):
    rows = [(1 if i % 3 else i, "MIR", i, "FL-1", Decimal(70000000000 + i % 2), dt.date(2013, 1, 1),
             dt.date(2013, 1, 1 + i % 28), 10) for i in range(n)]
    return staging.stage(spark.createDataFrame(rows, schemas.ODS_PAYMENT), staging.PAYMENT,
                         dt.datetime(2013, 1, 1))


def test_change_collapse_splits_a_hot_key_by_ordering_buckets(spark):
    plan = _plan(vault.sat_user_rows(_staged(spark)))
    # the per-row window is partitioned by key AND the contiguous ordering buckets
    assert "hashpartitioning(_k" in plan and "_b0" in plan
    assert "windowspecdefinition(_k" in plan


def test_hub_load_aggregates_map_side(spark):
    plan = _plan(vault.hub_rows("user", [_staged(spark)]))
    assert "partial_min" in plan
    assert "Window" not in plan


def test_report_pre_aggregates_before_joins(spark):
    st = _staged(spark)
    link = vault.link_payment_rows(st)
    sat = vault.sat_payment_rows(st)
    hub_bp = vault.hub_rows("billing_period", [st])
    hub_u = vault.hub_rows("user", [st])
    users = spark.createDataFrame([(1, "A", "N", dt.date(2005, 1, 1), "PREPAID", True)], schemas.ODS_USER)
    plan = marts.payment_report(link, sat, hub_bp, hub_u, users, order=False)._jdf.queryExecution() \
        .optimizedPlan().toString()
    # the satellite is summed per payment key below the join with the link
    agg = plan.find("Aggregate [PAYMENT_PK")
    join = plan.find("Join Inner")
    assert agg > join > -1


def test_year_slice_reaches_the_scan(spark, tmp_path):
    from vaultspark.operators import ods

    p = str(tmp_path / "payment")
    rows = [(1, "MIR", 1, "FL-1", Decimal(70000000000), "2013-01", dt.date(2013, 1, 5), 1.5)]
    spark.createDataFrame(rows, schemas.STG_PAYMENT).write.parquet(p)
    df = ods.ods_payment(spark.read.schema(schemas.STG_PAYMENT).parquet(p), 2013)
    plan = _plan(df)
    assert "GreaterThanOrEqual(pay_date,2013-01-01)" in plan and "LessThan(pay_date,2014-01-01)" in plan


def test_loads_that_compare_with_loads_start_from_their_files(spark, tmp_path):
    """The plan of a third load holds neither of the loads before it: its text stays short and no hash key is made in it."""
    from vaultspark.plans import contents

    spark.range(300).selectExpr(
        "id o_orderkey", "id % 40 o_custkey", "timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(cast(id * 7 % 1400 as int)) o_orderdate",
        "cast(id as double) o_totalprice").write.parquet(str(tmp_path / "orders.parquet"))
    for name in ("sat_payment_third_year", "sat_payment_late_rerun", "sat_user_third_year"):
        df = contents.QUERIES[name](spark, str(tmp_path))
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert len(plan) < 60_000 and "md5(" not in plan, (name, len(plan))
        assert df.count() > 0
