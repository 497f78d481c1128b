import datetime as dt

import pytest
from pyspark.sql import functions as F

from vaultspark.operators import marts
from vaultspark.sources import schemas


def _vault(spark):
    link = spark.createDataFrame(
        [("p1", "u1", "a", "b1", "t"), ("p2", "u2", "a", "b1", "t"), ("p3", "u9", "a", "b2", "t")],
        "PAYMENT_PK string, USER_PK string, ACCOUNT_PK string, BILLING_PERIOD_PK string, PAY_DOC_TYPE_PK string")
    sat = spark.createDataFrame([("p1", 10), ("p1", 5), ("p2", 7), ("p3", 1)], "PAYMENT_PK string, sum int")
    hbp = spark.createDataFrame([("b1", "2013-02-01"), ("b2", "2014-03-01")], "BILLING_PERIOD_PK string, BILLING_PERIOD_KEY string")
    hu = spark.createDataFrame([("u1", "1"), ("u2", "2"), ("u9", "9")], "USER_PK string, USER_KEY string")
    users = spark.createDataFrame(
        [(1, "A", "N1", dt.date(2005, 1, 1), "PREPAID", True), (2, "B", "N1", dt.date(2006, 1, 1), "POSTPAID", False)],
        schemas.ODS_USER)
    return link, sat, hbp, hu, users


def test_report_keeps_orphan_user_with_nulls(spark):
    rep = marts.payment_report(*_vault(spark)).collect()
    assert [tuple(r) for r in rep] == [
        (2013, "A", "N1", 2005, "PREPAID", True, 15),
        (2013, "B", "N1", 2006, "POSTPAID", False, 7),
        (2014, None, None, None, None, None, 1),  # user 9 has no MDM row (Q-6), NULLs sort last
    ]
    assert marts.payment_report(*_vault(spark)).schema == schemas.REPORT


def test_dimensions_number_sorted_null_last_and_fact_drops_nulls(spark):
    rep = marts.payment_report(*_vault(spark))
    dims = {d: marts.dimension(rep, d) for d in marts.DIMENSIONS}
    assert [tuple(r) for r in dims["legal_type"].collect()] == [(1, "A"), (2, "B"), (3, None)]
    fact = marts.fact(rep, dims)
    assert fact.count() == 2  # the NULL-attribute row drops out of the inner joins
    assert marts.fact_fk_violations(fact, dims).count() == 0
    bad = fact.withColumn("district_id", F.lit(99).cast("smallint"))
    v = marts.fact_fk_violations(bad, dims).collect()
    assert {(r.foreign_key, r.id) for r in v} == {("district_id", 99)}


def test_dimension_size_is_checked(spark):
    big = spark.range(marts.SMALLINT_MAX + 1).select(F.col("id").alias("legal_type"))
    with pytest.raises(ValueError):
        marts.dimension(big, "legal_type")


def test_traffic_mart(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2014, 1, 3), "d1", "1.1.1.1", 5, 6), (1, dt.datetime(2014, 1, 9), "d1", "1.1.1.1", 1, 1),
         (1, dt.datetime(2014, 2, 1), "d1", "1.1.1.1", 2, 2)], schemas.ODS_TRAFFIC)
    out = sorted(tuple(r) for r in marts.traffic_mart(df).collect())
    assert out == [(1, "d1", dt.date(2014, 1, 1), 6, 7, 2), (1, "d1", dt.date(2014, 2, 1), 2, 2, 1)]
