"""Star mart (MT-1..7, JN-5..8, AG-1, AG-3, AG-5, WN-5, ST-1).

The report sums payments by six low-cardinality attributes.  SUM distributes
over the joins, so the satellite is pre-aggregated per link key and again per
(user, billing year) before the user-side joins: the big inputs shrink
map-side and a hot user is one row per year after the first aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vaultspark.operators.vault import pack, sorted_merge, texts, unpack
from vaultspark.sources.sinks import shared_root

# SMALLSERIAL: ids of a dimension run 1..32767.  This is also the proven size
# bound that lets the fact broadcast its dimensions.
SMALLINT_MAX = 32767

REPORT_ATTRIBUTES = ["billing_year", "legal_type", "district", "registration_year",
                     "billing_mode", "is_vip"]
DIMENSIONS = ["billing_year", "legal_type", "district", "registration_year", "billing_mode"]


#: Billing periods a broadcast may hold: months of some thousands of years.
PERIODS_MAX = 50_000


def user_year_sums(link: DataFrame, sat_payment: DataFrame, hub_billing_period: DataFrame) -> DataFrame:
    """(USER_PK, billing_year, tot): link ⋈ sat_payment ⋈ hub_billing_period summed by user and billing year.

    The payments are summed per link key, then joined on that key; the period of a link row comes from a
    broadcast whose size is checked, so nothing is ever exchanged on the few period keys.  A hub
    beyond the bound joins by a shuffle instead, after the sums per (user, period).  Users go through the
    last exchange as bytes (:func:`vault.pack`)."""
    per_payment = sat_payment.groupBy("PAYMENT_PK").agg(F.sum("sum").alias("_s"))
    paid = per_payment.join(sorted_merge(link.select("PAYMENT_PK", "USER_PK", "BILLING_PERIOD_PK")), "PAYMENT_PK")
    periods = hub_billing_period.select(
        "BILLING_PERIOD_PK",
        F.year(F.col("BILLING_PERIOD_KEY").cast("date")).alias("billing_year"))
    if hub_billing_period.limit(PERIODS_MAX + 1).count() <= PERIODS_MAX:
        periods = F.broadcast(periods)
    else:
        paid = paid.groupBy("USER_PK", "BILLING_PERIOD_PK").agg(F.sum("_s").alias("_s"))
    sums = (pack(paid.join(periods, "BILLING_PERIOD_PK"), "USER_PK")
            .groupBy("USER_PK", "billing_year").agg(F.sum("_s").cast("bigint").alias("tot")))
    return unpack(sums, *texts(paid, "USER_PK"))


def report_of_sums(sums: DataFrame, hub_user: DataFrame, ods_user: DataFrame, order: bool = True) -> DataFrame:
    """The report from (USER_PK, billing_year, tot) rows, several for one user and year if need be:
    ⋈ hub_user ⟕ ods_user, summed by the six attributes.  The users meet their attributes first, one row for
    each, and the sums of their years after that.  Neither table is broadcast: the MDM snapshot has less than a byte a
    row in its files."""
    per_user_year = sums.groupBy("USER_PK", "billing_year").agg(F.sum("tot").alias("_s"))
    users = hub_user.select("USER_PK", "USER_KEY")
    mdm = ods_user.select(
        F.col("user_id").cast("string").alias("_user_key"), "legal_type", "district",
        F.year("registered_at").alias("registration_year"), "billing_mode", "is_vip")
    known = users.join(sorted_merge(mdm), F.col("USER_KEY") == F.col("_user_key"), "left")
    rows = per_user_year.join(sorted_merge(known), "USER_PK")
    report = rows.groupBy(*REPORT_ATTRIBUTES).agg(F.sum("_s").cast("bigint").alias("tot_sum"))
    report = report.select(
        F.col("billing_year").cast("smallint").alias("billing_year"), "legal_type", "district",
        F.col("registration_year").cast("smallint").alias("registration_year"),
        "billing_mode", "is_vip", "tot_sum")
    if order:  # ST-1: PostgreSQL puts NULLs last on ASC
        report = report.orderBy(*[F.col(c).asc_nulls_last() for c in REPORT_ATTRIBUTES])
    return report


def payment_report(link: DataFrame, sat_payment: DataFrame, hub_billing_period: DataFrame,
                   hub_user: DataFrame, ods_user: DataFrame, order: bool = True) -> DataFrame:
    """MT-1: link ⋈ sat_payment ⋈ hub_billing_period ⋈ hub_user ⟕ ods_user,
    summed by billing year (from the billing-period key), legal type, district,
    registration year, billing mode and VIP flag."""
    return report_of_sums(user_year_sums(link, sat_payment, hub_billing_period), hub_user, ods_user, order)


def numbered_values(values: DataFrame, key: str, start: int = 0) -> DataFrame:
    """(id bigint, key): distinct ``values`` numbered from ``start`` + 1 in sorted order, NULL last, however
    many there are: ranges of the key are written once, counted, and each numbered behind the ranges before it."""
    spark = values.sparkSession
    path = shared_root(spark, "ranges")
    (values.repartitionByRange(F.col(key).asc_nulls_last()).withColumn("_range", F.spark_partition_id()).write.parquet(path))
    ranged = spark.read.parquet(path)
    sizes = ranged.groupBy("_range").count()  # a row for each range
    before = sizes.select("_range", F.coalesce(F.sum("count").over(
        W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_range").orderBy(F.col(key).asc_nulls_last()))
    return ranged.withColumn("_n", inside).join(F.broadcast(before), "_range").select(
        (F.col("_n") + F.col("_before") + start).cast("bigint").alias("id"), key)


def dimension(report: DataFrame, attribute: str, known: DataFrame | None = None) -> DataFrame:
    """MT-2..6: distinct values of one attribute numbered 1..n in sorted order,
    NULL last (AG-3 + WN-5).

    The id type is SMALLINT, which bounds the values to 32767; the bound is checked first (a
    bounded ``limit(n+1).count()``), so the single task that numbers them is proven small.
    (:func:`numbered_values` numbers any amount.)  With ``known``, the dimension as it was,
    every value keeps its id, also one that has gone, and new values follow the largest id
    in sorted order: ids stored elsewhere stay true when a value sorts in between.
    """
    key = f"{attribute}_key"
    values = report.select(F.col(attribute).alias(key)).distinct()
    start = 0
    if known is not None:
        start = known.agg(F.max("id")).first()[0] or 0
        values = values.join(known.select(F.col(key).alias("_known")), F.col(key).eqNullSafe(F.col("_known")), "left_anti")
    n = start + values.limit(SMALLINT_MAX + 1).count()
    if n > SMALLINT_MAX:
        raise ValueError(f"dimension {attribute} exceeds {SMALLINT_MAX} values")
    ordered = W.orderBy(F.col(key).asc_nulls_last())
    new = values.select((F.row_number().over(ordered) + start).cast("smallint").alias("id"), key)
    return new if known is None else known.select("id", key).unionByName(new)


def fact(report: DataFrame, dims: dict[str, DataFrame], keep_unknown: bool = False) -> DataFrame:
    """MT-7 / JN-7: natural keys -> surrogate ids by five inner joins.  Rows
    with a NULL attribute drop out (Q-6); with ``keep_unknown`` they take the id of the
    dimension's NULL row.  Each dimension is broadcast: its size is bounded by
    :func:`dimension`'s check."""
    out = report
    for attr in DIMENSIONS:
        d = dims[attr]
        value, key = F.col(attr), F.col(f"{attr}_key")
        out = out.join(F.broadcast(d.withColumnRenamed("id", f"{attr}_id")),
                       value.eqNullSafe(key) if keep_unknown else value == key, "inner")
    return out.select(*[F.col(f"{a}_id") for a in DIMENSIONS], "is_vip", "tot_sum")


def fact_fk_violations(fact_df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """JN-8: fact ids with no matching dimension row, per foreign key (must be
    empty).  NULL ids pass, as a foreign key allows.  One pass over the fact: five
    outer joins with broadcast ids of bounded number."""
    out, broken = fact_df, []
    for attr in DIMENSIONS:
        fk, found = f"{attr}_id", f"_{attr}"
        ids = dims[attr].select(F.col("id").alias(found)).distinct()
        out = out.join(F.broadcast(ids), F.col(fk) == F.col(found), "left")
        broken.append(F.when(F.col(fk).isNotNull() & F.col(found).isNull(),
                             F.struct(F.lit(fk).alias("foreign_key"), F.col(fk).cast("smallint").alias("id"))))
    rows = F.filter(F.array(*broken), lambda r: r.isNotNull())
    return out.select(F.inline(rows))


def traffic_mart(ods_traffic: DataFrame) -> DataFrame:
    """AG-5 (our definition, the reference's query is absent): per user, device
    and month the bytes sent and received and the number of records."""
    return (ods_traffic
            .groupBy("user_id", "device_id",
                     F.trunc(F.col("timestamp").cast("date"), "MM").alias("month"))
            .agg(F.sum("bytes_sent").cast("bigint").alias("bytes_sent"),
                 F.sum("bytes_received").cast("bigint").alias("bytes_received"),
                 F.count(F.lit(1)).cast("bigint").alias("records")))
