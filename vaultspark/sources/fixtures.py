"""Stand-in raw sources built from the provided test tables.

The reference reads five telecom feeds (billing, issue, payment, traffic and
the MDM user table).  The test data holds TPC-H-like tables instead, so each
feed is *shaped* from them: same columns and types as the feed, nothing else.
These builders do none of the warehouse work; every loader downstream treats
their output as opaque rows of the feed's schema.

Dates are shifted into the reference's own year range (orders and line items
+18 years, events -10 years).  ``SQL`` holds the DuckDB text of the same
shapes for the oracle; both forms give identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stg_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_custkey as int) user_id",
        "case o_orderkey % 3 when 0 then 'MASTER' when 1 then 'MIR' else 'VISA' end pay_doc_type",
        "cast(o_orderkey as int) pay_doc_num",
        "concat('FL-', cast(o_custkey as string)) account",
        "cast(70000000000 + o_custkey * 1000 + o_orderkey % 2 as decimal(11,0)) phone",
        "date_format(o_orderdate + interval 18 years, 'yyyy-MM') billing_period",
        "cast(o_orderdate + interval 18 years as date) pay_date",
        "o_totalprice sum",
    )


def mdm_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "cast(c_custkey as int) id",
        "c_mktsegment legal_type",
        "n_name district",
        "cast(date_add(date'2005-01-01', cast(c_custkey % 3000 as int)) as timestamp_ntz) registered_at",
        "case when c_custkey % 2 = 0 then 'PREPAID' else 'POSTPAID' end billing_mode",
        "c_acctbal > 9000 is_vip",
    )


def stg_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).selectExpr(
        "cast(o_custkey as int) user_id",
        "date_format(l_shipdate + interval 18 years, 'yyyy-MM') billing_period",
        "l_returnflag service",
        "l_linestatus tariff",
        "cast(cast(rint(l_extendedprice) as int) as string) sum",
        "cast(l_shipdate + interval 18 years as date) created_at",
    )


def stg_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'error'").selectExpr(
        "cast(user_id as string) user_id",
        "ts - interval 10 years start_time",
        "ts - interval 10 years + interval 1 hour end_time",
        "event_type title",
        "props description",
        "concat('svc', cast(event_id % 3 as string)) service",
    )


def stg_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as int) user_id",
        # epoch milliseconds of a zone-free timestamp (truncating)
        "cast(floor(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
        "ts - interval 10 years) / 1000) as bigint) timestamp",
        "concat('d', lpad(cast(user_id as string), 9, '0')) device_id",
        "concat('192.168.', cast((event_id div 256) % 256 as string), '.', "
        "cast(event_id % 256 as string)) device_ip_addr",
        "cast(rint(value * 100) as int) bytes_sent",
        "cast(event_id as int) bytes_received",
    )


class QuirkDir(str):
    """An input folder read as feeds with everything the plain ones lack (see ``QUIRK_EXPRESSIONS``)."""


# Spark and DuckDB both take these expressions.  Rows are chosen by the remainders of their keys:
# payments without account (NULL, blanks), of users whom the MDM feed does not know, dated before 2000, in
# 2000-2012 and after 2030; phones that change and come back; an account or document type written two ways;
# users first seen in a later year; payments for January of their own or the year before, so that payment keys
# come back in the next year; traffic of two years and of IPv6 devices.
QUIRK_EXPRESSIONS = {
    "payment": (
        "case when o_orderkey % 13 = 0 then cast(o_custkey + 10000000 as int) else cast(o_custkey as int) end user_id",
        "case when o_orderkey % 29 = 0 then ' mir' when o_orderkey % 31 = 0 and {year} > 1995 then 'CASH' "
        "when o_orderkey % 3 = 0 then 'MASTER' when o_orderkey % 3 = 1 then 'MIR' else 'VISA' end pay_doc_type",
        "cast(o_orderkey as int) pay_doc_num",
        "case when o_orderkey % 11 = 0 then cast(null as {text}) when o_orderkey % 11 = 1 then '  ' "
        "when o_orderkey % 11 = 2 then concat(' fl-', cast(o_custkey as {text})) else concat('FL-', cast(o_custkey as {text})) end account",
        "cast(70000000000 + o_custkey * 1000 + {month} % 2 as decimal(11,0)) phone",
        "{period} billing_period", "{day} pay_date", "o_totalprice sum",
    ),
}
# Years added to an order's date; orders span seven years.
QUIRK_SHIFT = "case when o_orderkey % 17 = 0 then 0 when o_orderkey % 17 = 1 then 10 when o_orderkey % 17 = 2 then 40 else 18 end"


def quirk_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments with gaps, strangers, odd spellings and odd years."""
    day = f"cast(add_months(o_orderdate, 12 * {QUIRK_SHIFT}) as date)"
    period = (f"case when o_orderkey % 5 < 2 then concat(lpad(cast(year({day}) - o_orderkey % 5 as string), 4, '0'), '-01') "
              f"else date_format({day}, 'yyyy-MM') end")
    words = {"text": "string", "day": day, "period": period,
             "year": "year(o_orderdate)", "month": "month(o_orderdate)"}
    return table(spark, sf_dir, "orders").selectExpr(*[e.format(**words) for e in QUIRK_EXPRESSIONS["payment"]])


def quirk_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The MDM snapshot of a later year: the VIP mark and the registration of some users have changed."""
    return mdm_user(spark, sf_dir).selectExpr(
        "id", "legal_type", "district",
        "case when id % 7 = 0 then registered_at + interval 1 day else registered_at end registered_at",
        "billing_mode", "case when id % 5 = 0 then not is_vip else is_vip end is_vip")


def quirk_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic of 2013 and 2014, every fifth record from an IPv6 device in one of several spellings."""
    v6 = ("case event_id % 4 when 0 then concat('2001:DB8::', cast(user_id % 10 as string)) "
          "when 1 then concat('2001:db8:0:0:0:0:0:', cast(user_id % 10 as string)) "
          "when 2 then concat('::ffff:10.0.', cast(user_id % 256 as string), '.7') else 'fe80::1/64' end")
    return stg_traffic(spark, sf_dir).withColumnRenamed("bytes_received", "event_id").selectExpr(
        "user_id", "timestamp - (event_id % 2) * 31536000000 timestamp", "device_id",
        f"case when event_id % 5 = 0 then {v6} else device_ip_addr end device_ip_addr", "bytes_sent", "event_id bytes_received")


def quirk_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {**raw_sources(spark, sf_dir), "payment": quirk_payment(spark, sf_dir), "traffic": quirk_traffic(spark, sf_dir)}


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five feeds, keyed like the reference's source names."""
    return {
        "billing": stg_billing(spark, sf_dir),
        "issue": stg_issue(spark, sf_dir),
        "payment": stg_payment(spark, sf_dir),
        "traffic": stg_traffic(spark, sf_dir),
        "user": mdm_user(spark, sf_dir),
    }


# DuckDB text of the same shapes (the oracle's inputs).
SQL = {
    "payment": (
        "select cast(o_custkey as int) user_id, case o_orderkey % 3 when 0 then 'MASTER' when 1 then 'MIR' "
        "else 'VISA' end pay_doc_type, cast(o_orderkey as int) pay_doc_num, concat('FL-', cast(o_custkey as varchar)) "
        "account, cast(70000000000 + o_custkey * 1000 + o_orderkey % 2 as decimal(11,0)) phone, "
        "strftime(o_orderdate + interval 18 year,'%Y-%m') billing_period, cast(o_orderdate + interval 18 year as date) "
        "pay_date, o_totalprice sum from orders"
    ),
    "user": (
        "select cast(c_custkey as int) id, c_mktsegment legal_type, n_name district, cast(date '2005-01-01' + "
        "cast(c_custkey % 3000 as int) as timestamp) registered_at, case when c_custkey % 2 = 0 then 'PREPAID' "
        "else 'POSTPAID' end billing_mode, c_acctbal > 9000 is_vip from customer join nation on c_nationkey = n_nationkey"
    ),
    "billing": (
        "select cast(o_custkey as int) user_id, strftime(l_shipdate + interval 18 year,'%Y-%m') billing_period, "
        "l_returnflag service, l_linestatus tariff, cast(cast(l_extendedprice as int) as varchar) sum, "
        "cast(l_shipdate + interval 18 year as date) created_at from lineitem join orders on l_orderkey = o_orderkey"
    ),
    "issue": (
        "select cast(user_id as varchar) user_id, ts - interval 10 year start_time, ts - interval 10 year + "
        "interval 1 hour end_time, event_type title, props description, concat('svc', cast(event_id % 3 as varchar)) "
        "service from events where event_type = 'error'"
    ),
    "traffic": (
        "select cast(user_id as int) user_id, epoch_us(ts - interval 10 year) // 1000 as \"timestamp\", "
        "concat('d', lpad(cast(user_id as varchar), 9, '0')) device_id, concat('192.168.', "
        "cast((event_id // 256) % 256 as varchar), '.', cast(event_id % 256 as varchar)) device_ip_addr, "
        "cast(value * 100 as int) bytes_sent, cast(event_id as int) bytes_received from events"
    ),
}


def _quirk_sql() -> dict[str, str]:
    day = f"cast(o_orderdate + to_years(cast({QUIRK_SHIFT} as integer)) as date)"
    period = (f"case when o_orderkey % 5 < 2 then concat(lpad(cast(year({day}) - o_orderkey % 5 as varchar), 4, '0'), '-01') "
              f"else strftime({day}, '%Y-%m') end")
    words = {"text": "varchar", "day": day, "period": period,
             "year": "year(o_orderdate)", "month": "month(o_orderdate)"}
    # what each generated address prints as, stated by its form
    v6 = ("case event_id % 4 when 2 then concat('::ffff:10.0.', cast(user_id % 256 as varchar), '.7') when 3 then 'fe80::1/64' "
          "else concat('2001:db8::', case when user_id % 10 > 0 then cast(user_id % 10 as varchar) else '' end) end")
    return {
        "payment": f"select {', '.join(e.format(**words) for e in QUIRK_EXPRESSIONS['payment'])} from orders",
        "user": ("select id, legal_type, district, case when id % 7 = 0 then registered_at + interval 1 day else registered_at end "
                 "registered_at, billing_mode, case when id % 5 = 0 then not is_vip else is_vip end is_vip "
                 f"from ({SQL['user']}) m"),
        "traffic": ('select user_id, "timestamp" - (bytes_received % 2) * 31536000000 as "timestamp", device_id, '
                    f"case when bytes_received % 5 = 0 then {v6.replace('event_id', 'bytes_received')} else device_ip_addr end device_ip_addr, "
                    f"bytes_sent, bytes_received from ({SQL['traffic']}) e"),
    }


QUIRK_SQL = _quirk_sql()
