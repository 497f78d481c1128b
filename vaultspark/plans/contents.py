"""Registered queries over what the yearly loads leave behind: contents of the loaded tables, the loads on
feeds with quirks (``fixtures.QuirkDir``), validation batches and kept results.

Each has the reference's own SQL as oracle.  For feeds with quirks that is the SQL of the plain
feeds with the feeds' SELECTs exchanged.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultspark import oracle as O
from vaultspark.functions import inet_text, uuid_text
from vaultspark.functions.inet import canonical, is_ipv4
from vaultspark.operators import marts, ods, quality, staging, vault
from vaultspark.plans import pipeline
from vaultspark.plans import queries as Q
from vaultspark.sources import fixtures, readers, schemas
from vaultspark.sources.fixtures import QuirkDir
from vaultspark.sources.sinks import PARTITION_COLUMN, Warehouse, shared_root

Y1, Y2, Y3 = Q.Y1, Q.Y2, Q.Y2 + 1
EARLY_YEARS = [Y1, Y2]
VAULT_TABLES = pipeline.VAULT_TABLES


def quirky(sql: str, users: bool = False) -> str:
    """SQL over the plain feeds turned to the feeds with quirks (``users``: the MDM feed, too)."""
    for src in ("payment", "traffic", *(["user"] if users else [])):
        sql = sql.replace(O.RAW[src], fixtures.QUIRK_SQL[src])
    return sql


_BUILT: dict[tuple[str, str, str], Warehouse] = {}


def _once(spark, sf: str, name: str, build) -> Warehouse:
    """A warehouse built once per session and input folder."""
    key = (spark.sparkContext.applicationId, str(sf), name)
    if key not in _BUILT:
        wh = Warehouse.for_vault(spark, shared_root(spark, name))
        build(wh)
        _BUILT[key] = wh
    return _BUILT[key]


def early_vault(spark, sf: str) -> Warehouse:
    def build(wh):
        for year in EARLY_YEARS:
            pipeline.run_early_vault_year(spark, wh, Q.raw(spark, sf, "payment"), year)
    return _once(spark, sf, "early-vault", build)


def hive_tables(spark, sf: str) -> Warehouse:
    """2013, 2014 and 2013 again: traffic of both years, the rerun replaces its part only."""
    def build(wh):
        for year in (Y1, Y2, Y1):
            pipeline.run_hive_year(spark, wh, fixtures.quirk_sources(spark, sf), year)
    return _once(spark, sf, "hive-years", build)


def _early_loads() -> dict:
    stg = lambda y: O.staged("early_payment", y)
    loads = {f"hub_{h}": (lambda y, t, h=h: O.hub_sql(h, y, t, sources=("early_payment",)))
             for h in ("user", "account", "billing_period", "paydoc")}
    loads["link_paydoc_payment"] = lambda y, t: O.link_sql(
        stg(y), t, pk="PAY_PK", fks=["PAYDOC_PK", "USER_PK", "ACCOUNT_PK", "BILLING_PERIOD_PK"])
    loads["sat_user"] = lambda y, t: O.sat_sql(O.sat_user_src(y, "early_payment"), "USER_PK", "USER_HASHDIFF", ["phone"], y, t)
    loads["sat_pay"] = lambda y, t: O.sat_sql(stg(y), "PAY_PK", "PAY_HASHDIFF", ["sum"], y, t)
    return loads


def _late(sql: str) -> str:
    """The payment feed with quirks without the payments that arrive late."""
    return sql.replace(fixtures.QUIRK_SQL["payment"], f"select * from ({fixtures.QUIRK_SQL['payment']}) f where pay_doc_num % 10 <> 3")


def _staged_late(spark, sf, year):
    feed = fixtures.quirk_payment(spark, sf).where("pay_doc_num % 10 <> 3")
    return staging.stage(ods.ods_payment(feed, year), staging.PAYMENT, Q.ld(year), year)


def _staged_mdm(spark, sf, year, changed: bool):
    feed = fixtures.quirk_user(spark, sf) if changed else fixtures.mdm_user(spark, sf)
    return staging.stage(ods.ods_user(feed), staging.MDM, Q.ld(year))


def build() -> tuple[dict[str, Q.Query], dict[str, str]]:
    q: dict[str, Q.Query] = {}
    sql: dict[str, str] = {}

    def add(name: str, query: Q.Query, oracle: str) -> None:
        q[name], sql[name] = query, oracle

    # contents of the loaded vaults (SK-4, SK-5, PL-1, PL-2, DV-10..18)
    for t in VAULT_TABLES:
        add(f"vault_{t}", lambda spark, sf, t=t: Q.loaded_vault(spark, sf).read(t), Q.loaded_table_sql(t, Q.YEARS))
        add(f"quirk_vault_{t}", lambda spark, sf, t=t: Q.loaded_vault(spark, QuirkDir(sf)).read(t),
            quirky(Q.loaded_table_sql(t, Q.YEARS)))
    for t, loads in _early_loads().items():
        ctes: list[str] = []
        last = Q.chain(ctes, f"early_{t}", EARLY_YEARS, loads)
        add(f"early_{t}", lambda spark, sf, t=t: early_vault(spark, sf).read(t), f"with {', '.join(ctes)} select * from {last}")

    # contents of the Hive tables and the traffic mart after a rerun (SK-3, SK-7, AG-5)
    for src in pipeline.ODS_SOURCES:
        add(f"hive_ods_{src}", lambda spark, sf, s=src: hive_tables(spark, sf).read(f"hive_ods_{s}", pipeline.hive_schema(s)),
            quirky(" union all ".join(f"select *, cast({y} as integer) as year from ({O.ods_hive_sql(src, y)}) o" for y in (Y1, Y2))))
    add("dm_traffic_years", lambda spark, sf: pipeline.traffic_mart(hive_tables(spark, sf)),
        quirky(" union all ".join(f"({O.dm_traffic_sql(y)})" for y in (Y1, Y2))))

    # range partitions with rows in all three kinds, and a reload that empties a year (SK-1, SK-2)
    part = f"{O.partition_label_sql('pay_date')} {PARTITION_COLUMN}"

    def full_load(spark, sf):
        wh = Warehouse(spark, shared_root(spark, "ods-full"))
        pipeline.load_ods_full(wh, {"payment": fixtures.quirk_payment(spark, sf)}, "payment")
        return wh.read("ods_payment", pipeline._with_part(schemas.ODS_PAYMENT))
    add("ods_full_load", full_load, quirky(f"select *, {part} from ({O.ods_sql('payment', None)}) o"))
    add("ods_partition_label_quirk",
        lambda spark, sf: pipeline.partition_labels(Q._ods_full(spark, QuirkDir(sf), "payment"), "pay_date"),
        quirky(f"select {part}, count(*) row_count from ({O.ods_sql('payment', None)}) o group by 1"))

    def empty_reload(spark, sf):
        wh = Warehouse(spark, shared_root(spark, "ods-empty"))
        feed = fixtures.quirk_payment(spark, sf)
        for year, rows in ((Y1, feed), (Y2, feed), (Y1, feed.where("pay_doc_num < 0"))):
            wh.overwrite_partition("ods_payment", str(year), ods.ods_payment(rows, year))
        return wh.read("ods_payment", pipeline._with_part(schemas.ODS_PAYMENT))
    add("ods_empty_year_reload", empty_reload, quirky(f"select *, '{Y2}' {PARTITION_COLUMN} from ({O.ods_sql('payment', Y2)}) o"))

    # hubs: NULL keys come again on a rerun, users and document types that a later year brings (Q-2, DV-10..13)
    add("hub_account_null_keys", lambda spark, sf: Q.hub(spark, QuirkDir(sf), "account", Y1), quirky(O.hub_sql("account", Y1)))
    add("hub_account_rerun", lambda spark, sf: Q.hub(spark, QuirkDir(sf), "account", Y1, Q.hub(spark, QuirkDir(sf), "account", Y1)),
        quirky(O.hub_sql("account", Y1, O.hub_sql("account", Y1))))
    for h in ("user", "pay_doc_type"):
        add(f"quirk_hub_{h}_second_year",
            lambda spark, sf, h=h: Q.hub(spark, QuirkDir(sf), h, Y2, Q.hub(spark, QuirkDir(sf), h, Y1)),
            quirky(O.hub_sql(h, Y2, O.hub_sql(h, Y1))))

    # link: a load that stopped half way, run again (DV-14)
    def link_rerun(spark, sf):
        quirks = QuirkDir(sf)
        half = Q.link(spark, quirks, Y2).where("PAYMENT_PK < '8'")
        return Q.link(spark, quirks, Y2, Q.link(spark, quirks, Y1).unionByName(half))
    half = f"select * from ({O.link_sql(O.staged('payment', Y2))}) h where PAYMENT_PK < '8'"
    add("link_payment_rerun", link_rerun,
        quirky(O.link_sql(O.staged("payment", Y2), f"({O.link_sql(O.staged('payment', Y1))}) union all ({half})")))

    # satellites: a third year on two, changed and corrected users, payments that arrive late (DV-15..17)
    for name in ("sat_payment", "sat_user"):
        def third(spark, sf, name=name):
            first, second = Q.sat_history(spark, QuirkDir(sf), name)
            return Q.sat(spark, QuirkDir(sf), name, Y3, first.unionByName(second))
        one, two = O.sat_year(name, Y1), O.sat_second_year(name, Y1, Y2)
        add(f"{name}_third_year", third, quirky(O.sat_year(name, Y3, f"({one}) union all ({two})")))

    def late_rerun(spark, sf):
        first = Q.landed(spark, Q.sat(spark, QuirkDir(sf), "sat_payment", Y1), "sat_payment")
        late = Q.landed(spark, _staged_late(spark, sf, Y2), f"mv_payment_{Y2}")
        second = Q.landed(spark, vault.sat_payment_rows(late, first, Q.ld(Y2)), "sat_payment")
        return Q.sat(spark, QuirkDir(sf), "sat_payment", Y2, first.unionByName(second))
    first = quirky(O.sat_year("sat_payment", Y1))
    second = O.sat_sql(
        _late(quirky(O.sat_payment_src(Y2))), "PAYMENT_PK", "PAY_DOC_HASHDIFF", ["pay_doc_num", "pay_date", "sum"], Y2, first)
    add("sat_payment_late_rerun", late_rerun, O.sat_sql(
        quirky(O.sat_payment_src(Y2)), "PAYMENT_PK", "PAY_DOC_HASHDIFF", ["pay_doc_num", "pay_date", "sum"], Y2,
        f"({first}) union all ({second})"))

    def mdm(spark, sf, rerun):
        batch = lambda changed: Q.landed(spark, _staged_mdm(spark, sf, Y2, changed), "mv_mdm")
        first = Q.landed(spark, vault.sat_mdm_rows(_staged_mdm(spark, sf, Y1, False)), "sat_mdm")
        second = vault.sat_mdm_rows(batch(True), first, Q.ld(Y2))
        if not rerun:
            return second
        return vault.sat_mdm_rows(batch(False), first.unionByName(Q.landed(spark, second, "sat_mdm")), Q.ld(Y2))
    mdm_sql = lambda src, target: O.sat_sql(src, "MDM_PK", "MDM_HASHDIFF", ["registered_at", "is_vip"], Y2, target)
    first = O.sat_year("sat_mdm", Y1)
    second = mdm_sql(quirky(O.sat_mdm_src(Y2), users=True), first)
    add("sat_mdm_changed_second_year", lambda spark, sf: mdm(spark, sf, False), second)
    add("sat_mdm_corrected_rerun", lambda spark, sf: mdm(spark, sf, True),
        mdm_sql(O.sat_mdm_src(Y2), f"({first}) union all ({second})"))

    # marts with users that the MDM feed does not know (Q-6, JN-6..8, WN-5)
    ctes = []  # payment keys come back in these feeds: the report is over the tables as loaded
    link, sat = (Q.chain(ctes, t, Q.YEARS, Q.vault_loads()[t]) for t in ("link_payment", "sat_payment"))
    report = quirky(f"with {', '.join(ctes)} " + O.report_sql(Q.YEARS, f"select * from {link}", f"select * from {sat}"))
    loaded = lambda spark, sf: Q.loaded_vault(spark, QuirkDir(sf))
    add("quirk_report_payment", lambda spark, sf: loaded(spark, sf).read("report_tmp"), report)
    for d in ("legal_type", "registration_year"):
        add(f"quirk_dim_{d}", lambda spark, sf, d=d: loaded(spark, sf).read(f"dim_{d}"), O.dim_sql(report, d))
    add("quirk_fact_payment", lambda spark, sf: loaded(spark, sf).read("fact"), O.fact_sql(report))
    dims = {d: (lambda wh, d=d: wh.read(f"dim_{d}")) for d in marts.DIMENSIONS}

    def unknown(spark, sf):
        wh = loaded(spark, sf)
        return marts.fact(wh.read("report_tmp"), {d: read(wh) for d, read in dims.items()}, keep_unknown=True)
    ids = ", ".join(f"d_{a}.id as {a}_id" for a in O.DIMS)
    joins = " ".join(f"join d_{a} on t.{a} is not distinct from d_{a}.{a}_key" for a in O.DIMS)
    add("fact_payment_keep_unknown", unknown, O.mart_ctes(report) + f"select {ids}, t.is_vip, t.tot_sum from r t {joins}")

    def planted(spark, sf):
        wh = loaded(spark, sf)
        return marts.fact_fk_violations(wh.read("fact"), {d: read(wh).where("id % 3 <> 1") for d, read in dims.items()})
    add("fact_fk_planted", planted, O.mart_ctes(report) + " union all ".join(
        f"select '{a}_id' as foreign_key, f.{a}_id as id from f where f.{a}_id is not null "
        f"and not exists (select 1 from d_{a} d where d.id = f.{a}_id and d.id % 3 <> 1)" for a in O.DIMS))

    def stable(spark, sf):
        """Registration years known from the users of the first districts keep their ids when the others come in."""
        rows = loaded(spark, sf).read("report_tmp")
        return marts.dimension(rows, "registration_year", marts.dimension(rows.where("district < 'G'"), "registration_year"))
    known = O.dim_sql(f"select * from ({report}) x where district < 'G'", "registration_year")
    add("dim_registration_year_stable", stable, (
        f"with k as materialized ({known}), n as materialized (select distinct registration_year registration_year_key from ({report}) x "
        "where not exists (select 1 from k where k.registration_year_key is not distinct from x.registration_year)) "
        "select id, registration_year_key from k union all select cast(row_number() over (order by registration_year_key asc nulls last) "
        "+ (select coalesce(max(id), 0) from k) as smallint) id, registration_year_key from n"))

    def wide(spark, sf):
        return marts.numbered_values(Q._ods_full(spark, QuirkDir(sf), "payment").select("account").distinct(), "account")
    add("account_ids", wide, quirky(
        f"select row_number() over (order by account asc nulls last) id, account from (select distinct account from ({O.ods_sql('payment', None)}) p) d"))

    # addresses of both families (SC-8)
    def addresses(spark, sf):
        ip = F.col("device_ip_addr")
        return fixtures.quirk_traffic(spark, sf).select(
            canonical(ip).alias("address"), inet_text(canonical(ip)).alias("address_text"), is_ipv4(ip).alias("is_v4")).groupBy(
            "address", "address_text", "is_v4").agg(F.count(F.lit(1)).alias("records"))
    add("inet_addresses", addresses, (
        "select device_ip_addr address, case when contains(device_ip_addr, '/') then device_ip_addr when contains(device_ip_addr, ':') "
        "then device_ip_addr || '/128' else device_ip_addr || '/32' end address_text, not contains(device_ip_addr, ':') is_v4, "
        f"count(*) records from ({fixtures.QUIRK_SQL['traffic']}) t group by 1, 2, 3"))
    add("stage_traffic_inet", lambda spark, sf: Q.staged(spark, QuirkDir(sf), "traffic", Y1), quirky(O.staged("traffic", Y1)))

    # sources and validation batches (SR-1, SR-2, SR-4..7, ST-3, ST-4, SC-12)
    def landed(spark, sf) -> str:
        root = shared_root(spark, "landing")
        feed = Q.raw(spark, sf, "payment")
        for folder, odd in (("a", 0), ("b", 1)):
            feed.where(F.col("pay_doc_num") % 2 == odd).write.parquet(f"{root}/payment/{folder}")
        return f"{root}/payment"
    add("source_scan", lambda spark, sf: readers.read_source(spark, f"{landed(spark, sf)}/*/", schemas.STG_PAYMENT),
        f"select * from ({O.RAW['payment']}) p")

    def registered(spark, sf):
        root = landed(spark, sf)
        name = f"stg_payment_{root.split('-')[-1].split('/')[0]}"
        first = readers.register_source(spark, name, f"{root}/a", schemas.STG_PAYMENT)
        again = readers.register_source(spark, name, f"{root}/b", schemas.STG_PAYMENT)
        return spark.table(name).withColumn("created", F.lit(first)).withColumn("created_again", F.lit(again))
    add("source_registered", registered,
        f"select *, true created, false created_again from ({O.RAW['payment']}) p where pay_doc_num % 2 = 0")
    path = lambda sf, t: f"{str(sf).rstrip('/')}/{t}.parquet"
    rules = [{"expectation_type": quality.NOT_NULL, "kwargs": {"column": "c_nationkey"}},
             {"expectation_type": quality.BETWEEN, "kwargs": {"column": "c_acctbal", "min_value": 0, "max_value": 9000}}]
    types = {"c_nationkey": "BIGINT", "c_acctbal": "DOUBLE"}
    checked = lambda df, suite: quality.validate(df, suite, rules, Q.RUN_NAME, Q.RUN_TIME)
    checked_sql = lambda suite, rows: O.validate_sql(rows, types, suite, rules, Q.RUN_NAME, Q.RUN_TIME)

    def table_batch(spark, sf):
        readers.batch_from_path(spark, path(sf, "customer")).createOrReplaceTempView("batch_customer")
        return checked(readers.batch_from_table(spark, "batch_customer"), "table")

    def query_batch(spark, sf):
        readers.batch_from_path(spark, path(sf, "customer")).createOrReplaceTempView("batch_customer")
        return checked(readers.batch_from_query(spark, "select * from batch_customer where c_mktsegment = 'BUILDING'"), "query")
    add("batch_path", lambda spark, sf: checked(readers.batch_from_path(spark, path(sf, "customer")), "path"),
        checked_sql("path", "select * from customer"))
    add("batch_dataframe", lambda spark, sf: checked(readers.batch_from_dataframe(fixtures.table(spark, sf, "customer")), "dataframe"),
        checked_sql("dataframe", "select * from customer"))
    add("batch_table", table_batch, checked_sql("table", "select * from customer"))
    add("batch_query", query_batch, checked_sql("query", "select * from customer where c_mktsegment = 'BUILDING'"))
    add("batch_limit", lambda spark, sf: checked(readers.limit_batch(fixtures.table(spark, sf, "customer"), 1000, ["c_custkey"]), "limit"),
        checked_sql("limit", "select * from customer order by c_custkey nulls last limit 1000"))
    add("batch_head", lambda spark, sf: readers.batch_head(
        Q.raw(spark, sf, "payment").select("pay_doc_num", "user_id", "account", "pay_date"), 5),
        f"select pay_doc_num, user_id, account, pay_date from ({O.RAW['payment']}) p order by 1, 2, 3, 4 limit 5")
    add("uuid_text", lambda spark, sf: Q.staged(spark, sf, "payment", Y1).select("pay_doc_num", uuid_text("PAYMENT_PK").alias("payment_uuid")),
        f"select pay_doc_num, cast(cast(PAYMENT_PK as uuid) as varchar) payment_uuid from ({O.staged('payment', Y1)}) p")

    # uniqueness with planted repeats, kept results of two runs one of which is repeated (DQ-5, DQ-13)
    suite, rows = quality.SUITES["payment"]
    feed_sql = quirky(O.ods_sql("payment", None))
    payment_types = {f.name: Q._duck_type(f.dataType) for f in schemas.ODS_PAYMENT.fields}

    def repeats(spark, sf):
        feed = Q._ods_full(spark, QuirkDir(sf), "payment")
        return quality.validate(feed.unionByName(feed.where("pay_doc_num % 50 = 7")), suite, rows, Q.RUN_NAME, Q.RUN_TIME)
    add("dq_planted_repeats", repeats, O.validate_sql(
        f"select * from ({feed_sql}) a union all select * from ({feed_sql}) b where pay_doc_num % 50 = 7",
        payment_types, suite, rows, Q.RUN_NAME, Q.RUN_TIME))

    def kept(spark, sf):
        wh = Warehouse(spark, shared_root(spark, "results"))
        for name, year in (("first", Y1), ("second", Y2), ("first", Y1)):
            quality.store_results(wh, quality.validate(ods.ods_payment(Q.raw(spark, sf, "payment"), year), suite, rows, name, Q.RUN_TIME))
        return quality.stored_results(wh)
    add("dq_stored_results", kept, " union all ".join(
        O.validate_sql(O.ods_sql("payment", y), payment_types, suite, rows, name, Q.RUN_TIME) for name, y in (("first", Y1), ("second", Y2))))
    return q, sql


QUERIES, ORACLE_SQL = build()
