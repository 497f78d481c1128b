"""Registered queries: one per operator of the inventory, each ``(spark,
sf_dir) -> DataFrame`` over the provided test tables, plus its DuckDB oracle.

The feeds are shaped from the test tables by ``sources.fixtures``; every step
after that runs through the library.  Batch years follow the data: payments
and billing fall in 2013-2019, issues and traffic in 2014.  Queries that need
a loaded vault (marts, pipeline) run the real yearly pipeline into a fresh
warehouse under the session's ``spark.checkpoint.dir``; that warehouse is
built once per session and input directory.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark import oracle as O
from vaultspark.operators import marts, ods, quality, staging, vault
from vaultspark.plans import pipeline
from vaultspark.sources import fixtures, schemas
from vaultspark.sources.sinks import PARTITION_COLUMN, Warehouse, shared_root

Y1, Y2 = 2013, 2014
YEARS = list(range(2013, 2020))  # years of the reference's data
SOURCE_YEAR = {"billing": Y1, "payment": Y1, "issue": Y2, "traffic": Y2}
RUN_NAME = "vaultspark-check"
RUN_TIME = "2021-05-02 12:28:24"

Query = Callable[[SparkSession, str], DataFrame]


def ld(year: int) -> dt.datetime:
    return pipeline.load_date_of(year)


# --- building blocks -------------------------------------------------------------------

def raw(spark: SparkSession, sf: str, src: str) -> DataFrame:
    if isinstance(sf, fixtures.QuirkDir) and src in ("payment", "traffic"):
        return {"payment": fixtures.quirk_payment, "traffic": fixtures.quirk_traffic}[src](spark, sf)
    return {"billing": fixtures.stg_billing, "issue": fixtures.stg_issue,
            "payment": fixtures.stg_payment, "traffic": fixtures.stg_traffic,
            "user": fixtures.mdm_user}[src](spark, sf)


def staged(spark: SparkSession, sf: str, src: str, year: int) -> DataFrame:
    if src == "mdm":
        return staging.stage(ods.ods_user(raw(spark, sf, "user")), staging.MDM, ld(year))
    if src == "early_payment":
        typed = ods.ods_payment(raw(spark, sf, "payment"), year)
        return staging.stage(typed, staging.EARLY_PAYMENT, ld(year), year)
    typed = ods.ODS_LOADERS[src](raw(spark, sf, src), year)
    return staging.stage(typed, staging.SPECS[src], ld(year), year)


def hub(spark, sf, name: str, year: int, target: DataFrame | None = None) -> DataFrame:
    srcs = pipeline.HUBS[name]
    return vault.hub_rows(name, [staged(spark, sf, s, year) for s in srcs], target)


def landed(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A table as a layer leaves it: written once and read back, like every layer of the pipeline.  A load that
    compares with the result of another load starts from its files, not from its plan: plans that hold one
    another grow with every load, and the driver with them."""
    wh = Warehouse(spark, shared_root(spark, "landed"))
    wh.replace(name, df)
    return wh.read(name, df.schema)


def sat(spark, sf, name: str, year: int, target: DataFrame | None = None) -> DataFrame:
    src = {"sat_payment": "payment", "sat_mdm": "mdm", "sat_user": "payment"}[name]
    rows = {"sat_payment": vault.sat_payment_rows, "sat_mdm": vault.sat_mdm_rows, "sat_user": vault.sat_user_rows}[name]
    batch = staged(spark, sf, src, year)
    if target is None:
        return rows(batch, target, ld(year))
    return rows(landed(spark, batch, f"mv_{src}_{year}"), target, ld(year))


def sat_history(spark, sf, name: str) -> tuple[DataFrame, DataFrame]:
    """The satellite after the first year, and what the second year adds."""
    first = landed(spark, sat(spark, sf, name, Y1), name)
    return first, landed(spark, sat(spark, sf, name, Y2, first), name)


def link(spark, sf, year: int, target: DataFrame | None = None) -> DataFrame:
    return vault.link_payment_rows(staged(spark, sf, "payment", year), target)


_WAREHOUSES: dict[tuple[str, str, str], Warehouse] = {}


def loaded_vault(spark: SparkSession, sf: str) -> Warehouse:
    """The warehouse after the yearly pipeline over all years (built once)."""
    key = (spark.sparkContext.applicationId, repr(type(sf)), str(sf))
    wh = _WAREHOUSES.get(key)
    if wh is None:
        wh = Warehouse.for_vault(spark, shared_root(spark, "vault"))
        feeds = (fixtures.quirk_sources if isinstance(sf, fixtures.QuirkDir) else fixtures.raw_sources)(spark, sf)
        pipeline.run_years(spark, wh, feeds, YEARS)
        _WAREHOUSES[key] = wh
    return wh


def _dims(wh: Warehouse) -> dict[str, DataFrame]:
    return {d: wh.read(f"dim_{d}") for d in marts.DIMENSIONS}


def _ods_full(spark, sf, src: str) -> DataFrame:
    if src == "user":
        return ods.ods_user(raw(spark, sf, "user"))
    return ods.ODS_LOADERS[src](raw(spark, sf, src), None)


def _suite_subset(kind: str | None) -> list[tuple[str, str, list[dict]]]:
    out = []
    for src, (name, exps) in quality.SUITES.items():
        chosen = exps if kind is None else [e for e in exps if e["expectation_type"] == kind]
        if chosen:
            out.append((src, name, chosen))
    return out


def _dq(spark, sf, kind: str | None, only: str | None = None) -> DataFrame:
    parts = []
    for src, name, exps in _suite_subset(kind):
        if only and src != only:
            continue
        parts.append(quality.validate(_ods_full(spark, sf, src), name, exps, RUN_NAME, RUN_TIME))
    return reduce(DataFrame.unionByName, parts)


# --- the registry --------------------------------------------------------------------------

def build() -> tuple[dict[str, Query], dict[str, str]]:
    q: dict[str, Query] = {}
    sql: dict[str, str] = {}

    # ODS typed loads (PR-1..5, FL-1..2, SC-*)
    for src, year in SOURCE_YEAR.items():
        q[f"ods_{src}"] = (lambda s, y: lambda spark, sf: ods.ODS_LOADERS[s](raw(spark, sf, s), y))(src, year)
        sql[f"ods_{src}"] = O.ods_sql(src, year)
        q[f"ods_{src}_hive"] = (lambda s, y: lambda spark, sf: ods.HIVE_LOADERS[s](raw(spark, sf, s), y))(src, year)
        sql[f"ods_{src}_hive"] = O.ods_hive_sql(src, year)
    q["ods_user"] = lambda spark, sf: ods.ods_user(raw(spark, sf, "user"))
    sql["ods_user"] = O.ods_sql("user", None)

    def ods_partition_label(spark, sf):
        parts = [pipeline.partition_labels(_ods_full(spark, sf, s), schemas.ODS_DATE_COLUMN[s])
                 .select(F.lit(s).alias("source"), PARTITION_COLUMN, "row_count")
                 for s in ("billing", "issue", "payment", "traffic")]
        return reduce(DataFrame.unionByName, parts)
    q["ods_partition_label"] = ods_partition_label
    sql["ods_partition_label"] = " union all ".join(
        f"select '{s}' source, {O.partition_label_sql(chr(34) + schemas.ODS_DATE_COLUMN[s] + chr(34))} "
        f"{PARTITION_COLUMN}, count(*) row_count from ({O.ods_sql(s, None)}) o group by 1, 2"
        for s in ("billing", "issue", "payment", "traffic"))

    def ods_year_reload(spark, sf):
        wh = Warehouse(spark, shared_root(spark, "ods-reload"))
        feed = {"payment": raw(spark, sf, "payment")}
        for year in (Y1, Y1, Y2):  # the second Y1 load is a rerun: it replaces, never duplicates
            wh.create_if_missing("ods_payment", pipeline._with_part(schemas.ODS_PAYMENT), PARTITION_COLUMN)
            wh.overwrite_partition("ods_payment", str(year), ods.ods_payment(feed["payment"], year))
        return wh.read("ods_payment", pipeline._with_part(schemas.ODS_PAYMENT))
    q["ods_year_reload"] = ods_year_reload
    sql["ods_year_reload"] = " union all ".join(
        f"select *, '{y}' {PARTITION_COLUMN} from ({O.ods_sql('payment', y)}) o" for y in (Y1, Y2))

    # staging (DV-4..9)
    for src in ("mdm", "billing", "payment", "issue", "traffic"):
        year = SOURCE_YEAR.get(src, Y1)
        q[f"stage_{src}"] = (lambda s, y: lambda spark, sf: staged(spark, sf, s, y))(src, year)
        sql[f"stage_{src}"] = O.staged(src, year)

    # hubs (DV-10..13)
    for name in pipeline.HUBS:
        q[f"hub_{name}"] = (lambda n: lambda spark, sf: hub(spark, sf, n, Y1))(name)
        sql[f"hub_{name}"] = O.hub_sql(name, Y1)
        q[f"hub_{name}_second_year"] = (
            lambda n: lambda spark, sf: hub(spark, sf, n, Y2, hub(spark, sf, n, Y1)))(name)
        sql[f"hub_{name}_second_year"] = O.hub_sql(name, Y2, O.hub_sql(name, Y1))

    # link (DV-14)
    q["link_payment"] = lambda spark, sf: link(spark, sf, Y1)
    sql["link_payment"] = O.link_sql(O.staged("payment", Y1))
    q["link_payment_second_year"] = lambda spark, sf: link(spark, sf, Y2, link(spark, sf, Y1))
    sql["link_payment_second_year"] = O.link_sql(O.staged("payment", Y2), O.link_sql(O.staged("payment", Y1)))

    # satellites (DV-15..17)
    for name in ("sat_payment", "sat_user", "sat_mdm"):
        q[name] = (lambda n: lambda spark, sf: sat(spark, sf, n, Y1))(name)
        sql[name] = O.sat_year(name, Y1)

        def second(spark, sf, n=name):
            return sat(spark, sf, n, Y2, landed(spark, sat(spark, sf, n, Y1), n))

        def rerun(spark, sf, n=name):
            first, second = sat_history(spark, sf, n)
            return sat(spark, sf, n, Y2, first.unionByName(second))
        q[f"{name}_second_year"] = second
        sql[f"{name}_second_year"] = O.sat_second_year(name, Y1, Y2)
        q[f"{name}_rerun"] = rerun
        sql[f"{name}_rerun"] = O.sat_rerun(name, Y1, Y2)

    # the satellite building blocks on their own (WN-3 + FL-4, JN-4 + FL-6, WN-4)
    def sat_user_changes(spark, sf):
        p = staged(spark, sf, "payment", Y1)
        return vault.collapse_repeats(p, "USER_PK", "phone", ["EFFECTIVE_FROM", "pay_doc_num"]).select(
            "USER_PK", "USER_HASHDIFF", "phone", "pay_doc_num", "EFFECTIVE_FROM")
    q["sat_user_changes"] = sat_user_changes
    sql["sat_user_changes"] = (f"select USER_PK, USER_HASHDIFF, phone, pay_doc_num, EFFECTIVE_FROM "
                               f"from ({O.sat_user_src(Y1)}) c")

    def sat_update_records(spark, sf):
        history = sat(spark, sf, "sat_payment", Y1).unionByName(sat(spark, sf, "sat_payment", Y2))
        batch = staged(spark, sf, "payment", Y1)
        return vault.history_as_of(history, None, batch, "PAYMENT_PK")
    q["sat_update_records"] = sat_update_records
    hist = f"({O.sat_year('sat_payment', Y1)}) union all ({O.sat_year('sat_payment', Y2)})"
    sql["sat_update_records"] = (
        f"select * from ({hist}) a where exists (select 1 from ({O.staged('payment', Y1)}) b "
        "where a.PAYMENT_PK = b.PAYMENT_PK and a.LOAD_DATE <= b.LOAD_DATE)")

    def latest_sat_states(spark, sf):
        first, second = sat_history(spark, sf, "sat_user")
        return vault.latest_states(first.unionByName(second), "USER_PK", "USER_HASHDIFF")
    q["latest_sat_states"] = latest_sat_states
    first_sql = O.sat_year("sat_user", Y1)
    hist_sql = f"({first_sql}) union all ({O.sat_year('sat_user', Y2, first_sql)})"
    sql["latest_sat_states"] = (
        "select distinct USER_PK, USER_HASHDIFF from (select USER_PK, USER_HASHDIFF, rank() over "
        f"(partition by USER_PK order by LOAD_DATE desc) rk from ({hist_sql}) h) x where rk = 1")

    # earlier payment vault (DV-18)
    q["hub_paydoc"] = lambda spark, sf: vault.hub_rows("paydoc", [staged(spark, sf, "early_payment", Y1)])
    sql["hub_paydoc"] = O.hub_sql("paydoc", Y1, sources=("early_payment",))
    q["link_paydoc_payment"] = lambda spark, sf: vault.link_paydoc_payment_rows(
        staged(spark, sf, "early_payment", Y1))
    sql["link_paydoc_payment"] = O.link_sql(O.staged("early_payment", Y1), pk="PAY_PK",
                                            fks=["PAYDOC_PK", "USER_PK", "ACCOUNT_PK", "BILLING_PERIOD_PK"])
    q["sat_pay"] = lambda spark, sf: vault.sat_pay_rows(staged(spark, sf, "early_payment", Y1))
    sql["sat_pay"] = O.sat_sql(O.staged("early_payment", Y1), "PAY_PK", "PAY_HASHDIFF", ["sum"], Y1)

    # marts over the vault loaded for every year (MT-1..7, JN-8, AG-5)
    report = O.report_sql(YEARS)
    q["report_payment"] = lambda spark, sf: loaded_vault(spark, sf).read("report_tmp")
    sql["report_payment"] = report
    for d in marts.DIMENSIONS:
        q[f"dim_{d}"] = (lambda n: lambda spark, sf: loaded_vault(spark, sf).read(f"dim_{n}"))(d)
        sql[f"dim_{d}"] = O.dim_sql(report, d)
    q["fact_payment"] = lambda spark, sf: loaded_vault(spark, sf).read("fact")
    sql["fact_payment"] = O.fact_sql(report)

    def fk(spark, sf):
        wh = loaded_vault(spark, sf)
        return marts.fact_fk_violations(wh.read("fact"), _dims(wh))
    q["fact_fk_violations"] = fk
    sql["fact_fk_violations"] = O.fk_violations_sql(report)
    q["dm_traffic"] = lambda spark, sf: marts.traffic_mart(
        ods.ods_traffic(raw(spark, sf, "traffic"), Y2))
    sql["dm_traffic"] = O.dm_traffic_sql(Y2)

    # data quality (DQ-1..12)
    types = {src: {f.name: _duck_type(f.dataType) for f in schemas.ODS[src].fields}
             for src in quality.SUITES}

    def dq_sql(kind, only=None):
        parts = []
        for src, name, exps in _suite_subset(kind):
            if only and src != only:
                continue
            parts.append(O.validate_sql(O.ods_sql(src, None), types[src], name, exps, RUN_NAME, RUN_TIME))
        return " union all ".join(parts)

    for short, kind in (("not_null", quality.NOT_NULL), ("type", quality.OF_TYPE),
                        ("between", quality.BETWEEN), ("regex", quality.REGEX),
                        ("compound_unique", quality.COMPOUND_UNIQUE), ("in_set", quality.IN_SET),
                        ("equal_set", quality.EQUAL_SET)):
        q[f"dq_{short}"] = (lambda k: lambda spark, sf: _dq(spark, sf, k))(kind)
        sql[f"dq_{short}"] = dq_sql(kind)
    for src in quality.SUITES:
        q[f"dq_suite_{src}"] = (lambda s: lambda spark, sf: _dq(spark, sf, None, s))(src)
        sql[f"dq_suite_{src}"] = dq_sql(None, src)

    def dq_run_results(spark, sf):
        batches = [(_ods_full(spark, sf, s), n, e) for s, (n, e) in quality.SUITES.items()]
        return quality.validate_batches(batches, RUN_NAME, RUN_TIME)
    q["dq_run_results"] = dq_run_results
    sql["dq_run_results"] = dq_sql(None)

    # pipeline (PL-1, PL-2)
    def run_year(spark, sf):
        wh = Warehouse.for_vault(spark, shared_root(spark, "run-year"))
        pipeline.run_year(spark, wh, fixtures.raw_sources(spark, sf), Y1, build_marts=True)
        return pipeline.table_counts(spark, wh, pipeline.VAULT_TABLES + pipeline.MART_TABLES)
    q["run_year"] = run_year
    sql["run_year"] = _run_year_counts_sql(Y1)

    def run_years(spark, sf):
        wh = loaded_vault(spark, sf)
        return pipeline.table_counts(spark, wh, pipeline.VAULT_TABLES + pipeline.MART_TABLES)
    def hive_year(spark, sf):
        wh = Warehouse(spark, shared_root(spark, "hive-year"))
        pipeline.run_hive_year(spark, wh, fixtures.raw_sources(spark, sf), Y2)
        return pipeline.table_counts(spark, wh, pipeline.HIVE_TABLES)
    q["hive_year"] = hive_year
    hive_tables = {f"hive_ods_{s}": O.ods_hive_sql(s, Y2) for s in ("billing", "issue", "payment", "traffic")}
    hive_tables["dm_traffic"] = O.dm_traffic_sql(Y2)
    sql["hive_year"] = " union all ".join(
        f"select '{n}' table_name, cast(count(*) as bigint) row_count from ({t}) x" for n, t in hive_tables.items())

    def early_vault_year(spark, sf):
        wh = Warehouse.for_vault(spark, shared_root(spark, "early-vault"))
        pipeline.run_early_vault_year(spark, wh, raw(spark, sf, "payment"), Y1)
        return pipeline.table_counts(spark, wh, pipeline.EARLY_TABLES)
    q["early_vault_year"] = early_vault_year
    early = O.staged("early_payment", Y1)
    early_tables = {f"hub_{h}": O.hub_sql(h, Y1, sources=("early_payment",))
                    for h in ("user", "account", "billing_period", "paydoc")}
    early_tables["link_paydoc_payment"] = O.link_sql(
        early, pk="PAY_PK", fks=["PAYDOC_PK", "USER_PK", "ACCOUNT_PK", "BILLING_PERIOD_PK"])
    early_tables["sat_user"] = O.sat_sql(O.sat_user_src(Y1, "early_payment"), "USER_PK", "USER_HASHDIFF",
                                         ["phone"], Y1)
    early_tables["sat_pay"] = O.sat_sql(early, "PAY_PK", "PAY_HASHDIFF", ["sum"], Y1)
    sql["early_vault_year"] = " union all ".join(
        f"select '{n}' table_name, cast(count(*) as bigint) row_count from ({t}) x" for n, t in early_tables.items())

    q["run_years"] = run_years
    sql["run_years"] = _run_years_counts_sql(YEARS)
    return q, sql


def _duck_type(t) -> str:
    name = t.simpleString()
    return {"int": "INTEGER", "bigint": "BIGINT", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
            "string": "VARCHAR", "boolean": "BOOLEAN", "smallint": "SMALLINT"}.get(
        name, "DECIMAL" if name.startswith("decimal") else name.upper())


def _run_year_counts_sql(year: int) -> str:
    tables = {
        "hub_user": O.hub_sql("user", year), "hub_account": O.hub_sql("account", year),
        "hub_billing_period": O.hub_sql("billing_period", year),
        "hub_pay_doc_type": O.hub_sql("pay_doc_type", year),
        "link_payment": O.link_sql(O.staged("payment", year)),
        "sat_user": O.sat_year("sat_user", year), "sat_payment": O.sat_year("sat_payment", year),
        "sat_mdm": O.sat_year("sat_mdm", year), "report_tmp": "select * from r",
    }
    for d in marts.DIMENSIONS:
        tables[f"dim_{d}"] = f"select * from d_{d}"
    tables["fact"] = "select * from f"
    return O.mart_ctes(O.report_sql([year])) + " union all ".join(
        f"select '{n}' table_name, cast(count(*) as bigint) row_count from ({s}) x" for n, s in tables.items())


def chain(ctes: list[str], prefix: str, years: list[int], year_sql) -> str:
    """Add one CTE per year for a table, each year's load running against the table of the year before; its last name."""
    prev = None
    for n, y in enumerate(years):
        name = f"{prefix}_{n}_{y}"
        new = year_sql(y, f"select * from {prev}" if prev else None)
        body = new if prev is None else f"select * from {prev} union all ({new})"
        ctes.append(f"{name} as materialized ({body})")
        prev = name
    return prev


def vault_loads() -> dict[str, Callable[[int, str | None], str]]:
    """The reference-style load of each vault table: (year, table before) -> rows."""
    loads = {f"hub_{h}": (lambda y, t, h=h: O.hub_sql(h, y, t)) for h in pipeline.HUBS}
    loads["link_payment"] = lambda y, t: O.link_sql(O.staged("payment", y), t)
    for name in ("sat_user", "sat_payment", "sat_mdm"):
        loads[name] = lambda y, t, n=name: O.sat_year(n, y, t)
    return loads


def loaded_table_sql(table: str, years: list[int]) -> str:
    """A vault table after loading ``years`` in order."""
    ctes: list[str] = []
    last = chain(ctes, table, years, vault_loads()[table])
    return f"with {', '.join(ctes)} select * from {last}"


def _run_years_counts_sql(years: list[int]) -> str:
    """Row counts after loading ``years`` in order: every table is a chain of
    materialised CTEs, one per year, each year's load (reference-style SQL)
    running against the previous year's table."""
    ctes: list[str] = []
    tables = {name: chain(ctes, name, years, loads) for name, loads in vault_loads().items()}
    tables["report_tmp"] = "r"
    for d in marts.DIMENSIONS:
        tables[f"dim_{d}"] = f"d_{d}"
    tables["fact"] = "f"
    marts_sql = O.mart_ctes(O.report_sql(years))
    assert marts_sql.startswith("with ")
    head = "with " + ", ".join(ctes) + ", " + marts_sql[len("with "):]
    order = pipeline.VAULT_TABLES + pipeline.MART_TABLES
    return head + " union all ".join(
        f"select '{n}' table_name, cast(count(*) as bigint) row_count from {tables[n]}" for n in order)


QUERIES, ORACLE_SQL = build()
