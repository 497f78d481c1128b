"""Yearly batch (PL-1), backfill (PL-2) and the earlier payment vault (DV-18).

The driver only orders the layers; each layer is one or a few Spark jobs whose
results are written to the warehouse.  Those writes are the lineage cuts: every
layer reads the previous one back from durable storage, so a lost executor
costs a task retry, never a recomputation of earlier layers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultspark.functions.scalar import epoch_millis_of_year, epoch_millis_to_ts, year_range
from vaultspark.operators import marts, ods, staging, vault
from vaultspark.sources import schemas
from vaultspark.sources.sinks import CODEC, PARTITION_COLUMN, Journal, Warehouse, partition_label

ODS_SOURCES = ("billing", "issue", "payment", "traffic")
STAGED = ("billing", "issue", "payment", "traffic")
HUBS = {  # hub -> stagings it loads from, in the reference's order
    "user": ("payment", "mdm", "billing", "issue", "traffic"),
    "account": ("payment",),
    "billing_period": ("payment", "billing"),
    "pay_doc_type": ("payment",),
}
VAULT_TABLES = ["hub_user", "hub_account", "hub_billing_period", "hub_pay_doc_type",
                "link_payment", "sat_user", "sat_payment", "sat_mdm"]
MART_TABLES = ["report_tmp"] + [f"dim_{d}" for d in marts.DIMENSIONS] + ["fact"]


def load_date_of(year: int) -> dt.datetime:
    """The batch of year Y is stamped with the run's execution date, Y-01-01."""
    return dt.datetime(year, 1, 1)


def _with_part(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(PARTITION_COLUMN, T.StringType(), True)])


def in_parallel(tasks: list[Callable[[], object]], parallel: bool = True) -> list:
    """Run the independent loads of one layer.  Each task is its own Spark job
    (one table write); submitted from a thread pool they share the cluster, as
    the reference runs a layer's tasks side by side.  The layer ends when all
    are done, so the next layer sees complete tables."""
    if not parallel or len(tasks) < 2:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = [pool.submit(t) for t in tasks]
        return [f.result() for f in futures]


def _read_or_empty(wh: Warehouse, name: str, schema: T.StructType) -> DataFrame:
    wh.create_if_missing(name, schema)
    return wh.read(name, schema)


# --- layers -----------------------------------------------------------------------------

def load_ods(wh: Warehouse, raw: dict[str, DataFrame], year: int, parallel: bool = True) -> None:
    """SK-2: truncate-and-insert of the year's partition for each feed; the MDM
    snapshot is written once (SR-3)."""
    def one(src):
        name = f"ods_{src}"
        wh.create_if_missing(name, _with_part(schemas.ODS[src]), partition_by=PARTITION_COLUMN)
        wh.overwrite_partition(name, str(year), ods.ODS_LOADERS[src](raw[src], year))
    tasks = [lambda s=src: one(s) for src in ODS_SOURCES]
    tasks.append(lambda: wh.write_once("ods_user", ods.ods_user(raw["user"])))
    in_parallel(tasks, parallel)


def _raw_years(src: str, years: list[int]):
    """Rows of the given batch years on a feed's raw column: a pushable range
    over the span, refined to the listed years."""
    col = schemas.ODS_DATE_COLUMN[src]
    first, last = years[0], years[-1]
    if src == "traffic":
        lo, hi = epoch_millis_of_year(first), epoch_millis_of_year(last + 1)
        span = (F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi))
        year = F.year(epoch_millis_to_ts(col))
    else:
        span = year_range(col, first, last, "timestamp" if src == "issue" else "date")
        year = F.year(F.col(col))
    return span & year.isin(years)


def load_ods_backfill(wh: Warehouse, raw: dict[str, DataFrame], years,
                      parallel: bool = True) -> None:
    """ODS for a whole backfill in one pass per feed.

    Equal to one yearly truncate-and-insert per year: each feed is typed once,
    restricted to the range (a pushable filter on the raw column) and routed to
    its year partitions with a dynamic overwrite; then the partitions of listed
    years without rows are dropped, as the static reload empties them.  A failure
    in between leaves every year with its old or its new rows.  The raw feeds are
    read once instead of once per year.
    """
    years = sorted(set(years))
    labels = [str(y) for y in years]

    def one(src):
        name = f"ods_{src}"
        wh.create_if_missing(name, _with_part(schemas.ODS[src]), partition_by=PARTITION_COLUMN)
        typed = ods.ODS_LOADERS[src](raw[src].where(_raw_years(src, years)), None)
        label = F.year(F.col(schemas.ODS_DATE_COLUMN[src])).cast("string")
        filled = wh.overwrite_partitions(name, typed.withColumn(PARTITION_COLUMN, label))
        wh.drop_partitions(name, [y for y in labels if y not in filled])
    tasks = [lambda s=src: one(s) for src in ODS_SOURCES]
    tasks.append(lambda: wh.write_once("ods_user", ods.ods_user(raw["user"])))
    in_parallel(tasks, parallel)


def load_ods_full(wh: Warehouse, raw: dict[str, DataFrame], src: str) -> None:
    """Full load of one feed routed to every range partition (SK-1); rows
    outside the year range land in ``before_2013`` / ``badyear``."""
    name = f"ods_{src}"
    typed = ods.with_partition_label(ods.ODS_LOADERS[src](raw[src], None), src)
    (typed.write.options(**CODEC).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(PARTITION_COLUMN).parquet(wh.path(name)))


def ods_slice(wh: Warehouse, src: str, year: int) -> DataFrame:
    """One year of an ODS table: partition filter (pruned directories)."""
    df = wh.read(f"ods_{src}", _with_part(schemas.ODS[src]))
    return df.where(F.col(PARTITION_COLUMN) == F.lit(str(year))).drop(PARTITION_COLUMN)


def load_staging(wh: Warehouse, year: int, load_date: dt.datetime,
                 parallel: bool = True) -> dict[str, DataFrame]:
    """SK-6: one staging table per source and year (mdm: one), read back."""
    def one(src):
        name = f"mv_{src}_{year}"
        wh.replace(name, staging.stage(ods_slice(wh, src, year), staging.SPECS[src], load_date, year))
    tasks = [lambda s=src: one(s) for src in STAGED]
    tasks.append(lambda: wh.replace(
        "mv_mdm", staging.stage(wh.read("ods_user", schemas.ODS_USER), staging.MDM, load_date)))
    in_parallel(tasks, parallel)
    return staged_tables(wh, year)


def staged_tables(wh: Warehouse, year: int) -> dict[str, DataFrame]:
    """The staging tables of a year, read back."""
    out = {src: wh.read(f"mv_{src}_{year}") for src in STAGED}
    out["mdm"] = wh.read("mv_mdm")
    return out


def load_hubs(wh: Warehouse, stg: dict[str, DataFrame], parallel: bool = True) -> None:
    def one(hub, sources):
        name = f"hub_{hub}"
        target = _read_or_empty(wh, name, schemas.hub_schema(hub))
        wh.append(name, vault.hub_rows(hub, [stg[s] for s in sources], target))
    in_parallel([lambda h=h, s=s: one(h, s) for h, s in HUBS.items()], parallel)


def load_links(wh: Warehouse, stg: dict[str, DataFrame]) -> None:
    target = _read_or_empty(wh, "link_payment", schemas.LINK_PAYMENT)
    wh.append("link_payment", vault.link_payment_rows(stg["payment"], target))


SATS = {  # satellite -> (schema, loader, staging it reads, key, hash diff)
    "sat_user": (schemas.SAT_USER, vault.sat_user_rows, "payment", "USER_PK", "USER_HASHDIFF"),
    "sat_payment": (schemas.SAT_PAYMENT, vault.sat_payment_rows, "payment", "PAYMENT_PK", "PAY_DOC_HASHDIFF"),
    "sat_mdm": (schemas.SAT_MDM, vault.sat_mdm_rows, "mdm", "MDM_PK", "MDM_HASHDIFF"),
}
VERSION = "version"
#: Deltas of a satellite's states that may be open before they are merged into a new base.
OPEN_DELTAS = 4


def _latest_schema(pk: str, hd: str) -> T.StructType:
    return T.StructType([T.StructField(pk, T.StringType()), T.StructField(hd, T.StringType()),
                         T.StructField("LOAD_DATE", T.TimestampNTZType()),
                         T.StructField(VERSION, T.IntegerType())])


def _versions(wh: Warehouse, name: str, schema: T.StructType) -> list[int]:
    """Versions of a latest-state table (one per loaded year: a handful of rows)."""
    return sorted(map(int, wh.partitions(name, VERSION)))


def _chain(wh: Warehouse, name: str, before: int) -> tuple[DataFrame | None, int | None, int | None, list[int]]:
    """(states, last version, base version, open deltas) of the chain of versions before a year.

    ``<sat>_base`` holds the latest states of every key as of its version, ``<sat>_latest`` one delta
    for each later version: the states loaded since the version before it."""
    _, _, _, pk, hd = SATS[name]
    schema = _latest_schema(pk, hd)
    base = max((v for v in _versions(wh, f"{name}_base", schema) if v < before), default=None)
    deltas = [v for v in _versions(wh, f"{name}_latest", schema) if v < before and (base is None or v > base)]
    parts = []
    if base is not None:
        parts.append(wh.read(f"{name}_base", schema).where(F.col(VERSION) == base))
    if deltas:
        parts.append(wh.read(f"{name}_latest", schema).where(F.col(VERSION).isin(deltas)))
    last = max([*deltas, *([] if base is None else [base])], default=None)
    return (reduce(DataFrame.unionByName, parts).drop(VERSION) if parts else None), last, base, deltas


def known_states(wh: Warehouse, name: str, sat: DataFrame, year: int) -> tuple[DataFrame, int | None]:
    """Rows (key, hash diff, load date) whose latest states equal those of the satellite's history up to
    ``year``, and the last version they rest on: the chain, and the history loaded after its last version.

    That tail is empty in a forward load: a filter on LOAD_DATE that the row groups' statistics
    answer.  It holds the first load's rows in a rerun, and those of loads whose version was never
    written, so a crash in between needs no special case."""
    _, _, _, pk, hd = SATS[name]
    states, last, _, _ = _chain(wh, name, year)
    tail = sat if last is None else sat.where(F.col("LOAD_DATE") > vault.load_timestamp(load_date_of(last)))
    tail = tail.select(pk, hd, "LOAD_DATE")
    return (tail if states is None else states.unionByName(tail)), last


def advance_states(wh: Warehouse, name: str, sat: DataFrame, year: int) -> None:
    """Write the delta of ``year``; with more than ``OPEN_DELTAS`` of them merge the chain into a new base
    and drop what it replaces.  State rows never exceed one version of the keys and the open deltas."""
    _, _, _, pk, hd = SATS[name]
    _, last, _, _ = _chain(wh, name, year)
    tail = vault.history_as_of(sat, load_date_of(year))
    if last is not None:
        tail = tail.where(F.col("LOAD_DATE") > vault.load_timestamp(load_date_of(last)))
    # all states of the tail, one of several effective dates more than once: the chain is reduced when it is read
    delta = tail.where(F.col(pk).isNotNull() & F.col(hd).isNotNull()).select(pk, hd, "LOAD_DATE")
    wh.overwrite_partition(f"{name}_latest", str(year), delta, column=VERSION)
    states, _, base, deltas = _chain(wh, name, year + 1)
    if len(deltas) > OPEN_DELTAS:
        latest = vault.merged_states(vault.pack(states, pk, hd), pk, hd)
        wh.overwrite_partition(f"{name}_base", str(year), vault.unpack(latest, *vault.texts(states, pk, hd)), column=VERSION)
        # the new base is committed: from here on nothing reads what it replaces
        wh.drop_partitions(f"{name}_latest", [str(v) for v in deltas], column=VERSION)
        if base is not None:
            wh.drop_partitions(f"{name}_base", [str(base)], column=VERSION)


def load_sat(wh: Warehouse, name: str, staging_df: DataFrame, load_date: dt.datetime,
             incremental: bool = True, journal: Journal | None = None) -> None:
    """One satellite load.

    The rows to insert are appended as they are found, without a table of their own: the files read are those
    listed before the write, and a load that is repeated compares with what the first has committed.  Nor are
    they ranged: a batch's hash keys are spread over all ranges, so that would cost an exchange and let no load skip a file.  With ``incremental`` the comparison reads the chain of
    latest states (:func:`known_states`) instead of the whole history, cut to the keys
    of the batch in either case, and the year adds its delta (:func:`advance_states`).  A
    rerun of a loaded year drops that year's and later versions first: they rest on
    what it changes.

    In an atomic warehouse the load's rows are a part of their own, ``<year>.<n>`` for its n-th load.  A
    load that is repeated after it was stopped (``journal`` has noted its part) neither
    compares with that part nor adds a second one."""
    schema, loader, _, pk, hd = SATS[name]
    year = load_date.year
    wh.create_if_missing(name, schema)
    part = None
    if wh.atomic:
        def fresh():
            return f"{year}.{sum(p.startswith(f'{year}.') for p in wh.parts(name)) + 1}"
        part = fresh() if journal is None else journal.note(f"{year}-{name}-part", fresh)
    sat = wh.read(name, schema, part) if part else wh.read(name, schema)
    states = sat
    if incremental:
        for table in (f"{name}_latest", f"{name}_base"):
            wh.drop_partitions(table, [str(v) for v in _versions(wh, table, schema) if v >= year], column=VERSION)
        states, _ = known_states(wh, name, sat, year)
    wh.append(name, loader(staging_df, states, as_of=load_date), columns=schema.names, part=part)
    if incremental:
        advance_states(wh, name, wh.read(name, schema), year)


def load_sats(wh: Warehouse, stg: dict[str, DataFrame], load_date: dt.datetime,
              parallel: bool = True, incremental: bool = True, journal: Journal | None = None) -> None:
    in_parallel([lambda n=n: load_sat(wh, n, stg[SATS[n][2]], load_date, incremental, journal)
                 for n in SATS], parallel)


REPORT_STATE = "report_state"
STATE_YEAR = "load_year"
STATE_SCHEMA = T.StructType([T.StructField("USER_PK", T.StringType()), T.StructField("billing_year", T.IntegerType()),
                             T.StructField("tot", T.LongType()), T.StructField(STATE_YEAR, T.IntegerType())])


def advance_report(wh: Warehouse, year: int) -> None:
    """The sums per user and billing year of the payments loaded in ``year``: a filter on LOAD_DATE that skips
    the files of other loads, and the link rows of their keys.  The delta of a year is replaced as a whole."""
    sat = wh.read("sat_payment", schemas.SAT_PAYMENT)
    loaded = sat.where(F.col("LOAD_DATE") == vault.load_timestamp(load_date_of(year)))
    sums = marts.user_year_sums(wh.read("link_payment", schemas.LINK_PAYMENT), loaded,
                                wh.read("hub_billing_period", schemas.hub_schema("billing_period")))
    wh.overwrite_partition(REPORT_STATE, str(year), sums, column=STATE_YEAR)


def report_sums(wh: Warehouse) -> DataFrame:
    """The deltas of all loaded years; those that are missing since their year was loaded are written now."""
    sat = wh.read("sat_payment", schemas.SAT_PAYMENT)
    # one row per loaded year
    loaded = [r.y for r in sat.where(F.col("LOAD_DATE").isNotNull()).select(F.year("LOAD_DATE").alias("y")).distinct().collect()]
    wh.create_if_missing(REPORT_STATE, STATE_SCHEMA, partition_by=STATE_YEAR)
    held = set(map(int, wh.partitions(REPORT_STATE, STATE_YEAR)))
    missing = sorted(set(loaded) - held)
    in_parallel([lambda y=y: advance_report(wh, y) for y in missing], parallel=not wh.atomic)
    return wh.read(REPORT_STATE, STATE_SCHEMA).drop(STATE_YEAR)


def load_marts(wh: Warehouse, parallel: bool = True, keep_ids: bool = False, keep_unknown: bool = False) -> None:
    """MT-1..7: report, five dimensions, fact (each replaced, then read back).

    The report is summed from the yearly deltas, not from the payments.  With ``keep_ids`` values keep
    the ids they had in the dimensions of the last build; ``keep_unknown`` as in :func:`marts.fact`."""
    report = marts.report_of_sums(
        report_sums(wh), wh.read("hub_user", schemas.hub_schema("user")), wh.read("ods_user", schemas.ODS_USER), order=True)
    wh.replace("report_tmp", report)
    report = wh.read("report_tmp", schemas.REPORT)

    def one(d):
        name = f"dim_{d}"
        if keep_ids and wh.exists(name):  # written aside first: a table cannot be read and replaced in one job
            wh.replace(f"_{name}", marts.dimension(report, d, wh.read(name)))
            wh.replace(name, wh.read(f"_{name}"))
        else:
            wh.replace(name, marts.dimension(report, d))
    in_parallel([lambda d=d: one(d) for d in marts.DIMENSIONS], parallel)
    dims = {d: wh.read(f"dim_{d}") for d in marts.DIMENSIONS}
    wh.replace("fact", marts.fact(report, dims, keep_unknown))


def run_year(spark: SparkSession, wh: Warehouse, raw: dict[str, DataFrame], year: int,
             build_marts: bool = True, parallel: bool = True, ods_loaded: bool = False,
             journal: Journal | None = None) -> None:
    """PL-1: ODS -> staging -> hubs -> link -> satellites (-> marts); each layer
    complete before the next, the loads inside a layer side by side.  A ``journal`` notes
    the finished layers and skips those that are."""
    def step(name, action):
        if journal is None:
            action()
        else:
            journal.step(f"{year}-{name}", action)
    ld = load_date_of(year)
    if not ods_loaded:
        step("ods", lambda: load_ods(wh, raw, year, parallel))
    step("staging", lambda: load_staging(wh, year, ld, parallel))
    stg = staged_tables(wh, year)
    step("hubs", lambda: load_hubs(wh, stg, parallel))
    step("links", lambda: load_links(wh, stg))
    step("uncounted", lambda: wh.drop_partitions(REPORT_STATE, [str(year)], column=STATE_YEAR))  # until the next marts
    step("sats", lambda: load_sats(wh, stg, ld, parallel, journal=journal))
    if build_marts:
        step("marts", lambda: load_marts(wh, parallel))


def run_years(spark: SparkSession, wh: Warehouse, raw: dict[str, DataFrame], years,
              parallel: bool = True, backfill_ods: bool = True, run: str | None = None) -> None:
    """PL-2: years strictly in order, one at a time; marts only after the newest.
    With ``backfill_ods`` the ODS of the whole range is loaded in one pass first
    (same partitions as the yearly reloads); the vault years then run in order.

    A backfill with a name (``run``) keeps a journal: called again after it was stopped it goes on with the
    first unfinished layer, and in an atomic warehouse ends with the tables of a run that was not
    stopped.  The journal goes when the run is finished."""
    years = sorted(set(years))
    journal = Journal(wh, run) if run else None
    whole = backfill_ods and len(years) > 1
    if whole and journal is None:
        load_ods_backfill(wh, raw, years, parallel)
    elif whole:
        journal.step("ods", lambda: load_ods_backfill(wh, raw, years, parallel))
    for y in years:
        run_year(spark, wh, raw, y, build_marts=False, parallel=parallel, ods_loaded=whole, journal=journal)
    load_marts(wh, parallel)
    if journal is not None:
        journal.close()
        if wh.atomic:
            wh.vacuum()


def table_counts(spark: SparkSession, wh: Warehouse, names: list[str]) -> DataFrame:
    """Row count per warehouse table (one aggregate per table, unioned)."""
    parts = [wh.read(n).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(n).alias("table_name"), "row_count") for n in names]
    return reduce(DataFrame.unionByName, parts)


# --- earlier payment vault (DV-18) -----------------------------------------------------

EARLY_TABLES = ["hub_user", "hub_account", "hub_billing_period", "hub_paydoc",
                "link_paydoc_payment", "sat_user", "sat_pay"]


def run_early_vault_year(spark: SparkSession, wh: Warehouse, raw_payment: DataFrame,
                         year: int) -> None:
    """The earlier payment-only load: ODS payment partition reload, one staging,
    four hubs, the payment link keyed by document, two satellites."""
    ld = load_date_of(year)
    wh.create_if_missing("ods_payment", _with_part(schemas.ODS_PAYMENT), PARTITION_COLUMN)
    wh.overwrite_partition("ods_payment", str(year), ods.ods_payment(raw_payment, year))
    name = f"mv_early_payment_{year}"
    wh.replace(name, staging.stage(ods_slice(wh, "payment", year), staging.EARLY_PAYMENT, ld, year))
    stg = wh.read(name)
    for hub in ("user", "account", "billing_period", "paydoc"):
        target = _read_or_empty(wh, f"hub_{hub}", schemas.hub_schema(hub))
        wh.append(f"hub_{hub}", vault.hub_rows(hub, [stg], target))
    link = _read_or_empty(wh, "link_paydoc_payment", schemas.LINK_PAYDOC_PAYMENT)
    wh.append("link_paydoc_payment", vault.link_paydoc_payment_rows(stg, link))
    sat = _read_or_empty(wh, "sat_user", schemas.SAT_USER)
    wh.append("sat_user", vault.sat_user_rows(stg, sat, as_of=ld))
    sat = _read_or_empty(wh, "sat_pay", schemas.SAT_PAY)
    wh.append("sat_pay", vault.sat_pay_rows(stg, sat, as_of=ld))


# --- Hive variant of the ODS load (PR-5, SK-3, SK-7, AG-5) -------------------------------

HIVE_TABLES = ["hive_ods_billing", "hive_ods_issue", "hive_ods_payment", "hive_ods_traffic", "dm_traffic"]
HIVE_PARTITION = "year"


def hive_schema(src: str) -> T.StructType:
    fields = [f if f.name != "device_ip_addr" else T.StructField("device_ip_addr", T.IntegerType(), True)
              for f in schemas.ODS[src].fields]
    return T.StructType(fields + [T.StructField(HIVE_PARTITION, T.IntegerType(), True)])


TRAFFIC_MART_SCHEMA = T.StructType([
    T.StructField("user_id", T.IntegerType()), T.StructField("device_id", T.StringType()), T.StructField("month", T.DateType()),
    T.StructField("bytes_sent", T.LongType()), T.StructField("bytes_received", T.LongType()), T.StructField("records", T.LongType()),
    T.StructField(HIVE_PARTITION, T.IntegerType())])


def refresh_traffic_mart(wh: Warehouse, year: int) -> None:
    """SK-7: regroup the traffic of one year partition and replace that part of the mart.

    A partition holds one calendar year, and a month lies in one year: the groups of different
    partitions never meet, so the mart is the union of its parts."""
    traffic = wh.read("hive_ods_traffic", hive_schema("traffic")).where(F.col(HIVE_PARTITION) == year)
    wh.overwrite_partition("dm_traffic", str(year), marts.traffic_mart(traffic), column=HIVE_PARTITION)


def traffic_mart(wh: Warehouse) -> DataFrame:
    """The traffic mart over all loaded years."""
    return wh.read("dm_traffic", TRAFFIC_MART_SCHEMA).drop(HIVE_PARTITION)


def run_hive_year(spark: SparkSession, wh: Warehouse, raw: dict[str, DataFrame], year: int,
                  parallel: bool = True) -> None:
    """The Hive load of one year: a static ``year=Y`` partition overwrite per
    feed, then -- after traffic -- the year's part of the traffic mart."""
    def one(src):
        name = f"hive_ods_{src}"
        wh.overwrite_partition(name, str(year), ods.HIVE_LOADERS[src](raw[src], year), HIVE_PARTITION)
    in_parallel([lambda s=s: one(s) for s in ODS_SOURCES], parallel)
    refresh_traffic_mart(wh, year)


def partition_labels(df: DataFrame, column: str) -> DataFrame:
    """Rows per ODS partition label of a date column (SK-1)."""
    return df.groupBy(partition_label(column).alias(PARTITION_COLUMN)).agg(
        F.count(F.lit(1)).alias("row_count"))
