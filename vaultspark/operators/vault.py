"""Vault loaders (DV-10..17): rows to insert into hubs, links and satellites.

Every loader is ``(staging, current target) -> new rows``; writing is separate
(``Warehouse.append``).  All of them are shuffle-aware rewrites of the
window / LEFT JOIN ... IS NULL forms of the reference with the same result:

* first row per key (WN-1/WN-2) takes the smallest load date per (key, source,
  key text) first: a hash aggregate whose buffer is one fixed-width number, so a
  key holding a third of all rows is a few rows per task before the shuffle and
  nothing is sorted below it; only those few meet in ``min(struct(order...))``;
* "not yet in the target" (JN-1..3) is an explicit ``left_anti`` join (Catalyst
  does not rewrite LEFT JOIN + IS NULL by itself); NULL keys never match, as in
  the reference;
* ``DISTINCT`` runs *before* the anti join (same result, the anti join is a row
  filter on the key) so the shuffle carries deduplicated rows; that of a link is
  a set per link key, so one exchange by that key serves DISTINCT, anti join and
  bucketed write;
* the satellite's "states of the newest load" (JN-4 + WN-4) is two partial
  aggregates and an equi-join on ``(key, load date)`` instead of a RANK window,
  over the history of the batch's own keys only.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultspark.functions.hashing import packed, unpacked
from vaultspark.functions.scalar import load_timestamp

LD, RS, EFF = "LOAD_DATE", "RECORD_SOURCE", "EFFECTIVE_FROM"

# Sentinel standing in for a NULL key inside the change-collapse operator.  A
# hash key is 32 hex characters, so a NUL character can never collide with one.
NULL_KEY = "\u0000"


def pack(df: DataFrame, *keys: str) -> DataFrame:
    """Hash keys as bytes (:func:`hashing.packed`) for the exchanges to come; keys that are no texts stay as they are."""
    return df.withColumns({k: packed(k) for k in texts(df, *keys)})


def unpack(df: DataFrame, *keys: str) -> DataFrame:
    """Packed keys as texts again: ``keys`` are those that were texts."""
    return df.withColumns({k: unpacked(k) for k in keys})


def texts(df: DataFrame, *keys: str) -> list[str]:
    return [k for k in keys if isinstance(df.schema[k].dataType, T.StringType)]


def sorted_merge(table: DataFrame) -> DataFrame:
    """A stored table that grows without bound, as one side of a join: never broadcast.  Spark sizes it by its files, and those
    of a narrow table hold a row in a byte or a column in a few, where a broadcast holds some 150 bytes for each row."""
    return table.hint("merge")


# --- first row per key (WN-1, WN-2) -------------------------------------------------

def first_per_key(df: DataFrame, key: str, order_by: list[str], payload: list[str]) -> DataFrame:
    """One row per ``key``: the smallest ``order_by`` tuple wins, ties broken by
    the payload columns.  Equals ``row_number() over (partition by key order by
    ...) = 1`` with a deterministic tie-breaker.

    The first order column is a date, time or number.  Its minimum per (key, other
    columns) lives in a fixed-width buffer, so the rows are reduced by a hash
    aggregate without any sort; what is left per key, one row for each combination
    of the other columns, meets in the minimum of a struct.  NULL orders first,
    as in that struct.  The key goes through the first exchange as bytes (see :func:`pack`)."""
    first, others = order_by[0], [c for c in [*order_by[1:], *payload] if c != key]
    least = F.when(F.count_if(F.col(first).isNull()) == 0, F.min(first)).alias(first)
    few = unpack(pack(df, key).groupBy(key, *others).agg(least), *texts(df, key))
    cols = [first, *others]
    best = F.min(F.struct(*[F.col(c) for c in cols])).alias("_first")
    return few.groupBy(key).agg(best).select(key, *[F.col(f"_first.{c}").alias(c) for c in cols])


# --- hubs (DV-10..13) ------------------------------------------------------------------

def new_hub_rows(sources: list[DataFrame] | DataFrame, pk: str, key: str,
                 hub: DataFrame | None = None, drop_null_keys: bool | None = None) -> DataFrame:
    """Rows to insert into a hub.

    Sources are unioned (SE-1), the first row per PK is taken ordered by load
    date, then record source, then key (Q-3), and PKs already in the hub are
    removed (JN-1).  ``drop_null_keys`` defaults to the reference: multi-source
    hubs drop NULL keys (FL-3), single-source hubs keep them (Q-2) -- a NULL PK
    never matches, so it is inserted again on every run.
    """
    srcs = sources if isinstance(sources, list) else [sources]
    if drop_null_keys is None:
        drop_null_keys = len(srcs) > 1
    union = reduce(DataFrame.unionByName, [s.select(pk, key, LD, RS) for s in srcs])
    if drop_null_keys:
        union = union.where(F.col(pk).isNotNull())
    rows = first_per_key(union, pk, [LD, RS], [key])
    if hub is not None:
        rows = rows.join(sorted_merge(hub.select(pk)), pk, "left_anti")
    return rows.select(pk, key, LD, RS)


# --- links (DV-14) ------------------------------------------------------------------------

def new_link_rows(staging: DataFrame, pk: str, fks: list[str], link: DataFrame | None = None,
                  drop_null_keys: bool = False) -> DataFrame:
    """Rows to insert into a link: distinct (PK, FKs, load date, source) not yet
    present by PK (JN-2, AG-2).

    The distinct rows of a PK are gathered as a set (almost always of one), reduced
    before the exchange like any aggregate; that exchange by PK is the only one:
    the anti join against a link bucketed by PK and the bucketed write of the result
    keep its partitioning."""
    cols = [pk, *fks, LD, RS]
    rows = pack(staging.select(*cols), *fks)
    if drop_null_keys:
        rows = rows.where(F.col(pk).isNotNull())
    rows = unpack(rows.groupBy(pk).agg(F.collect_set(F.struct(*fks, LD, RS)).alias("_rows"))
                  .select(pk, F.inline("_rows")), *texts(staging, *fks))
    if link is not None:
        rows = rows.join(sorted_merge(link.select(pk)), pk, "left_anti")
    return rows.select(*cols)


# --- satellites (DV-15..17) -----------------------------------------------------------------

#: A (key, first order value) with more than one of this many shares of all rows is cut into pieces of about that size.
SHARES_PER_PARTITION = 64
#: No segment of fewer rows is cut.
LEAST_PIECE = 1024
#: A key with more than one of this many shares of a partition's rows is large: its rows may not meet in one task.
KEY_SHARES = 4
#: Quantiles of the tie-breaker a cut is chosen from.
QUANTILES = 2048


def _sortable(df: DataFrame, c: str) -> Column | None:
    """A number that never falls as ``c`` grows, or None for a type without one.  Texts compare by their
    bytes: the first seven are the number."""
    kind = df.schema[c].dataType
    if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(c)
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.col(c).cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
    return None


def _at_most(bounds: Column, value: Column) -> Column:
    """How many of the ascending ``bounds`` are at most ``value``, by halving."""
    def halve(range_: Column, _: Column) -> Column:
        middle = ((range_["lo"] + range_["hi"]) / 2).cast("int")
        over = (range_["lo"] < range_["hi"]) & (F.get(bounds, middle) > value)
        under = (range_["lo"] < range_["hi"]) & (F.get(bounds, middle) <= value)
        return F.struct(F.when(under, middle + 1).otherwise(range_["lo"]).alias("lo"),
                        F.when(over, middle).otherwise(range_["hi"]).alias("hi"))
    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))
    steps = F.array(*[F.lit(i) for i in range(QUANTILES.bit_length())])
    return F.aggregate(steps, start, halve)["lo"]


def _cuts(df: DataFrame, key: str, order_by: list[str]) -> DataFrame | None:
    """(key, first order value, bounds of the tie-breaker) of the segments that are too large for one task.

    At most ``SHARES_PER_PARTITION`` x shuffle partitions of them can be, and all their bounds
    together are at most twice as many numbers: a table of proven size."""
    first, tie = order_by[0], order_by[-1]
    number = _sortable(df, tie) if len(order_by) > 1 else None
    if number is None:
        return None
    shares = SHARES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = df.count()
    piece = max(total // shares, LEAST_PIECE)
    if total <= piece:
        return None
    sizes = df.groupBy(F.col(key).alias("_ck"), F.col(first).alias("_co")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > piece)
    if sizes.isEmpty():
        return None
    large = df.join(F.broadcast(sizes), F.col(key).eqNullSafe(F.col("_ck")) & F.col(first).eqNullSafe(F.col("_co")))
    steps = [i / QUANTILES for i in range(1, QUANTILES)]
    found = large.groupBy("_ck", "_co").agg(F.percentile_approx(number, steps, QUANTILES * 4).alias("_q"), F.max("_n").alias("_n"))
    pieces = F.least(F.ceil(F.col("_n") / F.lit(piece)), F.lit(QUANTILES)).cast("int")
    chosen = F.transform(F.sequence(F.lit(1), pieces - 1), lambda i: F.get(F.col("_q"), F.floor(i * QUANTILES / pieces).cast("int") - 1))
    return found.where(pieces > 1).select("_ck", "_co", F.array_distinct(chosen).alias("_bounds"))


def _large_keys(df: DataFrame, key: str) -> DataFrame | None:
    """Hashes (``_lh``) of the keys with more rows than a share of a partition: at most ``KEY_SHARES`` x shuffle
    partitions, a table of proven size.  None where the whole table is no larger than a piece.  Only hashes are
    exchanged; two small keys with one hash may be called large, which costs time and changes no row."""
    total = df.count()
    share = max(total // (KEY_SHARES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), LEAST_PIECE)
    if total <= share:
        return None
    return (df.groupBy(F.xxhash64(key).alias("_lh")).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > share).select("_lh"))


def _collapse_in_one(df: DataFrame, key: str, value: str, order_by: list[str]) -> DataFrame:
    prev = F.lag(value).over(W.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order_by]))
    return df.withColumn("_prev", prev).where(~F.col(value).eqNullSafe(F.col("_prev"))).drop("_prev")


def collapse_repeats(df: DataFrame, key: str, value: str, order_by: list[str]) -> DataFrame:
    """Keep a row only when ``value`` IS DISTINCT FROM the previous row's value
    of the same key (WN-3 ``lag`` + FL-4).  Consecutive equal states collapse; a
    leading NULL is dropped, as ``NULL IS DISTINCT FROM NULL`` is false.

    A key whose rows are few enough for one task is one window: its rows are exchanged once.  The
    rows of a large key (:func:`_large_keys`) go through a segmented scan (:func:`_collapse_segments`)."""
    if len(order_by) < 2:  # the order is the segment: nothing is left to lag over inside
        return _collapse_in_one(df, key, value, order_by)
    large = _large_keys(df, key)
    if large is None:
        return _collapse_segments(df, key, value, order_by)
    if large.isEmpty():
        return _collapse_in_one(df, key, value, order_by)
    on = F.xxhash64(key) == F.col("_lh")
    few, many = df.join(F.broadcast(large), on, "left_anti"), df.join(F.broadcast(large), on, "left_semi")
    return _collapse_in_one(few, key, value, order_by).unionByName(_collapse_segments(many, key, value, order_by))


def _collapse_segments(df: DataFrame, key: str, value: str, order_by: list[str]) -> DataFrame:
    """:func:`collapse_repeats` by a segmented scan: the rows of a key are cut into segments that follow each other in the
    order, the lag runs inside each, and the first row of a segment takes its previous value
    from a small table that carries the last row of the segment before.  Segments
    are the values of the first order column (the effective date); a (key, date) too large
    for one task is cut again at quantiles of the tie-breaker, found from the data (see
    :func:`_cuts`).  Rows alike in key and whole order stay together: the order
    between them is not defined.  ``tests/skew_evidence.py`` measures a third of all rows on
    one key, and on one (key, date)."""
    cuts = _cuts(df, key, order_by)
    x = df
    if cuts is None:
        x = x.withColumn("_s", F.lit(0))
    else:
        number = _sortable(df, order_by[-1])
        on = F.col(key).eqNullSafe(F.col("_ck")) & F.col(order_by[0]).eqNullSafe(F.col("_co"))
        # a NULL tie-breaker orders last: it joins the last piece
        place = F.when(number.isNull(), F.size("_bounds")).otherwise(_at_most(F.col("_bounds"), number))
        x = x.join(F.broadcast(cuts), on, "left").withColumn("_s", F.when(F.col("_bounds").isNull(), 0).otherwise(place))
        x = x.drop("_ck", "_co", "_bounds")
    bnames = [f"_b{i}" for i in range(len(order_by))]
    binary = isinstance(df.schema[key].dataType, T.BinaryType)
    x = x.withColumn("_k", F.coalesce(F.col(key), F.lit(NULL_KEY.encode() if binary else NULL_KEY)))
    x = x.withColumns(dict(zip(bnames, [*[F.col(c) for c in order_by[:-1]], F.col("_s")]))).drop("_s")
    # PostgreSQL orders NULLs last on ASC; (is_null, value) pairs give the
    # struct comparison below the same order.
    order = [F.col(c).asc_nulls_last() for c in order_by]
    ranked = [F.struct(F.col(c).isNull(), F.col(c)) for c in order_by]

    w_in = W.partitionBy("_k", *bnames).orderBy(*order)
    x = x.withColumn("_prev", F.lag(value).over(w_in)).withColumn(
        "_first", F.row_number().over(w_in) == 1)

    last = (x.groupBy("_k", *bnames)
            .agg(F.max(F.struct(*ranked, F.col(value))).alias("_last")))
    w_b = W.partitionBy("_k").orderBy(*[F.col(b).asc_nulls_last() for b in bnames])
    edges = last.select(F.col("_k").alias("_ek"), *[F.col(b).alias(f"_e{b}") for b in bnames],
                        F.lag(F.col(f"_last.{value}")).over(w_b).alias("_edge"))

    on = F.col("_k") == F.col("_ek")
    for b in bnames:  # the segment of NULL order values has its edge, too
        on = on & F.col(b).eqNullSafe(F.col(f"_e{b}"))
    x = x.join(edges, on, "left").drop("_ek", *[f"_e{b}" for b in bnames])
    prev = F.when(F.col("_first"), F.col("_edge")).otherwise(F.col("_prev"))
    return x.where(~F.col(value).eqNullSafe(prev)).drop("_k", "_prev", "_first", "_edge", *bnames)


def history_as_of(sat: DataFrame, as_of: dt.datetime | str | None = None,
                  batch: DataFrame | None = None, pk: str | None = None) -> DataFrame:
    """Satellite rows loaded no later than the batch (JN-4 + FL-6), of the batch's keys if it is given.

    The reference joins the satellite to every batch row on the key with
    ``sat.LOAD_DATE <= batch.LOAD_DATE`` and uses the fan-out only as an
    existence test.  With the batch load date known (``as_of``; all rows of a
    staging batch share it) the inequality is a filter that reaches the scan.  The key
    test is a ``left_semi`` join with the batch's distinct keys (pre-aggregated with their
    latest load date where ``as_of`` is not known): everything after it works
    on as many keys as the batch has.  The batch is filtered by its load date, which
    lets Spark put a Bloom filter of its keys below the history's own exchange.
    """
    if as_of is not None:
        ld = load_timestamp(as_of)
        sat = sat.where(F.col(LD) <= ld)
        if batch is None or pk is None:
            return sat
        keys = batch.where(F.col(pk).isNotNull() & (F.col(LD) <= ld)).select(pk).distinct()
        return sat.join(keys, pk, "left_semi")
    if batch is None or pk is None:
        return sat
    bounds = batch.groupBy(pk).agg(F.max(LD).alias("_batch_ld"))
    cond = (sat[pk] == bounds[pk]) & (sat[LD] <= bounds["_batch_ld"])
    return sat.join(bounds, cond, "left_semi")


def latest_states(history: DataFrame, pk: str, hashdiff: str,
                  mode: str = "latest_load", with_load_date: bool = False) -> DataFrame:
    """(PK, HASHDIFF) pairs a new row is compared with.

    ``latest_load`` (reference, WN-4): every state of the newest load of the
    key -- RANK over load date DESC = 1 keeps ties.  A hash diff belongs to it
    iff its own newest load date equals the key's newest load date, so this is
    two aggregates and an equi-join on (PK, load date): the hot key is spread by
    hash diff and by date, never gathered into one task.
    ``last_state`` (Q-5 option): only the state of the key's newest row, by
    load date then effective date.
    """
    # NULL keys or hash diffs never match the anti join that consumes this; NULL load
    # dates are never the newest; dropping both up front also makes the two
    # uses of ``per_state`` identical, so Spark computes it once (exchange reuse).
    history = history.where(F.col(pk).isNotNull() & F.col(hashdiff).isNotNull() & F.col(LD).isNotNull())
    if mode == "latest_load":
        per_state = history.groupBy(pk, hashdiff).agg(F.max(LD).alias("_ld"))
        per_key = per_state.groupBy(pk).agg(F.max("_ld").alias("_ld"))
        latest = per_state.join(per_key, [pk, "_ld"])
        if with_load_date:
            return latest.select(pk, hashdiff, F.col("_ld").alias(LD))
        return latest.select(pk, hashdiff)
    if mode == "last_state":
        newest = F.max(F.struct(F.col(LD), F.col(EFF), F.col(hashdiff))).alias("_n")
        return history.groupBy(pk).agg(newest).select(pk, F.col(f"_n.{hashdiff}").alias(hashdiff))
    raise ValueError("mode must be 'latest_load' or 'last_state'")


def _in_one(history: DataFrame, pk: str) -> DataFrame:
    """Rows of the newest load of each key, whose rows meet in one task: exchanged once, or not at all behind a join by the key."""
    return history.withColumn("_ld", F.max(LD).over(W.partitionBy(pk))).where(F.col(LD) == F.col("_ld")).drop("_ld")


def _split(history: DataFrame, pk: str, large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ordinary keys and those of large ones (:func:`_large_keys`)."""
    on = F.xxhash64(pk) == F.col("_lh")
    return history.join(F.broadcast(large), on, "left_anti"), history.join(F.broadcast(large), on, "left_semi")


def compared_states(history: DataFrame, pk: str, hashdiff: str, batch: DataFrame) -> DataFrame:
    """(PK, HASHDIFF) of :func:`latest_states`, repeated ones maybe more than once, of a history that is cut to the keys of
    ``batch``.  That cut has brought the rows of a key together: those of ordinary keys are compared there.  Two
    aggregates and a join would each make the cut again, as no exchange is left between them that they could share.  Keys
    that are large in the batch stay spread as in :func:`latest_states`."""
    history = history.where(F.col(pk).isNotNull() & F.col(hashdiff).isNotNull() & F.col(LD).isNotNull())
    large = _large_keys(batch, pk)
    if large is None:
        return latest_states(history, pk, hashdiff)
    if large.isEmpty():
        return _in_one(history, pk).select(pk, hashdiff)
    few, many = _split(history, pk, large)
    return _in_one(few, pk).select(pk, hashdiff).unionByName(latest_states(many, pk, hashdiff))


def merged_states(history: DataFrame, pk: str, hashdiff: str) -> DataFrame:
    """(PK, HASHDIFF, LOAD_DATE) of :func:`latest_states` for a table as it lies in storage.

    The states of an ordinary key are few enough for one task: they are exchanged once, by the key, for both
    maxima.  Those of a large key (:func:`_large_keys`) stay spread by hash diff and by date."""
    history = history.where(F.col(pk).isNotNull() & F.col(hashdiff).isNotNull() & F.col(LD).isNotNull())
    large = _large_keys(history, pk)
    if large is None:
        return latest_states(history, pk, hashdiff, with_load_date=True)

    def in_one(df: DataFrame) -> DataFrame:
        return _in_one(df.repartition(pk).groupBy(pk, hashdiff).agg(F.max(LD).alias(LD)), pk)
    if large.isEmpty():
        return in_one(history)
    few, many = _split(history, pk, large)
    return in_one(few).unionByName(latest_states(many, pk, hashdiff, with_load_date=True))


def new_sat_rows(source: DataFrame, pk: str, hashdiff: str, payload: list[str],
                 sat: DataFrame | None = None, as_of: dt.datetime | str | None = None,
                 mode: str = "latest_load", batch: DataFrame | None = None) -> DataFrame:
    """Rows to insert into a satellite (DV-15/16): distinct source states whose
    (PK, HASHDIFF) is not among the latest states of the key (JN-3, AG-2).

    ``sat`` is the satellite's history, or any rows with key, hash diff and load date that
    have the same latest states (see ``pipeline.known_states``).  ``batch`` gives the keys whose
    history matters where reading ``source`` again for them would cost more."""
    rows = _new_packed_rows(pack(source, pk, hashdiff), pk, hashdiff, payload, sat, as_of, mode, batch)
    return unpack(rows, *texts(source, pk, hashdiff))


def _new_packed_rows(source: DataFrame, pk: str, hashdiff: str, payload: list[str], sat: DataFrame | None,
                     as_of: dt.datetime | str | None, mode: str, batch: DataFrame | None) -> DataFrame:
    """:func:`new_sat_rows` of a source with packed keys; ``sat`` and ``batch`` have theirs in hex."""
    cols = [pk, hashdiff, *payload, EFF, LD, RS]
    rows = source.select(*cols)
    if sat is None:
        return rows.distinct()
    batch = source if batch is None else pack(batch, pk)
    history = history_as_of(pack(sat, pk, hashdiff), as_of, batch, pk)
    latest = compared_states(history, pk, hashdiff, batch) if mode == "latest_load" else latest_states(history, pk, hashdiff, mode)
    # the exchange of the anti join serves DISTINCT, too: its rows are exchanged once
    rows = rows.repartition(pk, hashdiff).distinct().join(latest.select(pk, hashdiff), [pk, hashdiff], "left_anti")
    return rows.select(*cols)


def new_sat_rows_with_changes(source: DataFrame, pk: str, hashdiff: str, value: str,
                              payload: list[str], order_by: list[str],
                              sat: DataFrame | None = None,
                              as_of: dt.datetime | str | None = None,
                              mode: str = "latest_load") -> DataFrame:
    """DV-17: in-batch change detection first (consecutive equal ``value``s of a
    key collapse, ordered by ``order_by``), then as :func:`new_sat_rows`."""
    rows = pack(source, pk, hashdiff).select(*dict.fromkeys([pk, hashdiff, value, *payload, *order_by, EFF, LD, RS]))
    changed = collapse_repeats(rows, pk, value, order_by)
    return unpack(_new_packed_rows(changed, pk, hashdiff, payload, sat, as_of, mode, batch=source), *texts(source, pk, hashdiff))


# --- the reference's loads, by name -------------------------------------------------------

def hub_rows(name: str, stagings: list[DataFrame], hub: DataFrame | None = None,
             drop_null_keys: bool | None = None) -> DataFrame:
    p = name.upper()
    return new_hub_rows(stagings, f"{p}_PK", f"{p}_KEY", hub, drop_null_keys)


def link_payment_rows(payment_staging: DataFrame, link: DataFrame | None = None) -> DataFrame:
    return new_link_rows(payment_staging, "PAYMENT_PK",
                         ["USER_PK", "ACCOUNT_PK", "BILLING_PERIOD_PK", "PAY_DOC_TYPE_PK"], link)


def sat_payment_rows(payment_staging: DataFrame, sat: DataFrame | None = None,
                     as_of=None, mode: str = "latest_load") -> DataFrame:
    src = payment_staging.withColumn(EFF, F.col(EFF).cast("timestamp_ntz"))
    return new_sat_rows(src, "PAYMENT_PK", "PAY_DOC_HASHDIFF", ["pay_doc_num", "pay_date", "sum"],
                        sat, as_of, mode)


def sat_mdm_rows(mdm_staging: DataFrame, sat: DataFrame | None = None, as_of=None,
                 mode: str = "latest_load") -> DataFrame:
    # registered_at is hashed as DATE text, stored as TIMESTAMP (Q-8)
    src = mdm_staging.withColumns({
        "registered_at": F.col("registered_at").cast("timestamp_ntz"),
        EFF: F.col(EFF).cast("timestamp_ntz"),
    })
    return new_sat_rows(src, "MDM_PK", "MDM_HASHDIFF", ["registered_at", "is_vip"], sat, as_of, mode)


def sat_user_rows(payment_staging: DataFrame, sat: DataFrame | None = None, as_of=None,
                  mode: str = "latest_load") -> DataFrame:
    """Phone history: LAG ordered by effective date, then document number (Q-4)."""
    src = payment_staging.withColumn(EFF, F.col(EFF).cast("timestamp_ntz"))
    return new_sat_rows_with_changes(src, "USER_PK", "USER_HASHDIFF", "phone", ["phone"],
                                     [EFF, "pay_doc_num"], sat, as_of, mode)


# Earlier payment vault (DV-18)

def link_paydoc_payment_rows(staging: DataFrame, link: DataFrame | None = None) -> DataFrame:
    return new_link_rows(staging, "PAY_PK",
                         ["PAYDOC_PK", "USER_PK", "ACCOUNT_PK", "BILLING_PERIOD_PK"], link)


def sat_pay_rows(staging: DataFrame, sat: DataFrame | None = None, as_of=None,
                 mode: str = "latest_load") -> DataFrame:
    src = staging.withColumn(EFF, F.col(EFF).cast("timestamp_ntz"))
    return new_sat_rows(src, "PAY_PK", "PAY_HASHDIFF", ["sum"], sat, as_of, mode)
