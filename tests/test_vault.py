"""Vault loaders on hand-made rows: quirks Q-1..Q-5 and the skew-safe rewrites
checked against brute-force models of the reference semantics."""

import datetime as dt
import random
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from vaultspark.operators import staging, vault
from vaultspark.sources import schemas

D = dt.date
LD13, LD14 = dt.datetime(2013, 1, 1), dt.datetime(2014, 1, 1)


def payments(spark, rows):
    """rows: (user_id, type, num, account, phone, period(date), pay_date, sum)"""
    fixed = [(u, t, n, a, None if p is None else Decimal(p), bp, pd_, s) for u, t, n, a, p, bp, pd_, s in rows]
    return spark.createDataFrame(fixed, schemas.ODS_PAYMENT)


def stage(spark, rows, ld=LD13):
    return staging.stage(payments(spark, rows), staging.PAYMENT, ld)


def test_null_and_blank_keys_single_source_hub_keeps_null(spark):
    st = stage(spark, [(1, "MIR", 1, None, 7e10, D(2013, 1, 1), D(2013, 1, 5), 10),
                       (1, "MIR", 2, "", 7e10, D(2013, 1, 1), D(2013, 1, 6), 10),
                       (1, "MIR", 3, "  ", 7e10, D(2013, 1, 1), D(2013, 1, 7), 10),
                       (1, "MIR", 4, "FL-1", 7e10, D(2013, 1, 1), D(2013, 1, 8), 10)])
    first = vault.hub_rows("account", [st])
    rows = first.collect()
    assert sorted((r.ACCOUNT_PK is None) for r in rows) == [False, True]
    # Q-2: the NULL key never matches the hub, so a rerun inserts it again
    again = vault.hub_rows("account", [st], first).collect()
    assert len(again) == 1 and again[0].ACCOUNT_PK is None
    # option: drop NULL keys
    assert vault.hub_rows("account", [st], first, drop_null_keys=True).count() == 0


def test_key_normalisation_shares_hash(spark):
    st = stage(spark, [(1, "MIR", 1, " fl-9 ", 7e10, D(2013, 1, 1), D(2013, 1, 5), 10),
                       (1, "MIR", 2, "FL-9", 7e10, D(2013, 1, 1), D(2013, 1, 6), 10)])
    rows = vault.hub_rows("account", [st]).collect()
    assert len(rows) == 1
    assert rows[0].ACCOUNT_KEY == " fl-9 "  # smallest key text wins the tie (Q-3)


def test_multi_source_hub_first_source_by_name(spark):
    st = stage(spark, [(7, "MIR", 1, "FL-7", 7e10, D(2013, 1, 1), D(2013, 1, 5), 10)])
    other = st.withColumn("RECORD_SOURCE", F.lit("BILLING - DATA LAKE"))
    late = st.withColumn("LOAD_DATE", F.lit(LD14).cast("timestamp_ntz")).withColumn(
        "RECORD_SOURCE", F.lit("AAA"))
    rows = vault.hub_rows("user", [st, other, late]).collect()
    assert len(rows) == 1 and rows[0].RECORD_SOURCE == "BILLING - DATA LAKE"
    assert rows[0].LOAD_DATE == LD13


def test_shared_payment_pk_multi_active_satellite(spark):
    # Q-1: same user/account/period/type, different documents, plus an exact duplicate
    base = (3, "VISA", None, "FL-3", 7e10, D(2013, 2, 1), D(2013, 2, 3), 5)
    rows = [base[:2] + (n,) + base[3:] for n in (1, 2, 2)]
    st = stage(spark, rows)
    assert vault.link_payment_rows(st).count() == 1
    sat = vault.sat_payment_rows(st).collect()
    assert len(sat) == 2


def _phones(spark, seq, year=2013, user=5):
    rows = [(user, "MIR", i + 1, "FL-5", p, D(year, 1, 1), D(year, 1, 1 + i), 10) for i, p in enumerate(seq)]
    return stage(spark, rows, dt.datetime(year, 1, 1))


def test_phone_history_collapses_consecutive_states(spark):
    A, B = 70000000001, 70000000002
    out = vault.sat_user_rows(_phones(spark, [None, A, A, B, A])).orderBy("EFFECTIVE_FROM").collect()
    assert [int(r.phone) for r in out] == [A, B, A]  # leading NULL dropped, A,A collapsed


def test_satellite_compares_with_newest_load_only(spark):
    A, B = 70000000001, 70000000002
    y1 = vault.sat_user_rows(_phones(spark, [A, B]))
    # Q-5: year 2 starts with A again -- A is among the newest load's states, not inserted
    y2 = vault.sat_user_rows(_phones(spark, [A, A], 2014), y1, as_of=LD14).collect()
    assert y2 == []
    # a new state is inserted
    y2b = vault.sat_user_rows(_phones(spark, [B, 70000000003], 2014), y1, as_of=LD14).collect()
    assert [int(r.phone) for r in y2b] == [70000000003]
    # last_state mode compares with the last state only (B): A is recorded again
    y2c = vault.sat_user_rows(_phones(spark, [A], 2014), y1, as_of=LD14, mode="last_state").collect()
    assert [int(r.phone) for r in y2c] == [A]


def test_rerun_of_a_year_is_not_idempotent(spark):
    A, B = 70000000001, 70000000002
    y1 = vault.sat_user_rows(_phones(spark, [A]))
    y2 = vault.sat_user_rows(_phones(spark, [B, A], 2014), y1, as_of=LD14)
    assert sorted(int(r.phone) for r in y2.collect()) == [B]
    after = y1.unionByName(y2)
    rerun = vault.sat_user_rows(_phones(spark, [B, A], 2014), after, as_of=LD14).collect()
    assert [int(r.phone) for r in rerun] == [A]  # the reference inserts A on a rerun


def test_history_as_of_without_batch_date(spark):
    A = 70000000001
    y1 = vault.sat_user_rows(_phones(spark, [A]))
    src = _phones(spark, [A], 2014)
    # semi join with the inequality instead of the known batch date
    hist = vault.history_as_of(y1, None, src, "USER_PK")
    assert hist.count() == 1
    assert vault.history_as_of(y1, dt.datetime(2012, 1, 1)).count() == 0


def _brute_lag(pdf, order):
    keep = []
    for _, g in pdf.sort_values(["k", *order], na_position="last").groupby("k", dropna=False, sort=False):
        prev = None
        for i, (idx, r) in enumerate(g.iterrows()):
            v = None if pd.isna(r.v) else r.v
            if not (v == prev or (v is None and prev is None)):
                keep.append(int(r.id))
            prev = v
    return sorted(keep)


def test_collapse_repeats_matches_lag_on_skewed_keys(spark, monkeypatch):
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        k = "hot" if i % 3 else rnd.choice(["a", "b", None])  # one key holds two thirds
        rows.append((i, k, rnd.choice([1, 2, None]), rnd.randint(0, 5), i * 7 % 601))  # unique tie-breaker
    df = spark.createDataFrame(rows, "id int, k string, v int, d int, t int")
    for piece in (4096, 20, 3):
        monkeypatch.setattr(vault, "LEAST_PIECE", piece)
        monkeypatch.setattr(vault, "SHARES_PER_PARTITION", 1000)
        got = sorted(r.id for r in vault.collapse_repeats(df, "k", "v", ["d", "t"]).collect())
        assert got == _brute_lag(df.toPandas(), ["d", "t"]), piece


def test_latest_states_matches_rank(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("abc"), rnd.choice("xyz"), dt.datetime(2013 + rnd.randint(0, 3), 1, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "pk string, hd string, LOAD_DATE timestamp_ntz")
    got = sorted(tuple(r) for r in vault.latest_states(df, "pk", "hd").collect())
    pdf = df.toPandas()
    mx = pdf.groupby("pk").LOAD_DATE.transform("max")
    want = sorted(set(map(tuple, pdf[pdf.LOAD_DATE == mx][["pk", "hd"]].values.tolist())))
    assert got == want


def test_plans_use_anti_joins_and_partial_aggregates(spark):
    st = stage(spark, [(1, "MIR", 1, "FL-1", 7e10, D(2013, 1, 1), D(2013, 1, 5), 10)])
    hub = vault.hub_rows("account", [st])
    plan = vault.hub_rows("account", [st], hub)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan
    sat_plan = vault.sat_payment_rows(st, vault.sat_payment_rows(st), LD13)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in sat_plan and "Window" not in sat_plan


def test_collapse_repeats_with_null_order_values(spark, monkeypatch):
    """NULL dates and NULL tie-breakers against a plain LAG, with and without cuts inside a date."""
    import itertools

    days = [dt.date(2013, 1, 1), dt.date(2013, 1, 2), None]
    rows = [(k, d, n, v) for i, (k, d, n) in enumerate(itertools.product(["a", None], days, [1, 2, 9, None]))
            for v in [str(i // 3 % 2)]] + [("b", days[0], 3, "1"), ("b", None, 1, "1"), ("b", None, 2, "1")]
    df = spark.createDataFrame(rows, "k string, d date, n int, v string")
    df.createOrReplaceTempView("collapse_nulls")
    want = spark.sql("""SELECT k, d, n, v FROM (SELECT *, lag(v) OVER (PARTITION BY k ORDER BY d ASC NULLS LAST, n ASC NULLS LAST) p
                        FROM collapse_nulls) WHERE v IS DISTINCT FROM p""")
    monkeypatch.setattr(vault, "SHARES_PER_PARTITION", 1000)
    for piece in (4096, 1, 3):
        monkeypatch.setattr(vault, "LEAST_PIECE", piece)
        got = vault.collapse_repeats(df, "k", "v", ["d", "n"])
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_hot_key_and_date_is_cut_at_quantiles(spark, monkeypatch):
    """Numbers, texts and NULLs as tie-breakers: every cut of one (key, date) gives the plain LAG's rows."""
    monkeypatch.setattr(vault, "LEAST_PIECE", 16)
    monkeypatch.setattr(vault, "SHARES_PER_PARTITION", 100)
    rnd = random.Random(11)
    rows = [(i, "hot" if i % 3 else f"k{i % 50}", rnd.choice([1, 2]), 1 if i % 3 else i % 9, None if i == 77 else i * i % 99991) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, k string, v int, d int, n int").where("n is not null or id = 77").dropDuplicates(["k", "d", "n"])
    for tie in ("n", "cast(n as decimal(12,0))", "case when n is not null then lpad(cast(n as string), 6, '0') end", "date_add(date'2000-01-01', n)"):
        told = df.selectExpr("id", "k", "v", "d", f"{tie} t").cache()
        told.createOrReplaceTempView("hot_date")
        want = spark.sql("""SELECT id FROM (SELECT id, v, lag(v) OVER (PARTITION BY k ORDER BY d ASC NULLS LAST, t ASC NULLS LAST) p
                            FROM hot_date) WHERE v IS DISTINCT FROM p""")
        cuts = vault._cuts(told, "k", ["d", "t"]).collect()
        assert [(r._ck, r._co) for r in cuts] == [("hot", 1)] and len(cuts[0]._bounds) > 20
        got = vault.collapse_repeats(told, "k", "v", ["d", "t"])
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect()), tie


def test_first_row_per_key_equals_row_number_with_nulls(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(["x", "y", None]), rnd.choice([LD13, LD14, None]), rnd.choice(["s1", "s2"])) for _ in range(300)]
    df = spark.createDataFrame(rows, "K_PK string, K_KEY string, LOAD_DATE timestamp_ntz, RECORD_SOURCE string")
    for n in (3, 10, 300):
        part = df.limit(n).cache()
        part.createOrReplaceTempView("first_rows")
        want = spark.sql("""SELECT K_PK, LOAD_DATE, RECORD_SOURCE, K_KEY FROM (SELECT *, row_number() OVER (PARTITION BY K_PK
                            ORDER BY LOAD_DATE NULLS FIRST, RECORD_SOURCE NULLS FIRST, K_KEY NULLS FIRST) n FROM first_rows) WHERE n = 1""")
        got = vault.first_per_key(part, "K_PK", ["LOAD_DATE", "RECORD_SOURCE"], ["K_KEY"])
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_link_keeps_different_rows_under_one_key(spark):
    """A key part that is '^^' and one that is missing share a link key; both rows are distinct and both are new."""
    st = stage(spark, [(1, "MIR", 1, "^^", 7e10, D(2013, 1, 1), D(2013, 1, 5), 10), (1, "MIR", 2, None, 7e10, D(2013, 1, 1), D(2013, 1, 5), 10),
                       (1, "MIR", 3, None, 7e10, D(2013, 1, 1), D(2013, 1, 5), 10)])
    first = vault.link_payment_rows(st)
    assert first.count() == 2 and first.select("PAYMENT_PK").distinct().count() == 1
    assert vault.link_payment_rows(st, first).count() == 0


def test_history_is_cut_to_the_keys_of_the_batch(spark):
    A, B = 70000000001, 70000000002
    sat = vault.sat_user_rows(_phones(spark, [A, B], user=5)).unionByName(vault.sat_user_rows(_phones(spark, [B], user=6)))
    batch = _phones(spark, [A], 2014, user=5)
    assert {r.USER_PK for r in vault.history_as_of(sat, LD14, batch, "USER_PK").collect()} == {r.USER_PK for r in batch.collect()}
    plan = vault.sat_user_rows(batch, sat, as_of=LD14)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
