"""The yearly pipeline over every year, checked against a brute-force pandas
model of the reference's loads (staging rows come from the DuckDB oracle, so
the model shares no code with the Spark plans)."""

import duckdb
import pandas as pd
import pytest

from conftest import SF_SMALL
from oracle_check import duck
from vaultspark import oracle as O
from vaultspark.plans import queries as Q

HUBS = {"user": ("payment", "mdm", "billing", "issue", "traffic"), "account": ("payment",),
        "billing_period": ("payment", "billing"), "pay_doc_type": ("payment",)}


def _staging(con, src, year):
    return con.execute(O.staged(src, year)).df()


def simulate(con, years):
    hubs = {h: pd.DataFrame() for h in HUBS}
    link = pd.DataFrame()
    sats = {"sat_payment": pd.DataFrame(), "sat_mdm": pd.DataFrame(), "sat_user": pd.DataFrame()}
    for y in years:
        stg = {s: _staging(con, s, y) for s in ("payment", "mdm", "billing", "issue", "traffic")}
        for h, srcs in HUBS.items():
            pk, key = f"{h.upper()}_PK", f"{h.upper()}_KEY"
            u = pd.concat([stg[s][[pk, key, "LOAD_DATE", "RECORD_SOURCE"]] for s in srcs])
            if len(srcs) > 1:
                u = u[u[pk].notna()]
            u = u.sort_values(["LOAD_DATE", "RECORD_SOURCE", key]).drop_duplicates(pk, keep="first")
            if len(hubs[h]):
                u = u[~u[pk].isin(set(hubs[h][pk].dropna()))]
            hubs[h] = pd.concat([hubs[h], u])
        cols = ["PAYMENT_PK", "USER_PK", "ACCOUNT_PK", "BILLING_PERIOD_PK", "PAY_DOC_TYPE_PK", "LOAD_DATE", "RECORD_SOURCE"]
        new = stg["payment"][cols].drop_duplicates()
        if len(link):
            new = new[~new.PAYMENT_PK.isin(set(link.PAYMENT_PK.dropna()))]
        link = pd.concat([link, new])
        p = stg["payment"].sort_values(["USER_PK", "EFFECTIVE_FROM", "pay_doc_num"])
        prev = p.groupby("USER_PK", dropna=False)["phone"].shift(1)
        changed = p[~((p.phone == prev) | (p.phone.isna() & prev.isna()))]
        m = stg["mdm"].copy()
        srcs = {"sat_payment": (stg["payment"], "PAYMENT_PK", "PAY_DOC_HASHDIFF", ["pay_doc_num", "pay_date", "sum"]),
                "sat_mdm": (m, "MDM_PK", "MDM_HASHDIFF", ["registered_at", "is_vip"]),
                "sat_user": (changed, "USER_PK", "USER_HASHDIFF", ["phone"])}
        for name, (src, pk, hd, payload) in srcs.items():
            rows = src[[pk, hd, *payload, "EFFECTIVE_FROM", "LOAD_DATE", "RECORD_SOURCE"]].drop_duplicates()
            hist = sats[name]
            if len(hist):
                h = hist[hist.LOAD_DATE <= pd.Timestamp(y, 1, 1)]
                mx = h.groupby(pk).LOAD_DATE.transform("max")
                latest = set(map(tuple, h[h.LOAD_DATE == mx][[pk, hd]].values.tolist()))
                rows = rows[[(a, b) not in latest for a, b in rows[[pk, hd]].values.tolist()]]
            sats[name] = pd.concat([hist, rows])
    out = {f"hub_{h}": len(v) for h, v in hubs.items()}
    out["link_payment"] = len(link)
    out.update({k: len(v) for k, v in sats.items()})
    return out, sats["sat_user"]


@pytest.mark.parametrize("sf", [SF_SMALL])
def test_run_years_matches_brute_force(spark, sf):
    con = duck(sf)
    want, sat_user = simulate(con, Q.YEARS)
    wh = Q.loaded_vault(spark, sf)
    got = {r.table_name: r.row_count for r in Q.QUERIES["run_years"](spark, sf).collect()}
    for t, n in want.items():
        assert got[t] == n, t
    spark_sat = wh.read("sat_user").toPandas()
    key = ["USER_PK", "USER_HASHDIFF", "EFFECTIVE_FROM", "LOAD_DATE"]
    a = spark_sat[key].sort_values(key).reset_index(drop=True)
    b = sat_user[key].sort_values(key).reset_index(drop=True)
    assert a.astype(str).equals(b.astype(str))


def test_pipeline_rerun_keeps_reference_semantics(spark, tmp_path):
    """2013, 2014, then 2014 again: the satellites receive exactly what the
    reference's SQL inserts (the oracle's first, second-year and rerun rows),
    and the latest-state table of the rerun year is rebuilt from history."""
    from vaultspark.plans import pipeline
    from vaultspark.sources import fixtures, schemas
    from vaultspark.sources.sinks import Warehouse

    con = duck(SF_SMALL)
    wh = Warehouse.for_vault(spark, str(tmp_path / "wh"))
    feeds = fixtures.raw_sources(spark, SF_SMALL)
    for y in (2013, 2014, 2014):
        pipeline.run_year(spark, wh, feeds, y, build_marts=False)
    for name in ("sat_user", "sat_payment", "sat_mdm"):
        want = sum(con.execute(f"select count(*) from ({q})").fetchone()[0] for q in (
            O.sat_year(name, 2013), O.sat_second_year(name, 2013, 2014), O.sat_rerun(name, 2013, 2014)))
        assert wh.read(name).count() == want, name
    _, _, _, pk, hd = pipeline.SATS["sat_user"]
    versions = pipeline._versions(wh, "sat_user_latest", pipeline._latest_schema(pk, hd))
    assert versions == [2013, 2014]


def test_stale_latest_version_after_a_crash_falls_back_to_history(spark, tmp_path):
    """A crash after the 2014 appends but before its latest-state versions were
    written must not change what 2015 inserts."""
    from vaultspark.plans import pipeline
    from vaultspark.sources import fixtures
    from vaultspark.sources.sinks import Warehouse

    feeds = fixtures.raw_sources(spark, SF_SMALL)
    clean = Warehouse.for_vault(spark, str(tmp_path / "clean"))
    crashed = Warehouse.for_vault(spark, str(tmp_path / "crashed"))
    for wh in (clean, crashed):
        for y in (2013, 2014):
            pipeline.run_year(spark, wh, feeds, y, build_marts=False)
    for name in pipeline.SATS:
        crashed.drop_partitions(f"{name}_latest", ["2014"], column="version")
    for wh in (clean, crashed):
        pipeline.run_year(spark, wh, feeds, 2015, build_marts=False)
    for name in pipeline.SATS:
        a = sorted(map(tuple, clean.read(name).collect()), key=repr)
        b = sorted(map(tuple, crashed.read(name).collect()), key=repr)
        assert a == b, name
