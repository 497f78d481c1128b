"""Write PLANS.md: the executed (final adaptive) physical plans of the yearly
loads, taken on a warehouse that already holds one year.

Usage: python tests/explain_plans.py [sf_dir]   (default /root/testdata/sf0.01)
Broadcast joins are switched off so the plans show the shapes a large
warehouse gets (at small sizes AQE would broadcast the small sides).
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from vaultspark import get_session  # noqa: E402
from vaultspark.operators import marts, quality, vault  # noqa: E402
from vaultspark.plans import pipeline as P  # noqa: E402
from vaultspark.sources import fixtures, schemas  # noqa: E402
from vaultspark.sources.sinks import Warehouse, shared_root  # noqa: E402

KEEP = ("Exchange", "Join", "Aggregate", "Window", "Scan", "Union", "BroadcastExchange",
        "Generate", "Expand", "WindowGroupLimit", "ReusedExchange", "isFinalPlan")


def tree(df) -> str:
    df.collect()  # run through the frame's own query execution: the final adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    out = []
    for ln in plan.split("\n"):
        if not any(k in ln for k in KEEP):
            continue
        ln = re.sub(r"#\d+L?", "", ln)
        if "ReusedExchange" in ln:
            ln = ln[: ln.index("ReusedExchange")] + "ReusedExchange (computed once, read twice)"
        elif "FileScan" in ln:  # keep what the scan reads and what it is given
            head = ln[: ln.index("FileScan")] + re.match(r".*?(FileScan \S+ \S*?\[[^\]]*\])", ln).group(1)
            keep = [m.group(0) for m in re.finditer(
                r"(Bucketed: true|PartitionFilters: \[[^\]]*\]|PushedFilters: \[[^\]]*\])", ln)]
            ln = head + " " + ", ".join(keep)
        out.append(ln[:260])
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    wh = Warehouse.for_vault(spark, shared_root(spark, "plans"))
    raw = fixtures.raw_sources(spark, sf)
    P.run_year(spark, wh, raw, 2013, build_marts=False)
    ld = P.load_date_of(2014)
    P.load_ods(wh, raw, 2014)
    stg = P.load_staging(wh, 2014, ld)
    from vaultspark.operators import staging

    states, _ = P.known_states(wh, "sat_user", wh.read("sat_user", schemas.SAT_USER), 2014)
    payments = wh.read("sat_payment", schemas.SAT_PAYMENT)

    sections = {
        "Staging of one year (ODS partition read, one projection)":
            staging.stage(P.ods_slice(wh, "payment", 2014), staging.PAYMENT, ld, 2014),
        "Hub load: five stagings, first row per key, anti join with the bucketed hub":
            vault.hub_rows("user", [stg[s] for s in P.HUBS["user"]], wh.read("hub_user")),
        "Link load: distinct, anti join with the bucketed link":
            vault.link_payment_rows(stg["payment"], wh.read("link_payment")),
        "Satellite load with change collapse (sat_user)":
            vault.sat_user_rows(stg["payment"], wh.read("sat_user", schemas.SAT_USER), as_of=ld),
        "Satellite load (sat_payment)":
            vault.sat_payment_rows(stg["payment"], wh.read("sat_payment", schemas.SAT_PAYMENT), as_of=ld),
        "Satellite load against the chain of states (sat_user)":
            vault.sat_user_rows(stg["payment"], states, as_of=ld),
        "Report delta of one load (sums per user and billing year)":
            marts.user_year_sums(wh.read("link_payment"), payments.where("LOAD_DATE = timestamp_ntz'2013-01-01 00:00:00'"),
                                 wh.read("hub_billing_period")),
        "Payment report (pre-aggregated before the user joins)":
            marts.payment_report(wh.read("link_payment"), wh.read("sat_payment", schemas.SAT_PAYMENT),
                                 wh.read("hub_billing_period"), wh.read("hub_user"),
                                 wh.read("ods_user", schemas.ODS_USER), order=False),
        "Data-quality suite (payment, 23 rules)":
            quality.validate(P.ods_slice(wh, "payment", 2014), *quality.SUITE_PAYMENT, "r", "2021-01-01"),
    }
    lines = ["# Physical plans", "",
             "Executed (final adaptive) plans of the yearly loads at " + Path(sf).name +
             ", year 2014 on a warehouse holding 2013; broadcast joins off to show the large-scale shapes.",
             "Sorts and projections are left out; every Exchange is a shuffle, every Scan line shows the",
             "columns read and the filters the Parquet reader receives.",
             "Generated by `python tests/explain_plans.py`.", ""]
    for title, df in sections.items():
        lines += [f"## {title}", "", "```", tree(df), "```", ""]
    (ROOT / "PLANS.md").write_text("\n".join(lines))


if __name__ == "__main__":
    main()
