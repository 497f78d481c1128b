"""Measure how a key, or a (key, date), holding a third of all rows is spread over
tasks: the plain ``lag over (partition by key)`` vs :func:`vault.collapse_repeats`.

Reads Spark's event log (written to a scratch folder; the UI stays off) and
prints, for the stage that runs each window, the largest and the mean number
of shuffle records read per task.  Usage: python tests/skew_evidence.py [rows]
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import Window as W  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from vaultspark.operators import vault  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    logdir = tempfile.mkdtemp(prefix="skew-evlog-", dir="/tmp")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "32").config("spark.sql.adaptive.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
             .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # one key holds a third of all rows; the others are spread over 100k keys
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 100003).cast("string")).alias("k"),
        (F.col("id") % 365).alias("d"), F.col("id").alias("t"), (F.col("id") % 5).alias("v"))
    spark.sparkContext.setJobGroup("plain", "plain lag")
    plain = df.withColumn("p", F.lag("v").over(W.partitionBy("k").orderBy("d", "t"))).where(
        ~F.col("v").eqNullSafe(F.col("p")))
    plain.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("bucketed", "collapse_repeats")
    vault.collapse_repeats(df, "k", "v", ["d", "t"]).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("hot-date", "collapse_repeats, a third of all rows on one (key, date)")
    one_date = df.withColumn("d", F.when(F.col("k") == "hot", F.lit(7)).otherwise(F.col("d")))
    vault.collapse_repeats(one_date, "k", "v", ["d", "t"]).write.format("noop").mode("overwrite").save()
    hub_in = df.select(F.col("k").alias("PK"), F.col("t").cast("string").alias("KEY"),
                       F.lit("2013-01-01 00:00:00").cast("timestamp_ntz").alias("LOAD_DATE"),
                       F.lit("SRC").alias("RECORD_SOURCE"))
    spark.sparkContext.setJobGroup("hub-rownum", "row_number window")
    rn = F.row_number().over(W.partitionBy("PK").orderBy("LOAD_DATE", "RECORD_SOURCE", "KEY"))
    hub_in.withColumn("rn", rn).where("rn = 1").write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("hub-agg", "first_per_key aggregate")
    vault.new_hub_rows(hub_in, "PK", "KEY").write.format("noop").mode("overwrite").save()
    app = spark.sparkContext.applicationId
    spark.stop()

    stage_group: dict[int, str] = {}
    reads: dict[int, list[int]] = {}
    files = [p for p in glob.glob(f"{logdir}/**/*{app}*", recursive=True) if Path(p).is_file()]
    files += [p for p in glob.glob(f"{logdir}/*{app}*/*") if Path(p).is_file()]
    for path in sorted(set(files)):
        if path.endswith((".zstd", ".lz4", ".snappy")):
            continue
        for line in open(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                grp = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = grp
            elif kind == "SparkListenerTaskEnd":
                m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                recs = m.get("Total Records Read", 0)
                if recs:
                    reads.setdefault(ev["Stage ID"], []).append(recs)
    print(f"rows={n}, hot key = 1/3 of rows, 32 shuffle partitions")
    for sid, rs in sorted(reads.items()):
        grp = stage_group.get(sid)
        if not grp or len(rs) < 2:
            continue
        mean = sum(rs) / len(rs)
        print(f"{grp:10s} stage {sid:3d}: tasks={len(rs):3d} max={max(rs):>9,d} mean={mean:>11,.0f} "
              f"max/mean={max(rs) / mean:5.1f}")


if __name__ == "__main__":
    main()
