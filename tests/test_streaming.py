import datetime as dt

from vaultspark.operators import ods
from vaultspark.plans import pipeline
from vaultspark.sources import schemas
from vaultspark.sources.sinks import Warehouse
from vaultspark.streaming import watch_feed


def test_new_files_trigger_the_year_reload(spark, tmp_path):
    landing = tmp_path / "issue"
    wh = Warehouse(spark, str(tmp_path / "wh"))
    rows = [("5", dt.datetime(2014, 3, 1), dt.datetime(2014, 3, 1, 1), "error", "{}", "svc1"),
            ("6", dt.datetime(2015, 3, 1), dt.datetime(2015, 3, 1, 1), "error", "{}", "svc2")]
    spark.createDataFrame(rows[:1], schemas.STG_ISSUE).write.parquet(str(landing / "2014"))
    feed = lambda: spark.read.schema(schemas.STG_ISSUE).parquet(str(landing / "*"))
    seen = []

    def reload(year):
        seen.append(year)
        wh.create_if_missing("ods_issue", pipeline._with_part(schemas.ODS_ISSUE), "part")
        wh.overwrite_partition("ods_issue", str(year), ods.ods_issue(feed(), year))

    ck = str(tmp_path / "ck")
    watch_feed(spark, "issue", str(landing / "*"), reload, ck).awaitTermination()
    spark.createDataFrame(rows[1:], schemas.STG_ISSUE).write.parquet(str(landing / "2015"))
    watch_feed(spark, "issue", str(landing / "*"), reload, ck).awaitTermination()
    assert seen == [2014, 2015]  # the second run only sees the new folder
    schema = pipeline._with_part(schemas.ODS_ISSUE)
    parts = sorted(r.part for r in wh.read("ods_issue", schema).select("part").collect())
    assert parts == ["2014", "2015"]
