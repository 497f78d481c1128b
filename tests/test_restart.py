"""Backfills that are stopped between any two writes: readers see old or new tables only, a restart goes on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vaultspark.plans import pipeline
from vaultspark.sources import fixtures, schemas
from vaultspark.sources.sinks import PARTITION_COLUMN, Journal, Warehouse

TABLES = {**{f"hub_{h}": schemas.hub_schema(h) for h in pipeline.HUBS}, "link_payment": schemas.LINK_PAYMENT,
          **{n: s[0] for n, s in pipeline.SATS.items()}, "report_tmp": schemas.REPORT}


class Killed(BaseException):
    """Stands for the end of the driver: nothing catches it."""


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def contents(wh, names=TABLES):
    return {n: rows(wh.read(n, names[n]).select(*names[n].names)) for n in names}


@pytest.fixture(scope="module")
def feeds(spark, tmp_path_factory):
    """The feeds with quirks, a quarter of them, as files."""
    root = tmp_path_factory.mktemp("feeds")
    out = {}
    for name, df in fixtures.quirk_sources(spark, SF_SMALL).items():
        key = {"billing": "user_id", "issue": "user_id", "payment": "user_id", "traffic": "user_id", "user": "id"}[name]
        df.where(F.pmod(F.col(key).cast("int"), F.lit(4)) == 0).coalesce(1).write.parquet(f"{root}/{name}")
        out[name] = spark.read.schema(df.schema).parquet(f"{root}/{name}")
    return out


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory, feeds):
    wh = Warehouse.for_vault(spark, str(tmp_path_factory.mktemp("clean")), n=2)
    pipeline.run_years(spark, wh, feeds, [2013, 2014])
    return contents(wh)


def test_atomic_warehouse_has_the_same_tables(spark, tmp_path, feeds, clean):
    wh = Warehouse.for_vault(spark, str(tmp_path), n=2, atomic=True)
    pipeline.run_years(spark, wh, feeds, [2013, 2014], run="one")
    assert contents(wh) == clean
    again = Warehouse.for_vault(spark, str(tmp_path), n=2, atomic=True)
    assert again.parts("sat_user").keys() == {"2013.1", "2014.1"}
    assert contents(again) == clean  # also after the vacuum at the end of the run


def test_stopped_at_any_write_and_started_again(spark, tmp_path, feeds, clean, monkeypatch):
    """Each write of a list or journal entry of the second year ends the driver once, before it and after it; each time the
    run is started again by its name."""
    wh = Warehouse.for_vault(spark, str(tmp_path), n=2, atomic=True)
    publish, write = Warehouse._publish, Journal.write
    stops = {"left": 0, "after": False, "hit": 0}

    def stopping(real):
        def call(self, *args):
            stops["left"] -= 1
            if stops["left"] == 0 and not stops["after"]:
                raise Killed
            real(self, *args)
            if stops["left"] == 0:
                raise Killed
        return call
    monkeypatch.setattr(Warehouse, "_publish", stopping(publish))
    monkeypatch.setattr(Journal, "write", stopping(write))
    seen = {}
    for after in (False, True):
        for left in (3, 7, 12, 9, 5, 8):
            stops.update(left=left, after=after)
            before = {n: wh.parts(n) for n in wh.names()}
            try:
                pipeline.run_years(spark, wh, feeds, [2013, 2014], parallel=False, run="night")
                break
            except Killed:
                stops["hit"] += 1
            for n in wh.names():  # every part that is listed is whole, whatever was being written
                for part, where in wh.parts(n).items():
                    fs, hp = wh._hadoop(f"{where}/_SUCCESS" if "=" not in where.rsplit("/", 1)[1] else where)
                    assert fs.exists(hp), (n, part)
                seen.setdefault(n, []).append(before.get(n))
    stops.update(left=-1)
    assert stops["hit"] >= 8
    pipeline.run_years(spark, wh, feeds, [2013, 2014], parallel=False, run="night")
    assert contents(wh) == clean
    assert wh.parts("sat_payment").keys() == {"2013.1", "2014.1"}


def test_restart_skips_finished_layers(spark, tmp_path, feeds, monkeypatch):
    wh = Warehouse.for_vault(spark, str(tmp_path), n=2, atomic=True)
    done = []
    for name in ("load_ods", "load_staging", "load_hubs", "load_links", "load_sats"):
        real = getattr(pipeline, name)
        monkeypatch.setattr(pipeline, name, lambda *a, real=real, name=name, **k: done.append(name) or real(*a, **k))
    journal = Journal(wh, "r")

    def stop(*a, **k):
        raise Killed
    with monkeypatch.context() as m:
        m.setattr(pipeline, "load_links", stop)
        with pytest.raises(Killed):
            pipeline.run_year(spark, wh, feeds, 2013, build_marts=False, journal=journal)
    assert done == ["load_ods", "load_staging", "load_hubs"]
    done.clear()
    pipeline.run_year(spark, wh, feeds, 2013, build_marts=False, journal=journal)
    assert done == ["load_links", "load_sats"]
    done.clear()
    pipeline.run_year(spark, wh, feeds, 2013, build_marts=False, journal=journal)
    assert done == []


def test_partition_reload_is_old_or_new(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path), atomic=True)
    schema = pipeline._with_part(schemas.ODS_ISSUE)

    def batch(*ids):
        return spark.createDataFrame([(i, dt.datetime(2014, 3, 1), None, "t", "d", "s") for i in ids], schemas.ODS_ISSUE)
    wh.create_if_missing("ods_issue", schema, PARTITION_COLUMN)
    assert wh.read("ods_issue", schema).count() == 0
    wh.overwrite_partition("ods_issue", "2013", batch(1))
    wh.overwrite_partition("ods_issue", "2014", batch(2, 3))
    real = Warehouse._publish

    def stop(*a):
        raise Killed
    monkeypatch.setattr(Warehouse, "_publish", stop)
    with pytest.raises(Killed):
        wh.overwrite_partition("ods_issue", "2014", batch(9))
    monkeypatch.setattr(Warehouse, "_publish", real)
    assert [(r.user_id, r.part) for r in wh.read("ods_issue", schema).orderBy("user_id").collect()] == [(1, "2013"), (2, "2014"), (3, "2014")]
    held = wh.read("ods_issue", schema)  # a reader of the old list keeps its files
    wh.overwrite_partition("ods_issue", "2014", batch())
    assert held.count() == 3 and wh.read("ods_issue", schema).count() == 1
    plan = wh.read("ods_issue", schema).where("part = '2013'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1  # other partitions are not scanned
    two = batch(5).withColumn(PARTITION_COLUMN, F.lit("2015"))
    wh.overwrite_partitions("ods_issue", two)
    assert sorted(wh.partitions("ods_issue", PARTITION_COLUMN)) == ["2013", "2014", "2015"]
    wh.drop_partitions("ods_issue", ["2013", "1999"])
    wh.vacuum()
    assert [r.user_id for r in wh.read("ods_issue", schema).collect()] == [5]


def test_two_writers_are_noticed(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), atomic=True)
    wh.replace("t", spark.range(1))
    assert not wh.write_once("t", spark.range(2)) and wh.read("t").count() == 1
    other = Warehouse(spark, str(tmp_path), atomic=True)
    lists = wh._lists
    other._publish("t", {})
    wh._lists = lambda name: lists(name)[:-1]  # has not seen the other's list
    with pytest.raises(Exception):
        wh._publish("t", {})
