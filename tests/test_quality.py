"""Each rule type on a good and a bad batch, with NULLs."""

import datetime as dt

from vaultspark.operators import quality as Q


def run(spark, rows, schema, exps):
    df = spark.createDataFrame(rows, schema)
    out = Q.validate(df, "s", exps, "r", dt.datetime(2021, 1, 1))
    return [(r.success, r.element_count, r.missing_count, r.unexpected_count) for r in out.orderBy("rule_index").collect()]


def test_not_null(spark):
    e = [{"expectation_type": Q.NOT_NULL, "kwargs": {"column": "a"}}]
    assert run(spark, [(1,), (2,)], "a int", e) == [(True, 2, 0, 0)]
    assert run(spark, [(1,), (None,)], "a int", e) == [(False, 2, 1, 1)]


def test_type(spark):
    e = [{"expectation_type": Q.OF_TYPE, "kwargs": {"column": "a", "type_": "INTEGER"}},
         {"expectation_type": Q.OF_TYPE, "kwargs": {"column": "a", "type_": "TEXT"}},
         {"expectation_type": Q.OF_TYPE, "kwargs": {"column": "ip", "type_": "INET"}}]
    assert run(spark, [(1, "1.2.3.4"), (None, None)], "a int, ip string", e) == [
        (True, 2, 1, 0), (False, 2, 1, None), (True, 2, 1, 0)]
    assert run(spark, [(1, "1.2.3")], "a int, ip string", e)[2] == (False, 1, 0, 1)


def test_between_inclusive_and_null_skipped(spark):
    e = [{"expectation_type": Q.BETWEEN, "kwargs": {"column": "d", "min_value": "2012-01-01", "max_value": "2022-01-01"}},
         {"expectation_type": Q.BETWEEN, "kwargs": {"column": "n", "min_value": 0, "max_value": 10}}]
    good = [(dt.date(2012, 1, 1), 0), (dt.date(2022, 1, 1), 10), (None, None)]
    assert run(spark, good, "d date, n int", e) == [(True, 3, 1, 0), (True, 3, 1, 0)]
    bad = [(dt.date(2011, 12, 31), -1), (dt.date(2022, 1, 2), 11), (None, 5)]
    assert run(spark, bad, "d date, n int", e) == [(False, 3, 1, 2), (False, 3, 0, 2)]


def test_between_on_timestamps(spark):
    e = [{"expectation_type": Q.BETWEEN, "kwargs": {"column": "t", "min_value": "2013-01-01", "max_value": "2022-01-01"}}]
    rows = [(dt.datetime(2013, 1, 1),), (dt.datetime(2022, 1, 1, 0, 0, 1),)]
    assert run(spark, rows, "t timestamp_ntz", e) == [(False, 2, 0, 1)]


def test_regex(spark):
    e = [{"expectation_type": Q.REGEX, "kwargs": {"column": "a", "regex": r"^FL-\d+$"}}]
    assert run(spark, [("FL-1",), (None,)], "a string", e) == [(True, 2, 1, 0)]
    assert run(spark, [("FL-x",), ("fl-1",)], "a string", e) == [(False, 2, 0, 2)]


def test_compound_unique(spark):
    e = [{"expectation_type": Q.COMPOUND_UNIQUE, "kwargs": {"column_list": ["a", "b"]}}]
    assert run(spark, [("x", 1), ("x", 2), (None, None), (None, None)], "a string, b int", e) == [(True, 4, None, 0)]
    assert run(spark, [("x", 1), ("x", 1), ("y", 1)], "a string, b int", e) == [(False, 3, None, 2)]


def test_sets(spark):
    s = ["MASTER", "MIR", "VISA"]
    e = [{"expectation_type": Q.IN_SET, "kwargs": {"column": "a", "value_set": s}},
         {"expectation_type": Q.EQUAL_SET, "kwargs": {"column": "a", "value_set": s}}]
    assert run(spark, [("MIR",), ("VISA",), ("MASTER",), (None,)], "a string", e) == [
        (True, 4, 1, 0), (True, 4, 1, 0)]
    # subset passes in_set but fails equal_set (one member missing); an outsider fails both
    assert run(spark, [("MIR",), ("VISA",)], "a string", e) == [(True, 2, 0, 0), (False, 2, 0, 1)]
    assert run(spark, [("AMEX",), ("MIR",), ("VISA",), ("MASTER",)], "a string", e) == [
        (False, 4, 0, 1), (False, 4, 0, 1)]


def test_suites_have_the_reference_rule_counts():
    assert [len(Q.SUITES[s][1]) for s in ("billing", "issue", "payment", "traffic")] == [15, 12, 23, 11]


def test_run_results_and_summary(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    e = [{"expectation_type": Q.NOT_NULL, "kwargs": {"column": "a"}}]
    res = Q.validate_batches([(df, "s1", e), (df, "s2", e)], "run-1", dt.datetime(2021, 1, 1))
    assert res.count() == 2
    summ = {r.suite: (r.rules, r.failed, r.success) for r in Q.summary(res).collect()}
    assert summ == {"s1": (1, 1, False), "s2": (1, 1, False)}


def test_load_suite_from_json(tmp_path):
    import json

    p = tmp_path / "suite.json"
    p.write_text(json.dumps({"expectation_suite_name": "x.warning",
                             "expectations": [{"expectation_type": Q.NOT_NULL, "kwargs": {"column": "a"}}]}))
    name, exps = Q.load_suite(str(p))
    assert name == "x.warning" and exps[0]["kwargs"]["column"] == "a"
