import json

import pytest

from sparktab.operators import validate as v
from sparktab.functions.values import matches_logical_type

RULES = [
    {"name": "shelf", "dtype": "int", "min": 3, "max": 40},
    {"name": "grade", "dtype": "int", "required": False, "allowed_values": [7, 8, 9]},
    {"name": "note", "dtype": "float", "required": False},
]


def found(report):
    return {(r.column, r.check): (r.severity, r.n) for r in report.collect()}


def test_rule_findings(spark):
    df = spark.createDataFrame([(2, 7), (41, 8), (1, 6), (20, 9)], "shelf int, grade int")
    report = found(v.validate(df, RULES))
    assert report["shelf", "below_min"] == ("error", 2)
    assert report["shelf", "above_max"] == ("error", 1)
    assert report["grade", "invalid"] == ("error", 1)
    assert report["note", "presence"] == ("info", 1)


def test_report_is_read_once(spark):
    df = spark.createDataFrame([(2, 7)], "shelf int, grade int")
    plan = v.validate(df, RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan
    assert v.structure_report(df, RULES).where("check = 'dtype' and severity = 'ok'").count() == 2


def test_messages_read_like_sentences(spark):
    df = spark.createDataFrame([(2, 6)], "shelf int, grade int")
    messages = {r.message for r in v.validate(df, RULES).where("severity = 'error'").collect()}
    assert "Column 'shelf' has 1 values below min 3" in messages
    assert "Column 'grade' has 1 invalid values not in [7, 8, 9]" in messages


def test_policy(spark):
    df = spark.createDataFrame([(None,)], "shelf int")
    report = v.validate(df, RULES[:1])
    assert v.enforce(report, "warn") == ["Column 'shelf' has 1 missing values (required)"]
    with pytest.raises(v.ValidationError):
        v.enforce(report, "raise")


def test_passing_table_and_report_file(spark, tmp_path):
    df = spark.createDataFrame([(12, 8, 0.5)], "shelf int, grade int, note double")
    settings = {"schema": {"columns": RULES}, "report_path": str(tmp_path / "r")}
    report = v.run_validation(df, {"data_validation": settings})
    assert v.report_status(report).first().status == "pass"
    text = "".join(p.read_text() for p in (tmp_path / "r").glob("*.json"))
    assert json.loads(text)["status"] == "pass"


def test_report_is_written_before_raising(spark, tmp_path):
    df = spark.createDataFrame([(None,)], "shelf int")
    settings = {"schema": {"columns": RULES[:1]}, "report_path": str(tmp_path / "r")}
    with pytest.raises(v.ValidationError):
        v.run_validation(df, {"data_validation": settings})
    assert json.loads("".join(p.read_text() for p in (tmp_path / "r").glob("*.json")))["errors"]


def test_disabled_or_empty_rules(spark):
    df = spark.range(1)
    assert v.run_validation(df, {"data_validation": {"enabled": False}}) is None
    assert v.run_validation(df, {}) is None


def test_types(spark):
    df = spark.createDataFrame([(1, 1.0, "a", True)], "i int, f double, s string, b boolean")
    for name, logical in (("i", "int"), ("f", "float"), ("s", "str"), ("b", "bool")):
        assert matches_logical_type(df.schema[name].dataType, logical)
    assert not matches_logical_type(df.schema["f"].dataType, "int")


def test_wrong_type_stops_further_checks(spark):
    df = spark.createDataFrame([(0.5,)], "shelf double")
    report = found(v.validate(df, RULES[:1]))
    assert report == {("shelf", "presence"): ("ok", 0), ("shelf", "dtype"): ("error", 1)}


def test_nan_and_null(spark):
    rows = [(float("nan"),), (None,), (-1.0,), (5.0,), (99.0,)]
    df = spark.createDataFrame(rows, "x double")
    rules = [{"name": "x", "dtype": "float", "min": 0, "max": 10, "allowed_values": [5.0]}]
    report = found(v.validate(df, rules))
    assert report["x", "missing"][1] == 2
    assert report["x", "below_min"][1] == 1
    assert report["x", "above_max"][1] == 1
    assert report["x", "invalid"][1] == 4


def test_one_scan_for_all_rules(spark, small):
    """Broken rows of all columns are counted by one job."""
    df = spark.read.parquet(f"{small}/customer.parquet")
    rules = [{"name": "c_acctbal", "dtype": "float", "min": 0}, {"name": "c_nationkey", "dtype": "int", "max": 3}]
    spark.sparkContext.setJobGroup("rules", "count")
    report = v.validate(df, rules)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("rules"))
    spark.sparkContext.setJobGroup("", "")
    assert jobs <= 2 and report.where("n > 0").count() == 2  # with adaptive plans the scan and the sum are jobs of their own


def test_quarantine_splits_rows(spark):
    df = spark.createDataFrame([(1, 6), (5, 9), (50, None)], "shelf int, grade int")
    valid, rejected = v.quarantine(df, RULES)
    assert [r.shelf for r in valid.collect()] == [5]
    assert {r.shelf: r.violations for r in rejected.collect()} == {
        1: ["shelf:below_min", "grade:invalid"],
        50: ["shelf:above_max", "grade:invalid"],
    }


def test_samples(spark):
    df = spark.createDataFrame([(i % 7, None) for i in range(50)], "shelf int, grade int")
    rows = v.sample_values(df, RULES).collect()
    assert sorted(r.value for r in rows) == ["0", "1", "2", "3", "4"]
