import math

import pytest
from pyspark.sql import functions as F

from sparktab.operators.moments import Scale, apply_state, fit_state, merge_states
from sparktab.operators.preprocess import Branch, PreprocessError, Preprocessor

KIND = "id int, x double, `a.b` double, same double, none double, part string"


def rows(spark, n=300):
    data = []
    for i in range(n):
        x = None if i % 7 == 0 else math.nan if i % 11 == 0 else 1e9 + i * 0.25
        data.append((i, x, float(i * i), 5.0, None, None if i % 5 == 0 else f"p{i % 3}"))
    return spark.createDataFrame(data, KIND)


COLUMNS = ["x", "a.b", "same", "none"]


def close(a, b):
    for c in COLUMNS:
        for f in ("rows", "n", "mean", "m2", "low", "high"):
            x, y = a[c][f], b[c][f]
            # A mean is kept to its last digit, so deviations cannot be known better than that digit allows.
            least = 4 * math.ulp(b[c]["mean"]) * math.sqrt(b[c]["n"] * b[c]["m2"]) if f == "m2" and b[c]["n"] else 0
            assert x == y or math.isclose(x, y, rel_tol=1e-9, abs_tol=least), (c, f, x, y)


def test_parts_merge_to_the_whole(spark):
    df = rows(spark)
    whole = fit_state(df, COLUMNS).first()
    halves = fit_state(df.where("id < 100"), COLUMNS).unionByName(fit_state(df.where("id >= 100"), COLUMNS))
    empty = fit_state(df.where("false"), COLUMNS)
    close(merge_states(halves.unionByName(empty), COLUMNS).first(), whole)
    parts = fit_state(df.withColumn("day", F.col("id") % 13), COLUMNS, ["part", "day"])
    by_part = merge_states(parts, COLUMNS, ["part"])
    assert by_part.count() == 4  # a null part is a group
    close(merge_states(by_part, COLUMNS).first(), whole)
    assert whole["same"]["m2"] == 0 and whole["none"]["mean"] is None and whole["none"]["rows"] == 300


@pytest.mark.parametrize("scaler", [None, "minmax", "standard"])
@pytest.mark.parametrize("impute", [False, True])
def test_same_as_the_preprocessor(spark, scaler, impute):
    df = rows(spark)
    learn = df.where("id % 2 = 0")
    columns = ["x", "same"]
    plan = Preprocessor([Branch(c, "numeric", impute="mean" if impute else None, scaler=scaler) for c in columns])
    want = plan.transform(df, plan.fit(learn), ["id"]).orderBy("id").collect()
    got = apply_state(df, fit_state(learn, columns), {c: Scale(scaler, impute) for c in columns}).orderBy("id").collect()
    # Two roundings of a mean near 1e9 differ by its last digit; scaling divides that by the deviation, about 20.
    least = 4 * math.ulp(1e9) / (20 if scaler == "standard" else 1)
    for a, b in zip(want, got, strict=True):
        for i, c in enumerate(columns, 1):
            assert (a[i] is None and b[c] is None) or math.isclose(a[i], b[c], rel_tol=1e-9, abs_tol=least)


def test_one_plan(spark):
    """Neither fitting nor applying runs a job before the result is asked for, and no join is needed."""
    df = rows(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    out = apply_state(df, merge_states(fit_state(df, ["x"], ["part"]), ["x"]), {"x": Scale("standard", True)})
    assert not tracker.getJobIdsForGroup("lazy")
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString().replace("Subquery", "")
    assert out.count() == 300


def test_nothing_to_learn_from(spark):
    df = rows(spark, 5)
    out = apply_state(df, fit_state(df.where("false"), ["x"]), {"x": Scale("minmax")}).collect()
    assert [r.x for r in out] == [None] * 5
    with pytest.raises(PreprocessError):
        apply_state(df, fit_state(df, ["x"]), {"x": Scale("robust")})
    with pytest.raises(PreprocessError):
        fit_state(df, ["not there"])
