"""Column rules: one aggregation for all rules, a long report, and row-level rejects.

A rule is a mapping ``{name, dtype, required, min, max, allowed_values}``; only
``name`` must be there and ``required`` defaults to true.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparktab.functions.values import is_floating, is_missing, matches_logical_type, quoted, type_of

log = logging.getLogger(__name__)

Rule = Mapping[str, Any]

REPORT_SCHEMA = "ordinal int, column string, check string, severity string, n bigint, message string"

# The checks of the report and how each finding reads.
CHECKS = ("presence", "dtype", "missing", "below_min", "above_max", "invalid")
MESSAGES = {
    "presence": "Missing required column: {name}",
    "absent": "optional not present",
    "dtype": "Column '{name}' dtype '{found}' != expected '{expected}'",
    "missing": "Column '{name}' has {n} missing values ({need})",
    "below_min": "Column '{name}' has {n} values below min {bound}",
    "above_max": "Column '{name}' has {n} values above max {bound}",
    "invalid": "Column '{name}' has {n} invalid values not in {allowed}",
}


class ValidationError(Exception):
    """The table breaks a rule and the policy is to stop."""


def is_required(rule: Rule) -> bool:
    return rule.get("required", True)


def structure_findings(df: DataFrame, rules: Sequence[Rule]) -> list[tuple]:
    """Presence and type findings as (ordinal, column, check, severity, n, message)."""
    found = []
    for i, rule in enumerate(rules):
        name, expected = rule["name"], rule.get("dtype")
        if name not in df.columns:
            severity, key = ("error", "presence") if is_required(rule) else ("info", "absent")
            found.append((i, name, "presence", severity, 1, MESSAGES[key].format(name=name)))
            continue
        found.append((i, name, "presence", "ok", 0, None))
        if expected:
            fits = matches_logical_type(type_of(df, name), expected)
            message = MESSAGES["dtype"].format(
                name=name, found=type_of(df, name).simpleString(), expected=expected
            )
            found.append((i, name, "dtype", "ok", 0, None) if fits else (i, name, "dtype", "error", 1, message))
    return found


def checkable(df: DataFrame, rules: Sequence[Rule]) -> list[tuple[int, Rule]]:
    """Rules whose column is there with the right type; only these look at values."""
    stopped = {f[0] for f in structure_findings(df, rules) if f[3] in ("error", "info")}
    return [(i, r) for i, r in enumerate(rules) if i not in stopped]


def value_checks(df: DataFrame, rule: Rule) -> dict[str, Column]:
    """Per check the condition under which a row breaks the rule.

    A missing value breaks no bound, but it is not an allowed value.
    """
    name = rule["name"]
    value, missing = quoted(name), is_missing(df, name)
    checks = {"missing": missing}
    if "min" in rule:
        checks["below_min"] = ~missing & (value < F.lit(rule["min"]))
    if "max" in rule:
        checks["above_max"] = ~missing & (value > F.lit(rule["max"]))
    if "allowed_values" in rule:
        inside = value.isin(list(rule["allowed_values"]))
        if is_floating(df, name):
            inside = inside & ~F.isnan(value)
        checks["invalid"] = ~F.coalesce(inside, F.lit(False))
    return checks


def _message(rule: Rule, check: str, n: int) -> str:
    return MESSAGES[check].format(
        name=rule["name"],
        n=n,
        need="required" if is_required(rule) else "optional",
        bound=rule.get("min" if check == "below_min" else "max"),
        allowed=list(rule.get("allowed_values", ())),
    )


def structure_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The presence and type rows of the report; reads no data."""
    return df.sparkSession.createDataFrame(structure_findings(df, rules), REPORT_SCHEMA)


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The report: one row per column and check, with severity ok/info/warning/error.

    All value checks of all columns are one aggregation over one scan that
    reads only the ruled columns. Its one row comes to the driver, and the
    report is built from it, so nothing is read again.
    """
    checks = _value_checks(df, rules)
    counts = df.agg(*_counts(checks)).first() if checks else ()
    return _report(df, rules, checks, counts)


def _value_checks(df: DataFrame, rules: Sequence[Rule]) -> list[tuple[int, Rule, str, Column]]:
    return [(i, rule, check, broken) for i, rule in checkable(df, rules) for check, broken in value_checks(df, rule).items()]


def _counts(checks: Sequence[tuple]) -> list[Column]:
    return [F.count_if(broken).alias(f"c{at}") for at, (*_, broken) in enumerate(checks)]


def _report(df: DataFrame, rules: Sequence[Rule], checks: Sequence[tuple], counts: Sequence[int]) -> DataFrame:
    found = structure_findings(df, rules)
    for (i, rule, check, _), n in zip(checks, counts, strict=True):
        bad = "warning" if check == "missing" and not is_required(rule) else "error"
        found.append((i, rule["name"], check, bad, n, _message(rule, check, n)) if n else (i, rule["name"], check, "ok", 0, None))
    return df.sparkSession.createDataFrame(found, REPORT_SCHEMA)


class Watch:
    """Rules counted while a table is on its way to somewhere else, so that it is not read for them.

    ``df`` is the table to write or otherwise run to its end, once; ``report`` and
    ``n_rows`` then have what passed. They wait for that job.
    """

    def __init__(self, df: DataFrame, rules: Sequence[Rule]) -> None:
        self._source, self._rules, self._checks = df, rules, _value_checks(df, rules)
        self._seen = Observation()
        self.df = df.observe(self._seen, F.count(F.lit(1)).alias("n_rows"), *_counts(self._checks))

    @property
    def n_rows(self) -> int:
        return self._seen.get["n_rows"]

    def report(self) -> DataFrame:
        """The report ``validate`` would give of the same rows."""
        return _report(self._source, self._rules, self._checks, [self._seen.get[f"c{at}"] for at in range(len(self._checks))])


def report_status(report: DataFrame) -> DataFrame:
    """One row: status, number of errors and of warnings."""
    errors = F.count_if(F.col("severity") == "error")
    return report.agg(
        F.when(errors > 0, "fail").otherwise("pass").alias("status"),
        errors.alias("n_errors"),
        F.count_if(F.col("severity") == "warning").alias("n_warnings"),
    )


def report_document(report: DataFrame) -> DataFrame:
    """One nested row: status, errors, warnings and details, for a JSON sink.

    Gathers the report itself, whose length is rules x checks.
    """
    def messages(severity: str) -> Column:
        found = F.sort_array(
            F.collect_list(
                F.when(F.col("severity") == severity, F.struct("ordinal", "check", "message"))
            )
        )
        return F.transform(found, lambda item: item["message"])

    details = F.sort_array(F.collect_list(F.struct("ordinal", "column", "check", "severity", "n")))
    status = F.when(F.count_if(F.col("severity") == "error") > 0, "fail").otherwise("pass")
    return report.agg(
        status.alias("status"),
        messages("error").alias("errors"),
        messages("warning").alias("warnings"),
        details.alias("details"),
    )


def report_matrix(report: DataFrame) -> DataFrame:
    """Columns by checks, check names sorted; a check that was not run is null."""
    wide = report.groupBy("ordinal", "column").pivot("check", sorted(CHECKS))
    return wide.agg(F.first("severity")).drop("ordinal")


def _smallest(names: Sequence[str], n: int):
    """Per task the n smallest distinct texts of every column."""

    def pick(batches):
        kept = {name: pa.array([], pa.string()) for name in names}
        for batch in batches:
            for at, name in enumerate(names):
                values = pc.unique(pa.concat_arrays([kept[name], batch.column(at)]).drop_null())
                kept[name] = values.take(pc.array_sort_indices(values)[:n])
        columns = [pa.array([name for name in names for _ in kept[name]], pa.string())]
        columns.append(pa.concat_arrays([kept[name] for name in names]))
        yield pa.RecordBatch.from_arrays(columns, names=["column", "value"])

    return pick


def sample_values(df: DataFrame, rules: Sequence[Rule], n: int = 5) -> DataFrame:
    """Up to n distinct present values per checked column, as text, the smallest first.

    Every task keeps n values per column, so a column of distinct keys or of
    one hot value shuffles no more than that.
    """
    names = [rule["name"] for _, rule in checkable(df, rules)]
    texts = [F.when(~is_missing(df, c), quoted(c).cast("string")).alias(f"c{i}") for i, c in enumerate(names)]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, value string, place int")
    values = df.select(*texts).mapInArrow(_smallest(names, n), "column string, value string").distinct()
    place = F.row_number().over(W.partitionBy("column").orderBy("value"))
    return values.withColumn("place", place).where(F.col("place") <= n)


def enforce(report: DataFrame, action: str = "raise") -> list[str]:
    """Stop on errors, or only warn; returns the error messages."""
    rows = report.where(F.col("severity").isin("error", "warning")).orderBy("ordinal", "check").collect()
    errors = [r.message for r in rows if r.severity == "error"]
    for row in rows:
        log.log(logging.ERROR if row.severity == "error" else logging.WARNING, row.message)
    if errors and action.lower() == "raise":
        raise ValidationError("; ".join(errors))
    return errors


def configured_rules(config: Mapping[str, Any]) -> Sequence[Rule]:
    """The rules of a ``data_validation`` setting; none if it is disabled."""
    settings = config.get("data_validation", {})
    rules = settings.get("schema", {}).get("columns", [])
    if not settings.get("enabled", True) or not rules:
        log.info("validation is disabled or has no rules")
        return []
    return rules


def act_on(report: DataFrame, config: Mapping[str, Any]) -> None:
    """Write the report where the setting asks for it, and stop or warn."""
    settings = config.get("data_validation", {})
    if settings.get("report_path"):
        from sparktab.sources.writers import write_json

        write_json(report_document(report), settings["report_path"])
    enforce(report, settings.get("action_on_error", "raise"))


def run_validation(df: DataFrame, config: Mapping[str, Any]) -> DataFrame | None:
    """Apply a ``data_validation`` setting: rules, policy, or nothing if disabled."""
    rules = configured_rules(config)
    if not rules:
        return None
    report = validate(df, rules)
    act_on(report, config)
    return report


def with_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``violations``: the ``column:check`` names a row breaks.

    A missing value in an optional column is a warning and breaks nothing.
    """
    broken = [
        F.when(condition, F.lit(f"{rule['name']}:{check}"))
        for _, rule in checkable(df, rules)
        for check, condition in value_checks(df, rule).items()
        if check != "missing" or is_required(rule)
    ]
    found = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return df.withColumn("violations", found)


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their violations."""
    marked = with_violations(df, rules)
    valid = marked.where(F.size("violations") == 0).drop("violations")
    return valid, marked.where(F.size("violations") > 0)
