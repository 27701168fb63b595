"""Imputers, scalers, bins and encoders: fitted by aggregates, applied by one select.

Fitting runs one job per kind of statistic for all columns together. What it
learns is a small mapping of numbers and category lists, ready for JSON.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.functions.values import present, quoted, sql_name
from sparktab.operators.features import Step, apply_steps, build_steps, fit_steps
from sparktab.plans.quantiles import quantiles
from sparktab.plans.running import running_sums
from sparktab.plans.sketches import sketched_quantiles
from sparktab.session import scratch_path

# Defaults of a column without settings of its own, the code of a
# category not seen in fitting, and the gap under which two bin edges are one.
NUMERIC_IMPUTE = "mean"
CATEGORY_IMPUTE = "most_frequent"
DEFAULT_SCALER = "minmax"
DEFAULT_ENCODING = "onehot"
DEFAULT_BINS = 4
UNSEEN_CODE = -1
EDGE_GAP = 1e-8
# The strategies of an imputer by kind, and what "constant" fills in unless told.
STRATEGIES = {"numeric": ("mean", "median", "most_frequent", "constant"), "category": ("most_frequent", "constant")}
CONSTANT_FILL = {"numeric": 0.0, "category": "missing_value"}


class PreprocessError(ValueError):
    """The steps do not fit the table."""


@dataclass
class Branch:
    """What happens to one column."""

    column: str
    kind: str
    impute: str | None = None
    scaler: str | None = None
    bins: int | None = None
    encoding: str | None = None
    fill_value: Any = None

    def constant(self) -> Any:
        """What the strategy ``constant`` puts in."""
        return CONSTANT_FILL[self.kind] if self.fill_value is None else self.fill_value


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; names that are not there are left out."""
    return df.withColumnsRenamed(dict(names))


def select_features(df: DataFrame, id_col: str, features: Sequence[str], target: str | None = None) -> DataFrame:
    """Id, features and target, in this order; the rest is never read."""
    columns = [id_col, *features, *([target] if target else [])]
    require_columns(df, columns)
    return df.select(*map(sql_name, columns))


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """All missing columns are named at once."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise PreprocessError(f"missing columns: {', '.join(missing)}")


def array_to_columns(df: DataFrame, array_col: str, names: Sequence[str]) -> DataFrame:
    """A matrix column as named columns, by position."""
    rest = [sql_name(c) for c in df.columns if c != array_col]
    parts = [f"get({sql_name(array_col)}, {i}) as {sql_name(n)}" for i, n in enumerate(names)]
    return df.selectExpr(*rest, *parts)


def columns_to_array(
    df: DataFrame, columns: Sequence[str], array_col: str, keep: Sequence[str] | None = None
) -> DataFrame:
    """Named columns as one vector column, in the given order, after the columns kept."""
    if keep is None:
        keep = [c for c in df.columns if c not in set(columns)]
    values = ", ".join(f"cast({sql_name(c)} as double)" for c in columns)
    return df.selectExpr(*map(sql_name, keep), f"array({values}) as {sql_name(array_col)}")


def modes(df: DataFrame, values: Mapping[str, Column]) -> dict[str, Any]:
    """The most frequent present value per column, ties to the smallest.

    All columns must be of one type. Values are counted on the map side first.
    """
    if not values:
        return {}
    pairs = [F.struct(F.lit(name).alias("name"), v.alias("value")) for name, v in values.items()]
    counts = (
        df.select(F.inline(F.array(*pairs)))
        .where("value is not null")
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("name").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
    return {r["name"]: r["value"] for r in best.collect()}


def value_counts(df: DataFrame, values: Mapping[str, Column]) -> dict[str, list[tuple[Any, int]]]:
    """Distinct values and their counts per column, sorted, a missing value last.

    All columns must be of one type. For columns whose values become output
    columns, which bounds what reaches the driver by the width of the result.
    """
    if not values:
        return {}
    pairs = [F.struct(F.lit(name).alias("name"), v.alias("value")) for name, v in values.items()]
    counts = df.select(F.inline(F.array(*pairs))).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    found: dict[str, list[tuple[Any, int]]] = {name: [] for name in values}
    for row in counts.collect():
        found[row["name"]].append((row["value"], row["n"]))
    for items in found.values():
        items.sort(key=lambda item: (item[0] is None, item[0] if item[0] is not None else 0))
    return found


def code_table(df: DataFrame, value: Column) -> dict[str, Any]:
    """Codes of the categories as a table in the shared folder, and whether one is missing.

    ``save_params`` takes the table along.
    """
    known = df.select(value.alias("_category")).distinct()
    missing = not known.where("_category is null").isEmpty()
    ranked = running_sums(known.dropna().withColumn("n", F.lit(1)), "_category", ["n"])
    codes = ranked.select("_category", (F.col("run_n") - 1).cast("double").alias("_code"))
    path = scratch_path(df.sparkSession, "codes")
    codes.write.parquet(path)
    return {"table": path, "missing": missing}


def _top(items: Sequence[tuple[Any, int]]) -> Any:
    """The most frequent present value of a sorted count list, ties to the smallest."""
    known = [item for item in items if item[0] is not None]
    return max(known, key=lambda item: item[1])[0] if known else None


def _common_type(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Columns by type, so that columns of one type share a job."""
    groups: dict[str, list[str]] = {}
    for c in columns:
        groups.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    return groups


def drop_close_edges(edges: Sequence[float]) -> list[float]:
    """Edges without those that repeat the one before."""
    kept: list[float] = []
    for at, edge in enumerate(edges):
        if at == 0 or edge - edges[at - 1] > EDGE_GAP:
            kept.append(edge)
    return kept


def _known(value: Any, column: str) -> Any:
    if value is None:
        raise PreprocessError(f"{column} has no values to impute from")
    return value


def _with_filled(n: int, mean: float, var: float, missing: int, fill: float | None) -> tuple[float, float]:
    """Mean and population variance after ``missing`` rows were set to ``fill``."""
    if not missing or fill is None:
        return mean, var
    total = n + missing
    moved = (n * mean + missing * fill) / total
    spread = n * (var + (mean - moved) ** 2) + missing * (fill - moved) ** 2
    return moved, spread / total


@dataclass
class Preprocessor:
    """Feature steps, rename, then one branch per column; other columns are dropped."""

    branches: Sequence[Branch]
    passthrough: Sequence[str] = ()
    rename: Mapping[str, str] = field(default_factory=dict)
    steps: Sequence[tuple[str, Step]] = ()
    step_settings: Mapping[str, Any] | None = None
    #: Size of the sketches medians and bin edges come from; exact without.
    quantile_sketch: int | None = None

    def _quantiles(self, df: DataFrame, values: dict[str, Column], shares: Sequence[float]) -> dict[str, list[float] | None]:
        if self.quantile_sketch is None:
            return quantiles(df, values, shares)
        return sketched_quantiles(df, values, shares, self.quantile_sketch)

    def _input(self, df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
        return rename_columns(apply_steps(df, self.steps, params["steps"]), self.rename)

    def _filled(self, df: DataFrame, branch: Branch, params: Mapping[str, Any]) -> Column:
        value = present(df, branch.column)
        if branch.kind == "numeric":
            value = value.cast("double")
        if branch.impute is None:
            return value
        return F.coalesce(value, F.lit(params["impute"][branch.column]))

    def _scaled(self, df: DataFrame, branch: Branch, params: Mapping[str, Any]) -> Column:
        value = self._filled(df, branch, params)
        if branch.scaler is None:
            return value
        scale = params["scale"][branch.column]
        # A column that was constant in fitting is only shifted: the divisor 0 becomes 1.
        if branch.scaler == "minmax":
            return (value - scale["min"]) / ((scale["max"] - scale["min"]) or 1.0)
        return (value - scale["mean"]) / (scale["std"] or 1.0)

    def fit(self, df: DataFrame) -> dict[str, Any]:
        """Learn everything: one aggregate for all numbers, one count for all categories.

        Medians, modes of plain columns and bin edges add a job each where asked for.
        """
        params: dict[str, Any] = {"steps": fit_steps(df, self.steps)}
        params.update({"impute": {}, "scale": {}, "edges": {}, "categories": {}})
        df = self._input(df, params)
        require_columns(df, [*[b.column for b in self.branches], *self.passthrough])
        for b in self.branches:
            if b.impute and b.impute not in STRATEGIES[b.kind]:
                raise PreprocessError(f"{b.column}: unknown imputer strategy {b.impute!r} for a {b.kind} column")
        numeric = [b for b in self.branches if b.kind == "numeric"]
        self._fit_numeric(df, numeric, params)
        binned = [b for b in numeric if b.bins]
        for bins in sorted({b.bins for b in binned}):
            values = {b.column: self._scaled(df, b, params) for b in binned if b.bins == bins}
            edges = self._quantiles(df, values, [i / bins for i in range(bins + 1)])
            params["edges"].update({c: drop_close_edges(e) for c, e in edges.items()})
        self._fit_categories(df, params)
        return params

    def _fit_numeric(self, df: DataFrame, numeric: Sequence[Branch], params: dict) -> None:
        value = {b.column: present(df, b.column).cast("double") for b in numeric}
        fill = {}
        medians = {b.column: value[b.column] for b in numeric if b.impute == "median"}
        if medians:
            found = self._quantiles(df, medians, [0.5])
            fill.update({c: q[0] if q else None for c, q in found.items()})
        fill.update(modes(df, {b.column: value[b.column] for b in numeric if b.impute == "most_frequent"}))
        fill.update({b.column: float(b.constant()) for b in numeric if b.impute == "constant"})
        summed = [b for b in numeric if b.impute == "mean" or b.scaler]
        stats = [F.count(F.lit(1)).alias("n")]
        for i, b in enumerate(summed):
            v = value[b.column]
            parts = {"n": F.count(v), "mean": F.avg(v), "var": F.var_pop(v), "min": F.min(v), "max": F.max(v)}
            stats += [part.alias(f"{name}{i}") for name, part in parts.items()]
        row = df.agg(*stats).first() if summed else None
        for i, b in enumerate(summed):
            missing = row["n"] - row[f"n{i}"] if b.impute else 0
            put_in = fill.get(b.column) if b.impute == "constant" and missing else None
            if row[f"n{i}"] == 0 and put_in is None:
                raise PreprocessError(f"{b.column} has no values to learn from")
            ends = [v for v in (row[f"min{i}"], row[f"max{i}"], put_in) if v is not None]
            low, high = min(ends), max(ends)
            mean = min(max(row[f"mean{i}"], low), high) if row[f"n{i}"] else put_in
            if b.impute == "mean":
                fill[b.column] = mean
            if b.scaler == "minmax":
                params["scale"][b.column] = {"min": low, "max": high}
            elif b.scaler == "standard":
                constant = low == high and (not missing or fill.get(b.column) == low)
                var = 0.0 if constant else row[f"var{i}"] or 0.0
                mean, var = _with_filled(row[f"n{i}"], mean, var, 0 if constant else missing, fill.get(b.column))
                params["scale"][b.column] = {"mean": mean, "std": math.sqrt(var)}
            elif b.scaler:
                raise PreprocessError(f"unknown scaler {b.scaler!r}")
        for b in numeric:
            if b.impute:
                params["impute"][b.column] = _known(fill.get(b.column), b.column)

    def _fit_categories(self, df: DataFrame, params: dict) -> None:
        branches = {b.column: b for b in self.branches if b.kind == "category"}
        for names in _common_type(df, list(branches)).values():
            wide = {c: present(df, c) for c in names if branches[c].encoding == "onehot"}
            counts = value_counts(df, wide)
            others = [c for c in names if c not in wide and branches[c].impute == "most_frequent"]
            fill = modes(df, {c: present(df, c) for c in others})
            for c in names:
                if branches[c].impute == "constant":
                    fill[c] = branches[c].constant()
                elif branches[c].impute and c in counts:
                    fill[c] = _top(counts[c])
                if branches[c].impute:
                    params["impute"][c] = _known(fill.get(c), c)
            for c, items in counts.items():
                known = {v for v, _ in items}
                if branches[c].impute and None in known:
                    known = (known - {None}) | {fill[c]}
                params["categories"][c] = sorted(known, key=lambda v: (v is None, v if v is not None else 0))
            for c in names:
                if branches[c].encoding == "ordinal":
                    value = present(df, c)
                    value = F.coalesce(value, F.lit(fill[c])) if branches[c].impute else value
                    params["categories"][c] = code_table(df, value)

    def _branch_output(self, df: DataFrame, branch: Branch, params: Mapping[str, Any]) -> list[Column]:
        if branch.kind == "numeric":
            value = self._scaled(df, branch, params)
            if not branch.bins:
                return [value.alias(branch.column)]
            inner = params["edges"][branch.column][1:-1]
            place = sum([(value >= e).cast("int") for e in inner], F.lit(0))
            return [
                (place == i).cast("double").alias(name)
                for i, name in enumerate(self.branch_names(branch, params))
            ]
        value = self._filled(df, branch, params)
        if branch.encoding != "onehot":
            return [value.alias(branch.column)]
        return [
            F.coalesce((value == F.lit(c)) if c is not None else value.isNull(), F.lit(False))
            .cast("double")
            .alias(name)
            for c, name in zip(params["categories"][branch.column], self.branch_names(branch, params), strict=True)
        ]

    def branch_names(self, branch: Branch, params: Mapping[str, Any]) -> list[str]:
        if branch.bins:
            n_bins = max(1, len(params["edges"][branch.column]) - 1)
            return [f"{branch.column}_{float(i)}" for i in range(n_bins)]
        if branch.encoding == "onehot":
            items = params["categories"][branch.column]
            return [f"{branch.column}_{'nan' if c is None else c}" for c in items]
        return [branch.column]

    def output_names(self, params: Mapping[str, Any]) -> list[str]:
        """Names of the transformed features, in order; needs no job."""
        names = [n for b in self.branches for n in self.branch_names(b, params)]
        return [*names, *self.passthrough]

    def transform(self, df: DataFrame, params: Mapping[str, Any], keep: Sequence[str] = ()) -> DataFrame:
        """The ``keep`` columns (id, target, split), then the features."""
        ready = self._input(df, params)
        require_columns(ready, [*[b.column for b in self.branches], *self.passthrough, *keep])
        columns = [sql_name(c) for c in keep]
        for branch in self.branches:
            columns += self._branch_output(ready, branch, params)
        columns += [sql_name(c) for c in self.passthrough]
        out = ready.select(*columns)
        for branch in self.branches:
            if branch.encoding == "ordinal":
                out = _ordinal_codes(out, branch.column, params["categories"][branch.column])
        return out


def _ordinal_codes(df: DataFrame, name: str, codes: Mapping[str, Any]) -> DataFrame:
    """Codes by position in the sorted categories; a seen missing value stays missing."""
    table = df.sparkSession.read.schema(f"_category {df.schema[name].dataType.simpleString()}, _code double").parquet(codes["table"])
    joined = df.join(table, quoted(name) == F.col("_category"), "left")
    unseen = F.lit(float(UNSEEN_CODE))
    if codes["missing"]:
        unseen = F.when(quoted(name).isNotNull(), unseen)
    code = F.coalesce(F.col("_code"), unseen).alias(name)
    return joined.select(*[code if c == name else quoted(c) for c in df.columns])


def branch_from_settings(column: str, kind: str, settings: Mapping[str, Any]) -> Branch:
    default = NUMERIC_IMPUTE if kind == "numeric" else CATEGORY_IMPUTE
    impute = settings.get("imputer_strategy", default) if settings.get("impute", True) else None
    fill = settings.get("fill_value")
    if kind == "numeric":
        scaler = settings.get("scaler", DEFAULT_SCALER)
        bins = settings.get("n_buckets", DEFAULT_BINS) if settings.get("bucketize", False) else None
        scaler = scaler if scaler in ("minmax", "standard") else None
        return Branch(column, kind, impute=impute, scaler=scaler, bins=bins, fill_value=fill)
    encoding = settings.get("encoding", DEFAULT_ENCODING)
    encoding = encoding if encoding in ("onehot", "ordinal") else None
    return Branch(column, kind, impute=impute, encoding=encoding, fill_value=fill)


def build_preprocessor(config: Mapping[str, Any]) -> Preprocessor:
    """From ``preprocessing``, ``features`` and ``raw_features`` settings.

    Feature steps come first, in a fixed order, then the rename, then the
    branches: continuous, categorical, and the raw features left over.
    """
    settings, features = config.get("preprocessing", {}), config.get("features", {})
    asked = {
        "risk_score": settings.get("risk_score", False),
        "bmi": settings.get("weight_col") and settings.get("height_col"),
        "interactions": settings.get("interaction_columns"),
        "outlier_flags": settings.get("outlier_columns"),
        "datetime_feats": settings.get("datetime_column"),
    }
    names = [name for name, wanted in asked.items() if wanted]
    filled = {"icd10_chapter_flags": [], **settings}
    continuous, categorical = features.get("continuous", []), features.get("categorical", [])
    branches = [branch_from_settings(c, "numeric", settings.get(c, {})) for c in continuous]
    branches += [branch_from_settings(c, "category", settings.get(c, {})) for c in categorical]
    rename = settings.get("rename_columns", {})
    raw = [rename.get(c, c) for c in config.get("raw_features", [])]
    return Preprocessor(
        branches=branches,
        passthrough=[c for c in raw if c not in {*continuous, *categorical}],
        rename=rename,
        steps=build_steps(names, filled),
        step_settings={"names": names, "settings": filled},
        quantile_sketch=settings.get("quantile_sketch"),
    )


def fit_transform(df: DataFrame, config: Mapping[str, Any], keep: Sequence[str] = ()) -> DataFrame:
    """Fit on the table and apply to the same table."""
    plan = build_preprocessor(config)
    return plan.transform(df, plan.fit(df), keep)


def save_params(spark: SparkSession, params: Mapping[str, Any], path: str) -> None:
    """Fitted parameters as one JSON text, and the code tables beside it."""
    categories = dict(params["categories"])
    for i, (name, found) in enumerate(sorted(categories.items())):
        if isinstance(found, Mapping):
            spark.read.parquet(found["table"]).write.mode("overwrite").parquet(f"{path}/codes/{i}")
            categories[name] = {**found, "table": f"codes/{i}"}
    write_text(spark, json.dumps({**params, "categories": categories}), f"{path}/params")


def load_params(spark: SparkSession, path: str) -> dict[str, Any]:
    params = json.loads(read_text(spark, f"{path}/params"))
    for found in params["categories"].values():
        if isinstance(found, dict):
            found["table"] = f"{path}/{found['table']}"
    return params


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One small text as a file of its own."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path).first().value


def definition(plan: Preprocessor) -> dict[str, Any]:
    """A preprocessor as plain values; feature steps must come from settings."""
    if plan.steps and plan.step_settings is None:
        raise PreprocessError("feature steps without settings cannot be stored")
    return {
        "branches": [asdict(b) for b in plan.branches],
        "passthrough": list(plan.passthrough),
        "rename": dict(plan.rename),
        "step_settings": plan.step_settings,
        "quantile_sketch": plan.quantile_sketch,
    }


def from_definition(saved: Mapping[str, Any]) -> Preprocessor:
    asked = saved["step_settings"]
    return Preprocessor(
        branches=[Branch(**b) for b in saved["branches"]],
        passthrough=saved["passthrough"],
        rename=saved["rename"],
        steps=build_steps(asked["names"], asked["settings"]) if asked else (),
        step_settings=asked,
        quantile_sketch=saved.get("quantile_sketch"),
    )
