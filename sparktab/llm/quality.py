"""Quality rules: a decision list learned from labelled statistics, applied as ordered Spark conditions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import append, fresh, pick

#: Labelled documents (expected number) the list is learned from.
LABELLED = 20_000
#: Most rules, most conditions per rule, least share of right rejections.
MOST_RULES, MOST_CONDITIONS, PRECISION = 24, 4, 0.95

SPACE = b" \t\n\x0b\x0c\r"
NOT_WORD_CHARS = SPACE + bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
UPPER, DIGITS = bytes(range(65, 91)), bytes(range(48, 58))

COUNTS = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "n_lines": "long",
    "n_distinct": "long",
    "n_upper": "long",
    "n_digits": "long",
}


def repeat_words(ids: np.ndarray, width: int = 8) -> int:
    """Words that lie in a window found twice or more; width is a power of two.

    Windows get exact numbers by doubling: equal numbers of two halves make
    equal wholes.
    """
    n = len(ids)
    if n <= width:
        return 0
    ranks, span = ids, 1
    while span < width:
        ranks = np.unique(ranks[:-span] * n + ranks[span:], return_inverse=True)[1]
        span *= 2
        if span < width and len(ranks) and ranks.max() + 1 == len(ranks):
            return 0
    at = np.flatnonzero(np.bincount(ranks)[ranks] > 1)
    edge = np.zeros(n + 1, np.int64)
    edge[at] += 1
    edge[at + width] -= 1
    return int((np.cumsum(edge) > 0).sum())


def text_counts(text: bytes | None) -> tuple:
    """The values of COUNTS for one whole text; null counts as empty."""
    text = text or b""
    words = text.split()
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    seen: set[bytes] = set()
    lines = repeated = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            repeated += line in seen
            seen.add(line)
    size = len(text)
    return (
        len(words),
        len(text.translate(None, NOT_WORD_CHARS)),
        size - len(text.translate(None, SYMBOLS)),
        repeated,
        repeat_words(ids),
        lines,
        len(numbers),
        size - len(text.translate(None, UPPER)),
        size - len(text.translate(None, DIGITS)),
    )


def statistics(names: dict[str, str]) -> dict[str, Column]:
    """The statistics rules may use, from the count columns (0 where the divisor is 0)."""

    def share(a: str, b: str) -> Column:
        return F.when(F.col(names[b]) > 0, F.col(names[a]) / F.col(names[b])).otherwise(F.lit(0.0))

    return {
        "words": F.col(names["n_words"]).cast("double"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
        "word_length": share("word_chars", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, '<=' or '>', threshold) that rejects."""

    conditions: tuple[tuple[str, str, float], ...]

    def __str__(self) -> str:
        return " and ".join(f"{s} {op} {t:.6g}" for s, op, t in self.conditions)

    def column(self, stats: dict[str, Column]) -> Column:
        out = F.lit(True)
        for s, op, t in self.conditions:
            out = out & (stats[s] <= t if op == "<=" else stats[s] > t)
        return out

    def covers(self, names: list[str], x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for s, op, t in self.conditions:
            v = x[:, names.index(s)]
            out &= v <= t if op == "<=" else v > t
        return out


def _grow(names: list[str], x: np.ndarray, bad: np.ndarray) -> Rule:
    """Add the condition of the highest information gain until no good row is covered.

    Cuts lie in the middle between values; of equal gains the widest gap wins,
    which keeps away from both sides.
    """
    conditions: tuple = ()
    inside = np.ones(len(x), bool)
    while len(conditions) < MOST_CONDITIONS and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best = (0.0, None)
        for i, name in enumerate(names):
            v = x[inside, i]
            values = np.unique(v)
            if len(values) < 2:
                continue
            cuts, gaps = (values[1:] + values[:-1]) / 2, values[1:] - values[:-1]
            at = np.searchsorted(cuts, v, side="left")
            p = np.cumsum(np.bincount(at[bad[inside]], minlength=len(cuts) + 1))[:-1]
            n = np.cumsum(np.bincount(at[~bad[inside]], minlength=len(cuts) + 1))[:-1]
            for op, pos, neg in (("<=", p, n), (">", p0 - p, n0 - n)):
                gain = np.where(pos > 0, pos * (np.log2(np.maximum(pos, 1) / np.maximum(pos + neg, 1)) - np.log2(p0 / (p0 + n0))), 0)
                good = np.flatnonzero(gain >= gain.max() - 1e-9)
                k = int(good[gaps[good].argmax()])
                if gain[k] > best[0] + 1e-9:
                    best = (float(gain[k]), (name, op, float(cuts[k])))
        if best[1] is None:
            break
        conditions = (*conditions, best[1])
        inside = Rule(conditions).covers(names, x)
    return Rule(conditions)


def _prune(rule: Rule, names: list[str], x: np.ndarray, bad: np.ndarray) -> Rule:
    """Drop final conditions while that does not lower (p - n) / (p + n) on held-back rows."""

    def worth(conditions: tuple) -> float:
        c = Rule(conditions).covers(names, x)
        p, n = (c & bad).sum(), (c & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    keep = rule.conditions
    while len(keep) > 1 and worth(keep[:-1]) >= worth(keep):
        keep = keep[:-1]
    return Rule(keep)


def learn_rules(names: list[str], x: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """Sequential covering: grow on two thirds, prune on the rest, drop what is covered, go on.

    A rule counts only if, on all rows not yet covered, at least PRECISION of
    what it rejects is labelled low. Without both labels there is no rule.
    """
    rules: list[Rule] = []
    x, bad = np.asarray(x, float).reshape(len(bad), len(names)), np.asarray(bad, bool)
    held = np.arange(len(x)) % 3 == 2
    while len(rules) < MOST_RULES and (bad & ~held).any() and (~bad).any():
        rule = _grow(names, x[~held], bad[~held])
        if not rule.conditions:
            break
        if (bad & held).any():
            rule = _prune(rule, names, x[held], bad[held])
        covered = rule.covers(names, x)
        if not (covered & bad).any() or (covered & bad).sum() < PRECISION * covered.sum():
            break
        rules.append(rule)
        x, bad, held = x[~covered], bad[~covered], held[~covered]
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", labelled: int = LABELLED) -> list[Rule]:
    """Learn the list from at most about ``labelled`` documents with a label (0 is low, else good).

    The sample is by hash of the id, so it is the same for any layout. Null ids
    and labels are left out; of several labels of a document the least counts,
    of several rows of one id any one. Only the sampled documents are read by
    Python, and one row of numbers each comes to the driver.
    """
    marks = pick(labels, id=id_col, mark=label_col).dropna().groupBy("id").agg(F.min("mark").alias("mark"))
    n = marks.count()
    if not n:
        return []
    share = min(1.0, labelled / n)
    marks = marks.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sampled = pick(docs, id=id_col, text=text_col).join(F.broadcast(marks), "id")
    counted = append(sampled, "text", text_counts, COUNTS).drop("text").dropDuplicates(["id"])
    stats = statistics({k: k for k in COUNTS})
    rows = counted.select("id", "mark", *[c.alias(k) for k, c in stats.items()]).collect()
    rows.sort(key=lambda r: r[0])
    return learn_rules(list(stats), np.array([r[2:] for r in rows], float), np.array([r[1] == 0 for r in rows], bool))


def quality(df: DataFrame, rules: list[Rule], text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """The table with counts, base verdict, deciding rule and verdict; and the names of the new columns.

    The list is one ordered condition: the first rule that fits rejects, no rule
    keeps. Null text counts as no words. Clashing names get an underscore.
    """
    names = {k: fresh(df, k) for k in COUNTS}
    out = append(df, text_col, text_counts, {names[k]: v for k, v in COUNTS.items()})
    words, repeat = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    names |= {k: fresh(df, k) for k in ("base_failed", "rule", "kept")}
    failed = (words < 20) | (100 * repeat > 30 * words)
    stats, rule = statistics(names), F.lit(None).cast("string")
    for r in reversed(rules):
        rule = F.when(r.column(stats), F.lit(str(r))).otherwise(rule)
    out = out.withColumn(names["base_failed"], failed).withColumn(names["rule"], rule)
    return out.withColumn(names["kept"], ~F.col(names["base_failed"]) & F.col(names["rule"]).isNull()), names
