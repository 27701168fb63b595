"""Secret scans: credential values judged by the cost of guessing them."""

from __future__ import annotations

import hashlib
import json
import math
import re
from bisect import bisect_right
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparktab.llm.common import append, fresh

#: Ranked words for the segmentation; any vocabulary file with word ends works.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: Decimal logarithm of the guesses from which a value counts as a secret.
LEAST_GUESSES = 8.0
LONGEST_WORD = 24
KINDS = ("assign", "access", "hex", "guess")

ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
HEX = re.compile(rb"[0-9a-f]{32,}")
CONTEXT = re.compile(
    rb"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth|(?:api|access|private|secret)[_-]?key)"
    rb"[\"']?\x20*(?:[:=]|=>)\x20*[\"']?([^\s\"'<>,;]{6,})"
    rb"|bearer\x20+([^\s\"'<>,;]{6,})|://[^\s/:@]+:([^\s/@]{6,})@",
    re.I,
)
DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d")
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")


def _neighbours() -> dict[str, set[str]]:
    """Keys beside, above and below, each row shifted half a key to the right."""
    out: dict[str, set[str]] = {}
    for y, row in enumerate(ROWS):
        for x, c in enumerate(row):
            around = [(x - 1, y), (x + 1, y), (x, y - 1), (x + 1, y - 1), (x, y + 1), (x - 1, y + 1)]
            out[c] = {ROWS[j][i] for i, j in around if 0 <= j < len(ROWS) and 0 <= i < len(ROWS[j])}
    return out


KEYS = _neighbours()


def load_words(path: str = VOCABULARY) -> dict[str, int]:
    """Whole words of three letters or more with their place in the vocabulary."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    return {w[:-4]: n + 1 for w, n in vocabulary.items() if w.endswith("</w>") and len(w) >= 7 and w[:-4].isalpha()}


def _runs(value: str) -> list[tuple[int, int, float, float]]:
    """Stretches of repeats and walks as (start, end, cost at the start, cost per character)."""
    n, low, out = len(value), value.lower(), []
    for period in (1, 2, 3, 4):
        start = 0
        for i in range(period, n + 1):
            if i < n and low[i] == low[i - period]:
                continue
            if i - start >= max(3, 2 * period):
                out.append((start, i, float(period) + 0.3, 0.0))
            start = i - period + 1
    for step in ("up", "down", "keys"):
        start = 0
        for i in range(1, n + 1):
            if i < n:
                a, b = low[i - 1], low[i]
                near = b in KEYS.get(a, ()) if step == "keys" else ord(b) - ord(a) == (1 if step == "up" else -1)
                if near and b.isalnum():
                    continue
            if i - start >= 4 if step == "keys" else i - start >= 3:
                out.append((start, i, 1.7, 0.35) if step == "keys" else (start, i, 1.4, 0.0))
            start = i
    return out


def guess_cost(value: str, words: dict[str, int]) -> float:
    """Decimal logarithm of the guesses of the cheapest segmentation of the whole value.

    Segments are vocabulary words, dates, repeats, keyboard walks and sequences,
    and brute-force characters at ten guesses each; each further segment doubles
    the guesses. A run may be entered anywhere up to its end, or left anywhere
    from its start, so the work is linear in the length.
    """
    n, low = len(value), value.lower()
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]  # by end: (start, cost)
    for s, e, base, each in _runs(value):
        for i in range(s, e - 2):
            ends[e].append((i, base + each * (e - i) + math.log10(e - i)))
        for j in range(s + 3, e):
            ends[j].append((s, base + each * (j - s) + math.log10(j - s)))
    for i in range(n):
        if value[i].isdigit() and (m := DATE.match(value, i)):
            ends[m.end()].append((i, 2.1 if m.end() - i == 4 else 4.2))
    best, total, brute = [0.0] * (n + 1), 0.3, [True] * (n + 1)
    for j in range(1, n + 1):
        cost, hard = best[j - 1] + 1.0 + (0.0 if brute[j - 1] else total), True
        for i, c in ends[j]:
            if (x := best[i] + c + (total if i else 0.0)) < cost:
                cost, hard = x, False
        for i in range(max(0, j - LONGEST_WORD), j - 2):
            if rank := words.get(low[i:j]):
                part = value[i:j]
                upper = sum(map(str.isupper, part))
                case = 0.0 if not upper else 0.3 if upper == len(part) or part[1:].islower() else math.log10(2.0) * min(upper, len(part) - upper)
                if (x := best[i] + math.log10(rank + 1) + case + (total if i else 0.0)) < cost:
                    cost, hard = x, False
        best[j], brute[j] = cost, hard
    return best[n]


def find_secrets(text: bytes | None, words: dict[str, int], least: float = LEAST_GUESSES) -> tuple[list[tuple[str, int, int]], float | None]:
    """Spans (kind, start, end) in code points, by start and kind, and the highest guess cost (None without a value).

    ``assign``, ``access`` and ``hex`` are the fixed patterns; ``guess`` marks a
    value in a credential context whose guesses reach the threshold. Null is empty.
    """
    text = text or b""
    spans: list[tuple[int, int, int]] = []
    most = None
    if b":" in text or b"=" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if b":" in text or b"=" in text or b"earer " in text or b"EARER " in text:
        for m in CONTEXT.finditer(text):
            cost = guess_cost(m[m.lastindex].decode("utf-8", "replace"), words)
            most = cost if most is None else max(most, cost)
            if cost >= least:
                spans.append((m.start(m.lastindex), 3, m.end(m.lastindex)))
    if not spans:
        return [], most
    if not text.isascii():
        starts = [i for i, b in enumerate(text) if b & 0xC0 != 0x80]
        spans = [(bisect_right(starts, s) - 1, k, bisect_right(starts, e - 1)) for s, k, e in spans]
    return [(KINDS[k], s, e) for s, k, e in sorted(spans)], most


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _words(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(load_words(path))  # at most the vocabulary file's entries


def secret_spans(df: DataFrame, text_col: str = "text", least: float = LEAST_GUESSES, vocabulary: str = VOCABULARY) -> DataFrame:
    """The table with counts, digest, spans and the highest guess cost of each whole text.

    Every row stays; null and empty texts have no spans. Other columns pass
    through (they must not bear the names of the new ones).
    """
    words = _words(df.sparkSession, vocabulary)

    def scan(text: bytes | None) -> tuple:
        spans, most = find_secrets(text, words.value, least)
        base = [s for s in spans if s[0] != "guess"]
        kinds = [k for k, _, _ in spans]
        return (*map(kinds.count, KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), most)

    fields = {"n_assign": "long", "n_access": "long", "n_hex": "long", "n_guess": "long", "base_sha256": "string", "spans": "string", "log10_guesses": "double"}
    return append(df, text_col, scan, fields)


def masked(text: bytes | None, find: Callable, mark: str = "[secret]") -> str | None:
    """The text with overlapping spans merged and each replaced by the mark; null stays null."""
    if text is None:
        return None
    spans = sorted((s, e) for _, s, e in find(text))
    value, out, at = text.decode(), [], 0
    for s, e in spans:
        if s >= at:
            out += [value[at:s], mark]
        at = max(at, e)
    return "".join([*out, value[at:]])


def mask_secrets(df: DataFrame, text_col: str = "text", least: float = LEAST_GUESSES, vocabulary: str = VOCABULARY) -> DataFrame:
    """The table with every secret span in the text replaced by a mark; all rows and columns stay.

    Documents without a secret keep their text as it is, null and empty included.
    """
    words = _words(df.sparkSession, vocabulary)
    new = fresh(df, "masked")
    out = append(df, text_col, lambda t: (masked(t, lambda x: find_secrets(x, words.value, least)[0]),), {new: "string"})
    return out.select(*[out[new].alias(text_col) if c == text_col else out[c] for c in df.columns])
