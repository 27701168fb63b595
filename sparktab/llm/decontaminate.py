"""Benchmark decontamination by spaced seeds.

Fixed masks keep some token positions and ignore the others. Hashes of the kept
tokens of test passages meet those of the documents; around each hit the passage
is laid over the document and compared token by token, so substituted words do
not hide an overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import append, fresh, pick

#: Kept (1) and ignored (0) positions. One substitution in nine words leaves some mask whole at some place.
MASKS = ("11111111", "1101011011", "10110010111", "110001110011")
#: Least equal words and least share of equal words in an overlap; a passage shorter than the first must be there in full.
LEAST_WORDS, LEAST_SHARE = 12, 0.8
#: The least share in fifths.
WHOLE_SHARE = round(LEAST_SHARE * 5)
#: Words of test passages that one pass over the documents holds as an index.
BLOCK_WORDS = 2_000_000
TABLE_BITS = 20
_MIX = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64) | 1 for i in range(16)], np.uint64)
WORDS = re.compile(r"\w+")


def words_of(text: bytes | None) -> list[str]:
    return WORDS.findall((text or b"").decode().lower())


class SeedIndex:
    """Test passages as word numbers, and a sorted table of (seed hash, place) for each mask."""

    def __init__(self, items: list[tuple[int, list[str]]], masks: tuple[str, ...] = MASKS):
        self.numbers: dict[str, int] = {}
        self.masks = [np.flatnonzero(np.frombuffer(m.encode(), np.uint8) == 49) for m in masks]
        self.spans = [len(m) for m in masks]
        words, self.ids, self.starts = [], [i for i, _ in items], [0]
        for _, w in items:
            words += [self.numbers.setdefault(x, len(self.numbers) + 1) for x in w]
            self.starts.append(len(words))
        self.tokens = np.array(words, np.int32)
        self.shortest = min((len(w) for _, w in items), default=0)
        self.tables = []
        owner = np.repeat(np.arange(len(items)), np.diff(self.starts)) if items else np.zeros(0, int)
        for kept, span in zip(self.masks, self.spans, strict=True):
            at = np.arange(max(0, len(words) - span + 1))
            at = at[owner[at] == owner[at + span - 1]] if len(at) else at
            hashes = self.seeds(self.tokens, at, kept)
            order = np.argsort(hashes, kind="stable")
            there = np.zeros(1 << TABLE_BITS, bool)
            there[hashes >> np.uint64(64 - TABLE_BITS)] = True
            self.tables.append((hashes[order], at[order], there))
        self.owner = owner
        self.tiny = [k for k in range(len(items)) if 0 < self.starts[k + 1] - self.starts[k] < min(self.spans)]

    @staticmethod
    def seeds(tokens: np.ndarray, at: np.ndarray, kept: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for j, offset in enumerate(kept):
            out += tokens[at + offset].astype(np.uint64) * _MIX[j]
        return out ^ (out << np.uint64(29)) ^ (out >> np.uint64(17))

    def matches(self, words: list[str]) -> list[tuple[int, int, int, int]]:
        """(passage, first word, end word, equal words) of each passage's best overlap with the document."""
        n, get = len(words), self.numbers.get
        doc = np.array([get(w, 0) for w in words], np.int32)
        known = doc > 0
        found: dict[int, tuple[int, int, int]] = {}
        laid: set[tuple[int, int]] = set()
        for (hashes, places, there), kept, span in zip(self.tables, self.masks, self.spans, strict=True):
            if n < span or not len(hashes):
                continue
            ok = known[: n - span + 1].copy()
            for offset in kept[1:]:
                ok &= known[offset : offset + n - span + 1]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            seeds = self.seeds(doc, at, kept)
            near = there[seeds >> np.uint64(64 - TABLE_BITS)]
            at, seeds = at[near], seeds[near]
            left = np.searchsorted(hashes, seeds, side="left")
            right = np.searchsorted(hashes, seeds, side="right")
            for i in np.flatnonzero(left < right):
                for place in places[left[i] : right[i]]:
                    k = int(self.owner[place])
                    shift = int(at[i]) - int(place - self.starts[k])
                    if (k, shift) not in laid:
                        laid.add((k, shift))
                        self._lay(doc, k, shift, found)
        for k in self.tiny:
            item = self.tokens[self.starts[k] : self.starts[k + 1]]
            for i in np.flatnonzero(doc == item[0]):
                if np.array_equal(doc[i : i + len(item)], item):
                    found.setdefault(k, (len(item), -int(i), int(i) + len(item)))
        return [(self.ids[k], -s, e, equal) for k, (equal, s, e) in sorted(found.items())]

    def _lay(self, doc: np.ndarray, k: int, shift: int, found: dict) -> None:
        """Compare a passage with the document at one shift and keep the stretch with the most equal words of those with the least share."""
        item = self.tokens[self.starts[k] : self.starts[k + 1]]
        lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
        same = item[lo:hi] == doc[lo + shift : hi + shift]
        # A stretch has enough equal words if the sum does not fall over it; times 5, sums are whole numbers.
        gain = np.concatenate([[0], np.cumsum(np.where(same, 5 - WHOLE_SHARE, -WHOLE_SHARE))])
        total = np.concatenate([[0], np.cumsum(same)])
        lowest = np.minimum.accumulate(gain)
        # For each end the first start that is not higher holds the most words, and so the most equal ones.
        begin = len(gain) - np.searchsorted(lowest[::-1], gain, side="right")
        equals = total - total[begin]
        end = int(equals.argmax())
        start, equal = int(begin[end]), int(equals[end])
        while start < end and not same[start]:
            start += 1
        while end > start and not same[end - 1]:
            end -= 1
        if equal and equal >= min(LEAST_WORDS, len(item)):
            first = lo + start + shift
            found[k] = max(found.get(k, (0, 0, 0)), (equal, -first, lo + end + shift))


def passages(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[int, list[str]]]]:
    """Test passages with words, in blocks of bounded size read one after the other; one row per id (null too) and text."""
    block, size = [], 0
    for row in pick(benchmark, id=id_col, text=text_col).where("text is not null").distinct().orderBy("id").toLocalIterator():
        words = words_of(row["text"].encode())
        if words:
            block.append((row["id"], words))
            size += len(words)
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def _probe(df: DataFrame, text_col: str, column: str, items: list) -> DataFrame:
    index = df.sparkSession.sparkContext.broadcast(SeedIndex(items))

    def scan(text: bytes | None) -> tuple:
        hits = index.value.matches(words_of(text))
        return (";".join(f"{'' if k is None else k}:{s}:{e}:{n}" for k, s, e, n in hits),)

    return append(df, text_col, scan, {column: "string"})


def overlaps(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS, column: str = "overlaps") -> DataFrame:
    """The table with its overlaps as text: ``item:first:end:equal`` joined by semicolons, in words from 0.

    Every row stays; null and empty texts and an empty benchmark give empty
    text. A passage without id is matched like any other and has an empty id; a
    column of the table that bears the new name keeps it, the new one gets
    underscores. Words are runs of letters and digits in lower case. The index of one
    block of test passages is broadcast, its size bounded by ``block_words``; a
    larger benchmark takes a pass over the batch for each block.
    """
    out, made, column = df, [], fresh(df, column)
    for i, items in enumerate(passages(benchmark, item_id, item_text, block_words)):
        made.append(fresh(out, f"{column}_block{i}"))
        out = _probe(out, text_col, made[-1], items)
    whole = F.concat_ws(";", *[F.when(F.col(c) != "", F.col(c)) for c in made]) if made else F.lit("")
    return out.withColumn(column, whole).drop(*made)


def decontaminate(df: DataFrame, benchmark: DataFrame, text_col: str = "text", **kwargs) -> DataFrame:
    """The rows without an overlap, all columns as they were."""
    column = fresh(df, "overlaps")
    found = overlaps(df, benchmark, text_col, column=column, **kwargs)
    return found.where(F.col(column) == "").select(*df.columns)
