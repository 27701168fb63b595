"""License scans with a positional index of rare words.

Templates are word sequences with mandatory key phrases. The documents say how
rare each template word is; each template is looked up by its rarest words. A
file's places of those words, less their places in a template, give the start
the template would have there; where enough rare words agree on a start, the key
phrases and the share of template words in order are checked.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm import license_texts as texts
from sparktab.llm.common import append, map_texts, pick, texts_of

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Words (the rarest) a template is looked up by, words a start may drift by edits, least share of words in order.
RARE, DRIFT, LEAST_SHARE = 4, 3, 0.75
#: Words of a template that allow one more word of drift.
DRIFT_WORDS = 24


@dataclass(frozen=True)
class Template:
    """A text with its label; key phrases must all occur in an aligned place; base templates match word for word."""

    label: str
    text: str
    phrases: tuple[str, ...] = ()
    base: bool = False


# The base phrases and their labels, and public license notices.
BASE = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
)
NOTICES = (
    Template("mit-notice", "Released under the MIT License", ("mit license",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "2 0")),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    Template("gpl-2.0", "This program is licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    Template("lgpl", "licensed under the GNU Lesser General Public License", ("lesser general public license",)),
    Template("agpl", "licensed under the GNU Affero General Public License", ("affero general public license",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc", "4 0")),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa", "4 0")),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution",)),
    Template("cc0", "released under Creative Commons Zero CC0 1.0", ("cc0",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use",)),
    Template("bsd", "Released under the BSD License", ("bsd license",)),
    Template("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("public domain",)),
    Template("proprietary", "All rights reserved", ("all rights reserved",)),
)
WHOLE = (
    Template("mit-file", texts.MIT, ("free of charge", "to deal in the software without restriction", "without warranty of any kind")),
    Template("bsd-3-clause", texts.BSD_3, ("redistribution and use", "this list of conditions", "neither the name", "endorse or promote products")),
    Template("isc-file", texts.ISC, ("with or without fee", "disclaims all warranties")),
    Template("zlib", texts.ZLIB, ("must not be misrepresented", "altered source versions")),
    Template("apache-2.0-notice", texts.APACHE_2_NOTICE, ("apache license", "2 0", "required by applicable law")),
    Template("gpl-3.0-notice", texts.GPL_3_NOTICE, ("general public license", "version 3", "any later version")),
    Template("mpl-2.0-notice", texts.MPL_2_NOTICE, ("mozilla public license", "with this file")),
)
TEMPLATES = BASE + NOTICES + WHOLE


def words_of(text: bytes | None) -> list[bytes]:
    return WORDS.findall((text or b"").lower())


def document_counts(df: DataFrame, text_col: str, words: set[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many documents each of the given words occurs, and how many documents there are.

    Every task counts its documents; a row per word and task is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        n = 0
        for batch in batches:
            for text in texts_of(batch.column(0)):
                n += 1
                for w in words.intersection(words_of(text)):
                    counts[w] = counts.get(w, 0) + 1
        out = [(b"", n), *counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w, _ in out]), pa.array([c for _, c in out], pa.int64())], names=["word", "n"])

    rows = map_texts(pick(df, text=text_col), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r["word"].encode(): r["n"] for r in rows}
    return counts, counts.pop(b"", 0)


class Index:
    """Postings of the rarest words of every template."""

    def __init__(self, templates: tuple[Template, ...], counts: dict[bytes, int], documents: int):
        self.templates = templates
        self.words = [words_of(t.text.encode()) for t in templates]
        self.phrases = [[words_of(p.encode()) for p in t.phrases] for t in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.votes = []
        for k, words in enumerate(self.words):
            rare = sorted(range(len(words)), key=lambda i, w=words: (-math.log((documents + 1) / (counts.get(w[i], 0) + 1)), i))
            rare = rare if templates[k].base else rare[:RARE]
            self.votes.append(len(rare) if templates[k].base else min(2, len(rare)))
            for i in rare:
                self.postings.setdefault(words[i], []).append((k, i))

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and (template, first word, share of its words found in order) of every match."""
        words = words_of(text)
        looked = self.postings.keys() & set(words)
        if not looked:
            return len(words), []
        starts: dict[int, dict[int, set[int]]] = {}
        for at, w in enumerate(words):
            if w in looked:
                for k, i in self.postings[w]:
                    starts.setdefault(k, {}).setdefault(at - i, set()).add(i)
        out = []
        for k, by in starts.items():
            drift = self._drift(k)
            last = None
            for start in sorted(by):
                agree = reduce(set.union, (by.get(start + d, set()) for d in range(drift + 1)))
                if len(agree) < self.votes[k]:
                    continue
                at = max(0, start)
                share = self._verify(words, k, at)
                if share and (last is None or at > last or not drift):
                    out.append((k, at, share))
                    last = at + len(self.words[k]) - 1
        return len(words), sorted(out, key=lambda m: (m[1], m[0]))

    def _drift(self, k: int) -> int:
        return 0 if self.templates[k].base else max(DRIFT, len(self.words[k]) // DRIFT_WORDS)

    def _verify(self, words: list[bytes], k: int, at: int) -> float:
        want = self.words[k]
        if self.templates[k].base:
            return float(words[at : at + len(want)] == want)
        drift = self._drift(k)
        window = words[max(0, at - drift) : at + len(want) + 2 * drift]
        for phrase in self.phrases[k]:
            if not any(window[i : i + len(phrase)] == phrase for i in range(len(window) - len(phrase) + 1)):
                return 0.0
        row = [0] * (len(window) + 1)  # longest common subsequence
        for w in want:
            left = 0
            for j, v in enumerate(window, 1):
                row[j], left = (left + 1 if v == w else max(row[j], row[j - 1])), row[j]
        share = row[-1] / len(want)
        return share if share >= LEAST_SHARE else 0.0


def license_scan(df: DataFrame, text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """The table with word count, base matches, labels, best share and all matches of each whole text.

    ``matches`` has ``label:first word:share`` for every match. A null or empty
    text has no words and no labels. All documents count for the rarity of
    words; the index holds the templates alone, so it is small for any corpus.
    Where the table has a column of a new name, the new one gets underscores.
    """
    vocabulary = {w for t in templates for w in words_of(t.text.encode())}
    index = Index(templates, *document_counts(df, text_col, vocabulary))

    def scan(text: bytes | None) -> tuple:
        n, found = index.scan(text)
        base = [(index.templates[k].label, at, at + len(index.words[k]) - 1) for k, at, _ in found if index.templates[k].base]
        starts = [at for _, at, _ in base]
        return (
            n,
            len(base),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted({x[0] for x in base})),
            ",".join(sorted({index.templates[k].label for k, _, _ in found})),
            max((share for _, _, share in found), default=0.0),
            ";".join(f"{index.templates[k].label}:{at}:{share:.4f}" for k, at, share in found),
        )

    fields = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "string", "labels": "string", "score": "double", "matches": "string"}
    return append(df, text_col, scan, fields)
