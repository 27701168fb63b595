"""Language-model scoring of whole texts: smoothed word counts and a causal attention model.

Word counts, from which the counts of subword pieces follow, cover every
training document. The attention model learns from every training document
once, in shards whose parameters are averaged, and scores every piece of every
document once.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.llm import attention
from sparktab.llm.common import map_texts, pick, texts_of
from sparktab.session import materialize

#: Public byte-pair ranks; the file's place is a parameter.
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Folds of the documents and the one held out.
FOLDS, HELD_OUT = 5, 1
#: Most words (the most frequent) whose counts and pieces are sent to every task; other counts are joined.
HEAD_WORDS = 200_000
#: Rounds of training, each on its own part of the training documents; bytes of text a shard has on average; rate of learning.
ROUNDS, SHARD_BYTES, RATE = 3, 2 << 20, 0.2
#: Most shards a task learns one after the other, and rows of the model that are averaged together.
TASK_SHARDS, BLOCK = 16, 512
#: The block of the parameters that every window uses.
SHARED = -1
#: Distinct words kept by a task, and bytes of text worked on at once.
KEPT_WORDS, GROUP_BYTES = 400_000, 4 << 20


def held_out(doc_id: Column) -> Column:
    """Whether the checksum of the id as text falls into the held-out fold; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; null is empty."""
    return (text or b"").lower().split()


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Tokenizer:
    """Pieces of one word with the space before it; unpickled from the ranks alone."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.size = ranks, max(ranks.values()) + 1
        core = tiktoken.Encoding("pieces", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
        self.pieces = core._core_bpe.encode_single_piece

    def __reduce__(self):
        return Tokenizer, (self.ranks,)


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` over all documents: every task adds up what it has before rows are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for text in texts_of(batch.column(0)):
                for w in words_of(text):
                    counts[w] = counts.get(w, 0) + 1
                if len(counts) > 2 * KEPT_WORDS:
                    yield out()
        yield out()

    return map_texts(docs.select("text"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def count_pieces(words: DataFrame, tokenizer, size: int) -> np.ndarray:
    """Counts of all pieces of the vocabulary, from the counts of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for w, n in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for p in tokenizer.value.pieces(b" " + w):
                    counts[p] += n
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], names=["piece", "n"])

    out = np.zeros(size, np.int64)
    for row in words.mapInArrow(run, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect():
        out[row["piece"]] = row["n"]  # at most the vocabulary's pieces
    return out


def frequent(words: DataFrame, most: int = HEAD_WORDS) -> dict[bytes, int]:
    """The most frequent words, as many as steps of a quarter power of two allow."""
    step = F.floor(F.log2("n") * 4)
    total, least = 0, None
    for row in sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    if least is None:
        return {}
    got = words.where(step >= least).toArrow()
    return dict(zip(got.column("word").cast(pa.binary()).to_pylist(), got.column("n").to_pylist(), strict=True))


class Known:
    """Words with their pieces, one after the other, and log counts (NaN where there is none)."""

    def __init__(self, tokenizer: Tokenizer, words: list[bytes], counts: dict[bytes, int]):
        self.words = words
        found = [tokenizer.pieces(b" " + w) for w in words]
        self.length = np.fromiter(map(len, found), np.int64, len(words))
        self.buffer = np.fromiter(chain.from_iterable(found), np.int32, int(self.length.sum()))
        n = np.fromiter((counts.get(w, 0) for w in words), float, len(words))
        self.log = np.log10(n + 0.5, where=n > 0, out=np.full(len(words), np.nan))


class Lexicon(dict):
    """Numbers for the words a task meets, with their pieces and their log count where it is at hand.

    Words that are ``known`` beforehand are not cut into pieces again.
    """

    def __init__(self, tokenizer: Tokenizer, counts: dict[bytes, int], known: Known | None = None):
        super().__init__()
        self.tokenizer, self.counts, self.known = tokenizer, counts, known or Known(tokenizer, [], {})
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.update(zip(self.known.words, range(len(self.known.words)), strict=True))
        self.words: list[bytes] = list(self.known.words)
        self.buffer, self.length, self.log = self.known.buffer, self.known.length, self.known.log
        self.offset = np.cumsum(self.length) - self.length

    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self.words)
        self.words.append(word)
        return i

    def _learn(self) -> None:
        """Pieces of the words that are new."""
        new = Known(self.tokenizer, self.words[len(self.length) :], self.counts)
        self.offset = np.concatenate([self.offset, len(self.buffer) + np.cumsum(new.length) - new.length])
        self.buffer, self.length, self.log = (np.concatenate([getattr(self, x), getattr(new, x)]) for x in ("buffer", "length", "log"))

    def read(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers of all texts and words per text; pieces of all texts and pieces per text."""
        if len(self.words) > max(KEPT_WORDS, 2 * len(self.known.words)):
            self.empty()
        parts = [words_of(t) for t in texts]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        numbers = np.fromiter(map(self.__getitem__, chain.from_iterable(parts)), np.int64, int(sizes.sum()))
        self._learn()
        lengths = self.length[numbers]
        before = np.cumsum(lengths) - lengths
        ids = self.buffer[np.repeat(self.offset[numbers] - before, lengths) + np.arange(int(lengths.sum()))]
        ends = np.cumsum(sizes)
        total = np.concatenate([[0], np.cumsum(lengths)])
        return numbers, sizes, ids, total[ends] - total[ends - sizes]


def _groups(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= GROUP_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class Average:
    """Sums of the parameters of several shards, each row weighted by how often the shard used it."""

    def __init__(self, pieces: attention.Pieces):
        n = len(pieces.row)
        self.weight, self.rows = np.zeros(n), np.zeros((n, attention.COLUMNS), np.float32)
        self.places, self.shared = 0.0, 0.0

    def add(self, params: dict[str, np.ndarray], used: np.ndarray) -> None:
        at, places = np.flatnonzero(used), float(used.sum())
        self.weight[at] += used[at]
        self.rows[at] += params["rows"][at] * used[at, None].astype(np.float32)
        self.places, self.shared = self.places + places, self.shared + attention.flat(params) * places

    def batches(self) -> Iterator[pa.RecordBatch]:
        """One record for every block of rows in use, and one for what every window uses."""
        at = np.flatnonzero(self.weight)
        if not len(at):
            return
        yield _sums(SHARED, np.zeros(1, np.int32), np.array([self.places]), np.asarray(self.shared, np.float32))
        for part in np.split(at, np.flatnonzero(np.diff(at // BLOCK)) + 1):
            yield _sums(int(part[0]) // BLOCK, part.astype(np.int32), self.weight[part], self.rows[part])


SUMS = "block int, at binary, weight binary, sums binary"


def _sums(block: int, at: np.ndarray, weight: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([block], pa.int32()), *(pa.array([x.tobytes()]) for x in (at, weight, sums))]
    return pa.RecordBatch.from_arrays(columns, names=["block", "at", "weight", "sums"])


def add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted means of the rows of each block; a task has all records of its blocks, and holds the model's rows at most."""
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for block, *parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            at, weight = np.frombuffer(parts[0], np.int32) % BLOCK, np.frombuffer(parts[1])
            sums = np.frombuffer(parts[2], np.float32).reshape(len(at), -1)
            total = found.setdefault(block, (np.zeros(BLOCK), np.zeros((BLOCK if block != SHARED else 1, sums.shape[1]))))
            total[0][at] += weight
            total[1][at] += sums
    for block, (weight, sums) in found.items():
        at = np.flatnonzero(weight)
        means = (sums[at] / weight[at, None]).astype(np.float32)
        yield _sums(block, (at + max(block, 0) * BLOCK).astype(np.int32), weight[at], means)


def train_model(docs: DataFrame, tokenizer, pieces: attention.Pieces, shards: int, rounds: int = ROUNDS, rate: float = RATE, known: Broadcast | None = None) -> dict[str, np.ndarray]:
    """Parameters after every document (columns id, text) has been learnt once.

    A digest of the id and the text deals documents to rounds and shards. In a
    round every shard starts from the shared parameters and makes one pass over its
    documents, in the order of the digest, so a shard computed again gives the same. A task adds up
    its shards, then tasks are added up by block of rows; a row that no shard
    used stays. The driver gets one mean for each row, however many shards there are.
    The pieces of ``known`` words are at hand in every task.
    """
    spark = docs.sparkSession
    params = attention.initial(pieces)
    digest, each = F.xxhash64("id", "text"), max(1, -(-shards // rounds))
    dealt = docs.select("text", digest.alias("digest"), F.pmod(digest, F.lit(rounds)).alias("round"), F.pmod(F.shiftright(digest, 20), F.lit(each)).alias("shard"))
    tasks = min(each, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-each // TASK_SHARDS)))
    for r in range(rounds):
        start = spark.sparkContext.broadcast((params, pieces))

        def learn(batches: Iterator[pa.RecordBatch], start=start, rate=rate * 0.5**r, seed=r) -> Iterator[pa.RecordBatch]:
            given, arranged = start.value
            average, lexicon, shard, texts = Average(arranged), Lexicon(tokenizer.value, {}, known and known.value), None, []

            def one() -> None:
                if texts:
                    own = {k: v.copy() for k, v in given.items()}
                    _, _, ids, lengths = lexicon.read(texts)
                    _, used = attention.train(own, ids, lengths, arranged, rate, seed=seed)
                    average.add(own, used)
                    texts.clear()

            for batch in batches:
                for next_shard, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                    if next_shard != shard:
                        one()
                    shard = next_shard
                    texts.append(text)
            one()
            yield from average.batches()

        part = dealt.where(F.col("round") == r).repartition(tasks, "shard").sortWithinPartitions("shard", "digest").select("shard", "text")
        means = map_texts(part, learn, SUMS).repartition("block").mapInArrow(add_sums, SUMS).collect()  # at most the model's rows
        params = {k: v.copy() for k, v in params.items()}
        for row in means:
            values = np.frombuffer(row["sums"], np.float32)
            if row["block"] == SHARED:
                params |= attention.unflat(values, params)
            else:
                at = np.frombuffer(row["at"], np.int32)
                params["rows"][at] = values.reshape(len(at), -1)
        params["rows"][:, attention.ONE] = 1  # a mean of ones, without its rounding
        start.destroy()
    return params


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS, head_words: int = HEAD_WORDS) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Documents outside the held-out fold are the training documents. Tokens are
    the words and one end; an empty or null text has the end alone. Repeated
    rows are documents of their own, a null id counts as empty text. Without
    training documents every count is 0. Other columns are not looked at.
    """
    spark: SparkSession = df.sparkSession
    docs = pick(df, id=id_col, text=text_col).withColumn("held_out", held_out(F.col("id")))
    training = docs.where("not held_out")
    words = materialize(count_words(training), "words")
    sizes = training.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n_docs, shards = sizes["n"], max(1, -(-(sizes["bytes"] or 0) // SHARD_BYTES))
    sums = words.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    total, distinct = (sums["n"] or 0) + n_docs, sums["v"] + (n_docs > 0)
    tokenizer = spark.sparkContext.broadcast(Tokenizer(load_ranks(ranks)))
    size = tokenizer.value.size
    pieces = attention.arrange(np.append(count_pieces(words, tokenizer, size), n_docs).astype(float))

    head = frequent(words, head_words)
    sent = spark.sparkContext.broadcast(Known(tokenizer.value, list(head), head))
    params = train_model(training, tokenizer, pieces, shards, known=sent) if n_docs else attention.initial(pieces)
    model = spark.sparkContext.broadcast((params, pieces))

    tail_type = pa.list_(pa.struct([("word", pa.string()), ("tf", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, arranged = model.value
        lexicon = Lexicon(tokenizer.value, {}, sent.value)  # a word that is not known counts with the tail
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            for lo, hi in _groups(texts):
                numbers, sizes, ids, lengths = lexicon.read(texts[lo:hi])
                scores = attention.score(given, ids, lengths, arranged)
                known = ~np.isnan(lexicon.log[numbers])
                ends = np.cumsum(sizes)
                n_head = np.concatenate([[0], np.cumsum(known)])
                s_head = np.concatenate([[0.0], np.cumsum(np.where(known, lexicon.log[numbers], 0.0))])
                doc = np.repeat(np.arange(len(sizes)), sizes)[~known]
                pair, tf = np.unique(doc * (len(lexicon.words) + 1) + numbers[~known], return_counts=True)
                doc, number = pair // (len(lexicon.words) + 1), pair % (len(lexicon.words) + 1)
                offsets = np.searchsorted(doc, np.arange(len(sizes) + 1)).astype(np.int32)
                tail = pa.StructArray.from_arrays([pa.array([lexicon.words[i] for i in number], pa.binary()).cast(pa.string()), pa.array(tf.astype(np.int64))], names=["word", "tf"])
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("held_out"),
                        part.column("row"),
                        pa.array(sizes),
                        pa.array(n_head[ends] - n_head[ends - sizes]),
                        pa.array(s_head[ends] - s_head[ends - sizes]),
                        pa.array(scores),
                        pa.ListArray.from_arrays(pa.array(offsets), tail).cast(tail_type),
                    ],
                    names=["id", "held_out", "row", "n_words", "n_head", "s_head", "score", "tail"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, held_out boolean, row long, n_words long, n_head long, s_head double, score double, tail array<struct<word: string, tf: long>>"
    scored = materialize(map_texts(docs.withColumn("row", F.monotonically_increasing_id()), run, schema), "scored")
    rare = scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.tf")
    rare = rare.join(words, "word").groupBy("row").agg(F.sum("tf").alias("n_rare"), F.sum(F.col("tf") * F.log10(F.col("n") + 0.5)).alias("s_rare"))
    out = scored.drop("tail").join(rare, "row", "left").fillna(0, ["n_rare"]).fillna(0.0, ["s_rare"])
    unknown = F.col("n_words") - F.col("n_head") - F.col("n_rare")
    gathered = F.col("s_head") + F.col("s_rare") + unknown * math.log10(0.5) + math.log10(n_docs + 0.5)
    n_tokens = F.col("n_words") + 1
    return out.select(
        "id",
        "held_out",
        n_tokens.alias("n_tokens"),
        (F.col("n_head") + F.col("n_rare") + int(n_docs > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (gathered - n_tokens * math.log10(total + 0.5 * (distinct + 1))).alias("base_score"),
        "score",
    )
