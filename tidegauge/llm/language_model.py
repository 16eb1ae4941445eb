"""Log probabilities of texts under a log-bilinear model trained with noise-contrastive estimation.

Words are counted over all training documents. The most frequent WORDS words are classes of their
own; all other words share BUCKETS classes by their last two bytes, and within a bucket a word has
its smoothed share of the bucket's count, one share being left for words never seen. The neural part
predicts the class from the two classes before it: a context is the sum of two class vectors, each
scaled per dimension, and a class is scored by a product with the context plus a bias.

Training goes over all training documents in ROUNDS rounds. In each, every task runs stochastic
gradient steps from the common parameters over its part, against noise drawn from the class counts,
and the parameters are averaged by tokens in a shuffle keyed by class. Scores are normalised: the sum
over all classes is computed by matrix products once per context and kept per worker process.

Word counts of the FREQUENT most frequent words go to every task; other words meet their counts in a
join, one row per document and word.
"""

from __future__ import annotations

import itertools
import math
import uuid
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import as_batch, leading, slices, staged, text_of

WORDS, BUCKETS = 767, 255
FREQUENT = 1 << 18
DIMENSIONS = 24
ROUNDS = 3
NOISE = 32
BATCH, RATE = 1024, 0.3

# Classes: the start of a text (context only), its end, the words, the buckets.
START, END = 0, 1
CLASSES = 2 + WORDS + BUCKETS

_PREPARED = (
    "doc_id long, train boolean, n_tokens long, n_known long, log_counts double, log_shares double, "
    "log_bucket double, classes binary, rare array<binary>, times array<int>"
)


def _bucket(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % BUCKETS


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_counts(docs: DataFrame, most: int = 400_000) -> DataFrame:
    """word and n over all rows; the end of a text counts as the empty word.

    A task adds up its words and passes the sums on whenever it holds ``most`` of them.
    """

    def sums(batches):
        seen: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                seen.update(_words(text))
            seen[b""] += batch.num_rows
            if len(seen) > most:
                yield from _count_batches(seen)
                seen = Counter()
        yield from _count_batches(seen)

    summed = docs.select(text_of().alias("text")).mapInArrow(sums, "word binary, n long")
    return summed.groupBy("word").agg(F.sum("n").alias("n"))


def _count_batches(seen: Counter, rows: int = 50_000):
    items = iter(seen.items())
    while part := list(itertools.islice(items, rows)):
        words, counts = zip(*part)
        yield as_batch(["word", "n"], [pa.array(words, pa.binary()), pa.array(counts, pa.int64())])


@dataclass
class Vocabulary:
    """Totals, the frequent words with their counts, and the size of each bucket."""

    tokens: int
    types: int
    words: list[bytes]
    counts: np.ndarray
    buckets: np.ndarray

    @property
    def log_total(self) -> float:
        """log10 of the base model's denominator."""
        return math.log10(self.tokens + self.types + 1)

    def class_counts(self) -> np.ndarray:
        """Training tokens per class, at least one each; the start is never predicted."""
        found = np.ones(CLASSES)
        for word, n in zip(self.words[: WORDS + 1], self.counts[: WORDS + 1].tolist()):
            found[self.class_of(word)] = n + 1
        found[2 + WORDS :] = self.buckets
        found[START] = 0
        return found

    def ranks(self) -> dict[bytes, int]:
        return {word: k for k, word in enumerate(self.words)}

    def class_of(self, word: bytes) -> int:
        """For words at the head of the list; the empty word, the end, comes first."""
        return END if word == b"" else 1 + self.words.index(word, 0, WORDS + 1)

    def classes(self) -> np.ndarray:
        """Class of each frequent word."""
        own = np.arange(1, min(len(self.words), WORDS + 1) + 1)
        shared = [2 + WORDS + _bucket(w) for w in self.words[WORDS + 1 :]]
        return np.concatenate([own, np.array(shared, np.int64)]).astype(np.uint16)


def vocabulary(counts: DataFrame, frequent: int = FREQUENT) -> Vocabulary:
    """From the counts of all training words."""
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = leading(counts, frequent).collect()
    rows = sorted(((bytes(r.word), r.n) for r in top), key=lambda r: (r[0] != b"", -r[1], r[0]))
    if not rows or rows[0][0] != b"":
        # Fewer texts than the bound lets through: the end still has its class.
        ends = counts.filter(F.length("word") == 0).first()
        rows.insert(0, (b"", ends.n if ends else 0))
    bucket = F.crc32(F.substring("word", -2, 2)) % BUCKETS
    sizes = counts.filter(F.length("word") > 0).groupBy(bucket.alias("b"))
    buckets = np.ones(BUCKETS)
    for row in sizes.agg(F.sum(F.col("n") + 1).alias("n")).collect():
        buckets[row.b] += row.n
    for word, n in rows[1 : WORDS + 1]:
        buckets[_bucket(word)] -= n + 1
    words, numbers = [w for w, _ in rows], np.array([n for _, n in rows], np.int64)
    return Vocabulary(tokens, types, words, numbers, buckets)


_VOCABULARIES: dict = {}


def _looked_up(version: str, shared):
    """Tables for one vocabulary, built once per worker process."""
    if version not in _VOCABULARIES:
        _VOCABULARIES.clear()
        vocabulary: Vocabulary = shared.value
        _VOCABULARIES[version] = (
            vocabulary.ranks(),
            vocabulary.classes().astype(np.int64),
            np.log10(vocabulary.counts + 1.0),
            np.log10(vocabulary.buckets),
        )
    return _VOCABULARIES[version]


def prepared(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Classes of every text, sums over its frequent words, and its other words with their numbers.

    ``docs`` has doc_id, text and train. ``log_counts`` sums log10(c + 1) of frequent words and the
    end, ``log_shares`` the part of it that words in buckets have, and ``log_bucket`` log10 of the
    buckets' sizes over all words in buckets.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    version = uuid.uuid4().hex
    ends = int(vocabulary.counts[0])

    def prepare(batches):
        ranks, class_of, logs, log_size = _looked_up(version, shared)
        for batch in slices(batches, 256):
            texts = [_words(t) for t in batch.column(1).to_pylist()]
            lengths = np.array([len(t) for t in texts], np.int64)
            flat = list(itertools.chain.from_iterable(texts))
            rank = np.fromiter(map(ranks.get, flat, itertools.repeat(-1)), np.int64, len(flat))
            rare = np.flatnonzero(rank < 0)
            classes = class_of[np.maximum(rank, 0)]
            classes[rare] = [2 + WORDS + _bucket(flat[k]) for k in rare.tolist()]
            log_count = np.where(rank < 0, 0.0, logs[np.maximum(rank, 0)])
            in_bucket = classes >= 2 + WORDS
            size = np.where(in_bucket, log_size[np.maximum(classes - 2 - WORDS, 0)], 0.0)
            edges = np.concatenate([[0], np.cumsum(lengths)])

            def per_text(values, edges=edges):
                total = np.concatenate([[0.0], np.cumsum(values)])
                return total[edges[1:]] - total[edges[:-1]]

            packed, others, times = [], [], []
            packed_classes = classes.astype("<u2")
            for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
                packed.append(packed_classes[begin:end].tobytes())
                left, right = np.searchsorted(rare, (begin, end))
                found = Counter(flat[k] for k in rare[left:right].tolist())
                others.append(list(found))
                times.append(list(found.values()))
            known = lengths - per_text((rank < 0).astype(np.float64)).astype(np.int64) + (ends > 0)
            columns = [
                batch.column(0),
                batch.column(2),
                pa.array(lengths + 1),
                pa.array(known),
                pa.array(per_text(log_count) + math.log10(ends + 1)),
                pa.array(per_text(np.where(in_bucket, log_count, 0.0))),
                pa.array(per_text(size)),
                pa.array(packed, pa.binary()),
                pa.array(others, pa.list_(pa.binary())),
                pa.array(times, pa.list_(pa.int32())),
            ]
            names = [part.split()[0] for part in _PREPARED.split(", ")]
            yield as_batch(names, columns)

    wanted = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"), "train")
    return wanted.mapInArrow(prepare, _PREPARED)


class LogBilinear:
    """``inner`` and ``outer`` vectors and ``bias`` per class; ``near`` and ``far`` scale contexts.

    All parameters are one matrix with a row per class and a last row for the two scales.
    """

    def __init__(self, table: np.ndarray):
        self.table = table
        d = DIMENSIONS
        self.inner, self.outer, self.bias = table[:-1, :d], table[:-1, d : 2 * d], table[:-1, 2 * d]
        self.near, self.far = table[-1:, :d], table[-1:, d : 2 * d]

    @staticmethod
    def initial(noise: np.ndarray, seed: int = 7) -> LogBilinear:
        table = np.zeros((CLASSES + 1, 2 * DIMENSIONS + 1), np.float32)
        drawn = np.random.default_rng(seed).normal(0, 0.3, (CLASSES, DIMENSIONS))
        table[:-1, :DIMENSIONS] = drawn
        table[:-1, 2 * DIMENSIONS] = np.log(np.maximum(noise, 1e-12))
        table[-1, : 2 * DIMENSIONS] = 0.7
        return LogBilinear(table)

    def contexts(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.near * self.inner[last] + self.far * self.inner[before]

    def log_sums(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Log of the sum over all classes (but the start) for each context."""
        scores = self.contexts(before, last) @ self.outer[1:].T + self.bias[1:]
        top = scores.max(axis=1, keepdims=True)
        return np.log(np.exp(scores - top).sum(axis=1)) + top[:, 0]


def _windows(classes: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Class two before, class before and class of every token with the ends, and tokens per text."""
    rows, sizes = [], []
    for packed in classes:
        ids = np.frombuffer(packed, "<u2")
        rows += [np.array([START, START], np.int64), ids, np.array([END], np.int64)]
        sizes.append(len(ids) + 1)
    flat, counts = np.concatenate(rows).astype(np.int64), np.array(sizes)
    owner = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(owner)) + 2 * (owner + 1)
    return flat[at - 2], flat[at - 1], flat[at], counts


def _added(rows: np.ndarray, values: np.ndarray, into: np.ndarray) -> None:
    """into[rows] += values, with repeated rows."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    into[ordered[first]] += np.add.reduceat(values[order], first, axis=0)


class _Trainer:
    """Adagrad steps on the contrast between data and NOISE shared noise classes a batch."""

    def __init__(self, table: np.ndarray, noise: np.ndarray, seed: int, rate: float = RATE):
        self.model = LogBilinear(table.copy())
        self.noise, self.rate = noise, rate
        self.log_noise = np.log(np.maximum(NOISE * noise, 1e-12)).astype(np.float32)
        self.dealt = np.random.default_rng(seed)
        self.squares = np.full_like(table, 1e-2)
        self.cumulative = np.cumsum(noise)

    def step(self, before: np.ndarray, last: np.ndarray, word: np.ndarray) -> None:
        m, d = self.model, DIMENSIONS
        drawn = np.searchsorted(self.cumulative, self.dealt.random(NOISE) * self.cumulative[-1])
        drawn = np.minimum(drawn, CLASSES - 1)
        context = m.contexts(before, last)
        own = (context * m.outer[word]).sum(axis=1) + m.bias[word] - self.log_noise[word]
        other = context @ m.outer[drawn].T + m.bias[drawn] - self.log_noise[drawn]
        up = 1 / (1 + np.exp(np.clip(own, -30, 30)))
        down = -1 / (1 + np.exp(-np.clip(other, -30, 30)))
        toward = up[:, None] * m.outer[word] + down @ m.outer[drawn]
        slope = np.zeros_like(m.table)
        values = np.concatenate([up[:, None] * context, up[:, None]], axis=1)
        _added(word, values, slope[:, d:])
        _added(drawn, np.concatenate([down.T @ context, down.sum(axis=0)[:, None]], axis=1), slope[:, d:])
        _added(last, m.near * toward, slope[:, :d])
        _added(before, m.far * toward, slope[:, :d])
        slope[-1, :d] = (toward * m.inner[last]).sum(axis=0)
        slope[-1, d : 2 * d] = (toward * m.inner[before]).sum(axis=0)
        slope /= len(word)
        self.squares += slope**2
        m.table += self.rate * slope / np.sqrt(self.squares)


def trained(rows: DataFrame, noise: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The parameters after ``rounds`` rounds over the prepared training rows, a share in each."""
    spark = rows.sparkSession
    table = LogBilinear.initial(noise).table
    width = table.shape[1]
    share = F.pmod(F.xxhash64("doc_id", "classes"), F.lit(rounds))
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((table, noise))

        def learn(batches, shared=shared, turn=turn):
            start, noise = shared.value
            seed = 1_000_003 * turn + TaskContext.get().partitionId()
            trainer, tokens = _Trainer(start, noise, seed), 0
            for batch in slices(batches, 1024):
                before, last, word, _ = _windows(batch.column(0).to_pylist())
                order = trainer.dealt.permutation(len(word))
                tokens += len(word)
                for begin in range(0, len(word), BATCH):
                    part = order[begin : begin + BATCH]
                    trainer.step(before[part], last[part], word[part])
            if tokens:
                moved = (trainer.model.table.astype(np.float64) - start) * tokens
                cells = pa.array(list(moved), pa.list_(pa.float64()))
                numbers = pa.array(np.arange(len(moved)), pa.int32())
                weight = pa.array(np.full(len(moved), tokens), pa.int64())
                yield as_batch(["row", "tokens", "moved"], [numbers, weight, cells])

        part = rows.filter(F.col("train") & (share == turn)).select("classes")
        moves = part.mapInArrow(learn, "row int, tokens long, moved array<double>")
        sums = [F.sum(F.col("moved")[k]).alias(f"m{k}") for k in range(width)]
        for row in moves.groupBy("row").agg(F.sum("tokens").alias("tokens"), *sums).collect():
            table[row.row] += np.array(row[2:], np.float64) / row.tokens
    return table


_SUMS: dict = {}


def _normaliser(version: str, table: np.ndarray) -> tuple[LogBilinear, np.ndarray]:
    """The model and the log sums found so far, kept per worker process."""
    if version not in _SUMS:
        _SUMS.clear()
        _SUMS[version] = (LogBilinear(table), np.full(CLASSES * CLASSES, np.nan, np.float32))
    return _SUMS[version]


def _log_probabilities(model: LogBilinear, sums: np.ndarray, before, last, word) -> np.ndarray:
    key = before * CLASSES + last
    wanted = np.unique(key)
    missing = wanted[np.isnan(sums[wanted])]
    for begin in range(0, len(missing), BATCH):
        part = missing[begin : begin + BATCH]
        sums[part] = model.log_sums(part // CLASSES, part % CLASSES)
    own = np.empty(len(word))
    for begin in range(0, len(word), 64 * BATCH):
        s = slice(begin, begin + 64 * BATCH)
        context = model.contexts(before[s], last[s])
        own[s] = np.einsum("ij,ij->i", context, model.outer[word[s]]) + model.bias[word[s]]
    return own - sums[key]


def scored(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score and score for every row of ``docs``.

    ``docs`` has doc_id, text and train, which marks the rows to learn from. Null texts are empty:
    one end token. Repeated rows are learnt from and scored one by one. With no rows to learn from,
    all words are unknown and all classes start out equal.
    """
    docs = docs.select("doc_id", "text", F.coalesce("train", F.lit(False)).alias("train"))
    counts = staged(word_counts(docs.filter("train")), "word-counts")
    found = vocabulary(counts, frequent)
    numbered = prepared(docs, found).withColumn("row_id", F.monotonically_increasing_id())
    rows = staged(numbered, "prepared")
    noise = found.class_counts()
    noise = noise / noise.sum()
    table = trained(rows, noise)

    rare = rows.select("row_id", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    rare = rare.select("row_id", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    met = rare.join(counts, "word", "left")
    sums = met.groupBy("row_id").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("rare_logs"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("rare_known"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(table)
    version = uuid.uuid4().hex

    def score(batches):
        model, sums = _normaliser(version, shared.value)
        for batch in slices(batches, 256):
            before, last, word, counts = _windows(batch.column(1).to_pylist())
            logs = _log_probabilities(model, sums, before, last, word)
            total = np.add.reduceat(logs, np.cumsum(counts) - counts) / math.log(10)
            yield as_batch(["row_id", "class_score"], [batch.column(0), pa.array(total)])

    neural = rows.select("row_id", "classes").mapInArrow(score, "row_id long, class_score double")
    plain = rows.drop("classes", "rare", "times").join(sums, "row_id", "left").join(neural, "row_id")
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    return plain.select(
        "doc_id",
        "train",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(found.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + rare_logs - F.col("n_tokens") * F.lit(found.log_total)).alias("base_score"),
        (F.col("class_score") + F.col("log_shares") + rare_logs - F.col("log_bucket")).alias("score"),
    )
