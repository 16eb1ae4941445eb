"""Documents that hold passages of benchmark items, by word n-grams.

The n-grams of all items go to every task as a hash set, in blocks of a bounded number of n-grams;
each block is one more pass over the texts, written before the next one, so a task holds one block
however many there are and nothing is shuffled. A text's words are looked up in the block's vocabulary; where enough known words
follow each other, their n-gram hash is looked up, and a hit is confirmed on the words themselves.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import as_batch, discard, slices, staged

SIZE = 10

_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")
_STEP = 0x9E3779B97F4A7C15

_FOUND = "n_words long, spans array<struct<first:int,last:int>>, items array<string>"
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def words_of(text: str) -> list[bytes]:
    """Lower-cased runs of letters, digits and characters beyond ASCII, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def item_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """item_id (as text, empty for null) and each distinct window: ``size`` words, or all of fewer."""

    def cut(batches):
        for batch in slices(batches):
            ids, windows = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text or "")
                n = min(size, len(words))
                for start in range(len(words) - n + 1 if n else 0):
                    ids.append(item)
                    windows.append(b" ".join(words[start : start + n]))
            yield as_batch(["item_id", "words"], [pa.array(ids, pa.string()), pa.array(windows, pa.binary())])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    return items.mapInArrow(cut, "item_id string, words binary").distinct()


class _Block:
    """The n-grams of a block: vocabulary, hashes by length, items by n-gram."""

    def __init__(self, rows: list[tuple[str, bytes]]):
        self.items: dict[bytes, list[str]] = {}
        for item, window in rows:
            self.items.setdefault(window, []).append(item)
        self.vocabulary: dict[bytes, int] = {}
        by_size: dict[int, list[list[int]]] = {}
        for window in self.items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in window.split(b" ")]
            by_size.setdefault(len(ids), []).append(ids)
        self.hashes = {
            n: np.unique(_windows(np.array(ids, np.uint64).reshape(-1), np.arange(len(ids)) * n, n))
            for n, ids in by_size.items()
        }

    def hits(self, texts: list[list[bytes]]) -> list[list[tuple[int, int, bytes]]]:
        """For each text (first word, last word, n-gram) of every n-gram in it."""
        lengths = np.array([len(t) + 1 for t in texts])
        begin = np.cumsum(lengths) - lengths
        flat = list(itertools.chain.from_iterable(itertools.chain(t, (b"",)) for t in texts))
        known = np.fromiter(map(self.vocabulary.get, flat, itertools.repeat(0)), np.uint64, len(flat))
        unknown = np.concatenate([[0], np.cumsum(known == 0)])
        found: list[list[tuple[int, int, bytes]]] = [[] for _ in texts]
        for n, hashes in self.hashes.items():
            if len(known) < n:
                continue
            starts = np.flatnonzero(unknown[n:] == unknown[:-n])
            value = _windows(known, starts, n)
            place = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
            for start in starts[hashes[place] == value].tolist():
                window = b" ".join(flat[start : start + n])
                if window in self.items:
                    text = int(np.searchsorted(begin, start, "right")) - 1
                    first = start - int(begin[text])
                    found[text].append((first, first + n - 1, window))
        return found


def _windows(ids: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    value = np.zeros(len(starts), np.uint64)
    for step in range(n):
        mixed = (ids[starts + step] + np.uint64(1)) * np.uint64(_STEP)
        value = (value ^ (mixed ^ (mixed >> np.uint64(29)))) * np.uint64(0xBF58476D1CE4E5B9)
    return value


def _merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[dict[str, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], last)
        else:
            out.append({"first": first, "last": last})
    return out


def scanned(
    docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block_windows: int = 500_000
) -> DataFrame:
    """``doc`` (the row as it came), n_words, spans of hit words (first and last) and item ids.

    Null and empty texts have no words; an item that occurs in several rows counts once; an empty
    table on either side gives no hits. At most about ``block_windows`` n-grams are sent at once.
    """
    found = docs.select(
        F.struct("*").alias("doc"),
        F.lit(None).cast("long").alias("n_words"),
        F.array().cast("array<struct<first:int,last:int>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    windows = item_windows(benchmark, size).persist()
    try:
        blocks = max(1, -(-windows.count() // block_windows))
        share = F.pmod(F.xxhash64("words"), F.lit(blocks))
        for k in range(blocks):
            rows = windows.filter(share == k).collect()
            earlier, found = found, _pass(found, [(r.item_id, bytes(r.words)) for r in rows])
            if k < blocks - 1:
                found = staged(found, "scanned")
            if hasattr(earlier, "_staged_at") and k < blocks - 1:
                discard(earlier)
    finally:
        windows.unpersist()
    return found


def _pass(found: DataFrame, rows: list[tuple[str, bytes]]) -> DataFrame:
    shared = found.sparkSession.sparkContext.broadcast(rows)

    def scan(batches):
        block = _Block(shared.value)
        for batch in slices(batches):
            docs = batch.column(0)
            texts = [words_of(t or "") for t in docs.field("text").to_pylist()]
            spans, items = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i, hits in enumerate(block.hits(texts)):
                if hits:
                    named = itertools.chain.from_iterable(block.items[w] for _, _, w in hits)
                    earlier = [(s["first"], s["last"]) for s in spans[i]]
                    spans[i] = _merged(earlier + [(a, b) for a, b, _ in hits])
                    items[i] = sorted({*items[i], *named})
            counts = pa.array([len(t) for t in texts], pa.int64())
            yield as_batch(
                ["doc", "n_words", "spans", "items"],
                [docs, counts, pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))],
            )

    return found.mapInArrow(scan, found.schema)


def hit_words() -> Column:
    """Number of words in the spans of a scanned row."""
    return F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + F.lit(1)
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, spans: bool = False) -> DataFrame:
    """The documents without hits, in the columns they came with.

    With ``spans`` documents stay and lose the stretch of text from the first to the last word of
    each span.
    """
    found = scanned(docs, benchmark)
    if not spans:
        return found.filter(F.size("spans") == 0).select("doc.*")
    names = docs.columns

    def cut(batches):
        for batch in slices(batches):
            rows, hits = batch.column(0), batch.column(1).to_pylist()
            texts = rows.field("text").to_pylist()
            cleaned = [without(t, h) if h else t for t, h in zip(texts, hits)]
            columns = [rows.field(i) for i in range(len(names))]
            columns[names.index("text")] = pa.array(cleaned, pa.string())
            yield as_batch(names, columns)

    return found.select("doc", "spans").mapInArrow(cut, docs.schema)


def without(text: str, spans: list[dict[str, int]]) -> str:
    """The text without the stretches of its words that the spans name."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(raw.translate(_FOLD))]
    out, at = [], 0
    for span in spans:
        out.append(raw[at : places[span["first"]][0]])
        at = places[span["last"]][1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")
