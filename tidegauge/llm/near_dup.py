"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A document is the set of its distinct shingles of SHINGLE words. Shingles fall on a circle of CIRCLE
places through one permutation; a second permutation, shifted by k places, gives signature coordinate
k, so two permutations make the whole signature. With BANDS bands of ROWS coordinates a pair at
similarity 0.85 shares no band with probability (1 - 0.85**5)**24 < 1e-6.

Equal sets collapse to one class first. In each bucket every class is compared with the bucket's
centre (the class that shares most bands with others). Classes that share a bucket but are still in
different components are then compared wherever they share a rare shingle that any similar pair must
share, so no pair that shares a band goes untested unless it is connected already or cannot be
similar. All comparisons are exact, on the full sets.
"""

from __future__ import annotations

import functools
import hashlib
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import as_batch, bounded, discard, slices, staged, text_of
from tidegauge.llm.components import components

SHINGLE = 5
BANDS, ROWS = 24, 5
CIRCLE = 1 << 20

_SIGNED = "doc_id long, n_shingles long, set_key binary, bands array<long>"
_SETS = "doc_id long, shingles array<long>, parity array<long>"

# Longs of a set's parity sketch.
PARITY = 16


class _WordHashes(dict):
    """64-bit hashes of words, for as many words as fit a bounded cache."""

    limit = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def shingle_sets(texts: list[str], hashes: dict | None = None, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; all words as one if there are fewer."""
    hashes = _WordHashes() if hashes is None else hashes
    words = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter(
        map(hashes.__getitem__, itertools.chain.from_iterable(words)), np.uint64, int(lengths.sum())
    )
    factors = _mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    rolled = np.zeros(max(len(flat) - size + 1, 0), np.uint64)
    for step in range(size):
        rolled += flat[step : step + len(rolled)] * factors[step]
    rolled = _mixed(rolled)
    sets, at = [], 0
    for n in lengths.tolist():
        if n >= size:
            sets.append(np.unique(rolled[at : at + n - size + 1]))
        else:
            short = (flat[at : at + n] * factors[:n]).sum(dtype=np.uint64) + np.uint64(n)
            sets.append(_mixed(np.array([short][: min(n, 1)], np.uint64)))
        at += n
    return sets


class Circulant:
    """Signatures from two permutations of the circle."""

    def __init__(self, coordinates: int = BANDS * ROWS, circle: int = CIRCLE, seed: int = 1):
        dealt = np.random.default_rng(seed)
        self.scatter = dealt.permutation(circle).astype(np.int64)
        order = dealt.permutation(circle).astype(np.uint32)
        ring = np.concatenate([order, order[: coordinates - 1]])
        self.shifted = np.lib.stride_tricks.sliding_window_view(ring, coordinates)
        self.circle, self.coordinates = np.uint64(circle), coordinates

    def signature(self, shingles: np.ndarray, at_once: int = 4096) -> np.ndarray:
        places = self.scatter[(shingles % self.circle).astype(np.int64)]
        lowest = np.full(self.coordinates, np.iinfo(np.uint32).max, np.uint32)
        for start in range(0, len(places), at_once):
            np.minimum(lowest, self.shifted[places[start : start + at_once]].min(axis=0), out=lowest)
        return lowest


@functools.cache
def _process_tables() -> tuple[_WordHashes, Circulant]:
    """Built once per worker process."""
    return _WordHashes(), Circulant()


def _bands(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = signature.reshape(bands, -1).astype(np.uint64)
    value = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows.shape[1]):
        value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return value.astype(np.int64)


def _set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _parity(shingles: np.ndarray) -> np.ndarray:
    """Bits that each say whether an odd number of shingles falls on them.

    A shingle that only one of two sets holds changes one bit, so two sketches differ in at most as
    many bits as there are such shingles.
    """
    place = (shingles >> np.uint64(37)) % np.uint64(64 * PARITY)
    odd = np.bincount(place.astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a key that equal sets share, and the hash of each band."""

    def sign(batches):
        hashes, circulant = _process_tables()
        for batch in slices(batches):
            sets = shingle_sets(batch.column(1).to_pylist(), hashes)
            bands = [_bands(circulant.signature(s)) if len(s) else [] for s in sets]
            yield as_batch(
                ["doc_id", "n_shingles", "set_key", "bands"],
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
            )

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(sign, _SIGNED)


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, its shingles and their parity sketch, for the classes in ``wanted`` (rep, doc, set_key)."""

    def hashed(batches):
        hashes, _ = _process_tables()
        for batch in slices(batches, 128):
            sets = shingle_sets(batch.column(1).to_pylist(), hashes)
            keys = batch.column(2).to_pylist()
            right = [i for i, (s, k) in enumerate(zip(sets, keys)) if _set_key(s) == k]
            yield as_batch(
                ["doc_id", "shingles", "parity"],
                [
                    batch.column(0).take(pa.array(right, pa.int64())),
                    pa.array([sets[i].astype(np.int64) for i in right], pa.list_(pa.int64())),
                    pa.array([_parity(sets[i]) for i in right], pa.list_(pa.int64())),
                ],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), text_of().alias("text"))
    # Several texts may have one id; only the one with the class's key is taken.
    found = texts.join(wanted, "doc").select("rep", "text", "set_key").mapInArrow(hashed, _SETS)
    return found.dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "rep")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets overlap enough, on the full sets."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - shared
    return pairs.join(left, "a").join(right, "b").filter(100 * shared >= percent * union).select("a", "b")


def _prefix_pairs(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different parts that can reach the similarity, from ``apart`` (rep, n, part).

    With any common order of shingles, two sets that are similar enough share one among the first
    n - ceil(percent * n / 100) + 1 of each. The order is by the number of sets that hold a shingle,
    so these are rare ones: copies that differ by edits of their own meet in few places, however
    many there are. Within a shingle, sets of its main part are not compared with each other.
    """
    grams = apart.join(sets, "rep").select("rep", "n", "part", F.explode("shingles").alias("gram"))
    sketches = sets.select("rep", "parity")
    held = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    shared = grams.join(held, "gram").groupBy("rep", "n", "part")
    shared = shared.agg(F.sort_array(F.collect_list(F.struct("held", "gram"))).alias("grams"))
    alone = F.col("n") - F.size("grams")
    first = F.expr(f"n - ({percent} * n + 99) div 100 + 1") - alone
    prefix = shared.select(
        "rep",
        "n",
        "part",
        F.explode(F.slice("grams", F.lit(1), F.greatest(first, F.lit(0)).cast("int"))).alias("g"),
    ).select("rep", "n", "part", "g.gram")
    prefix = staged(prefix, "prefixes")
    per_part = prefix.groupBy("gram", "part").agg(F.count(F.lit(1)).alias("sets"))
    mixed = (
        per_part.groupBy("gram")
        .agg(F.max(F.struct("sets", "part")).alias("most"), F.count(F.lit(1)).alias("parts"))
        .filter("parts > 1")
        .select("gram", F.col("most.part").alias("main"))
    )
    met = prefix.join(mixed, "gram").join(sketches, "rep")
    x, y = met.filter("part != main").alias("x"), met.alias("y")
    apart_still = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.part") != F.col("y.part"))
    pairs = x.join(y, apart_still & _may_link("x", "y", percent))
    pairs = staged(pairs.select(*_ordered("x.rep", "y.rep")).distinct(), "pairs")
    discard(prefix)
    return pairs


def _may_link(x: str, y: str, percent: int) -> Column:
    """What every linked pair fulfils: sizes alike, and sketches that differ in few bits."""
    smaller, larger = F.least(f"{x}.n", f"{y}.n"), F.greatest(f"{x}.n", f"{y}.n")
    flips = F.lit(0)
    for k in range(PARITY):
        flips = flips + F.bit_count(F.get(f"{x}.parity", F.lit(k)).bitwiseXOR(F.get(f"{y}.parity", F.lit(k))))
    few = flips * (100 + percent) <= (F.col(f"{x}.n") + F.col(f"{y}.n")) * (100 - percent)
    return (100 * smaller >= percent * larger) & few


def _ordered(a, b):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of ``docs`` (doc_id, text).

    A link needs 100 * intersection >= percent * union. Texts without words are linked with nothing.
    Rows without an id are linked with nothing either and have no component, but are kept. Rows that
    repeat an id are each answered by their own text; several texts under one id are one document
    only where they are linked. An empty table gives an empty result.
    """
    rows = staged(signed(docs), "signed")
    named = rows.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
    equal = named.groupBy("set_key").agg(
        F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    # Classes have numbers of their own: two texts may share an id.
    classes = staged(equal.withColumn("rep", F.monotonically_increasing_id()), "classes")
    dealt = classes.select("rep", "n", F.explode("bands").alias("band"))
    sizes = dealt.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = staged(dealt.join(sizes, "band"), "members")
    wanted = members.select("rep").distinct().join(classes.select("rep", "doc", "set_key"), "rep")
    wanted = staged(wanted, "wanted")
    sets = staged(_sets_of(docs, bounded(wanted)), "sets")

    support = members.groupBy("rep").agg(F.sum("size").alias("support"))
    centres = (
        members.join(support, "rep")
        .groupBy("band")
        .agg(F.max(F.struct("support", -F.col("rep"), "n")).alias("c"))
        .select("band", (-F.col("c.col2")).alias("centre"), F.col("c.n").alias("centre_n"))
    )
    alike = 100 * F.least("n", "centre_n") >= percent * F.greatest("n", "centre_n")
    spokes = members.join(centres, "band").filter(alike & (F.col("rep") != F.col("centre")))
    first = staged(
        _verified(spokes.select(*_ordered("rep", "centre")).distinct(), sets, percent), "links"
    )
    labels = components(first)

    # What is still apart within a bucket of three or more is compared by rare shared shingles.
    open_members = members.filter("size > 2").join(labels, members.rep == labels.id, "left")
    open_members = open_members.select("band", "rep", "n", F.coalesce("component", "rep").alias("part"))
    unsettled = (
        open_members.groupBy("band")
        .agg(F.min("part").alias("low"), F.max("part").alias("high"))
        .filter("low < high")
        .select("band")
    )
    apart = open_members.join(unsettled, "band").select("rep", "n", "part").distinct()
    rest = _prefix_pairs(apart, sets, percent)
    second, spent = staged(_verified(rest, sets, percent), "links"), []
    if not second.isEmpty():
        spent, labels = [labels], components(first.unionByName(second))

    leads = labels.join(classes.select(F.col("rep").alias("id"), "doc"), "id")
    leads = leads.groupBy("component").agg(F.min("doc").alias("lead"))
    led = labels.join(leads, "component").select("id", "lead")
    parts = classes.join(led, classes.rep == led.id, "left")
    parts = staged(parts.select("set_key", F.coalesce("lead", "doc").alias("component")), "parts")
    discard(classes, members, wanted, sets, first, rest, second, labels, *spent)
    found = rows.join(parts, "set_key", "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id"))
    kept = F.col("doc_id").isNull() | (F.col("doc_id") == component)
    return found.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def deduplicated(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Documents are linked by their own text, or by the one that ``texts`` (doc_id, text) has for their
    id, such as the text before lines were taken out; documents that it does not have are left alone.
    Rows without an id stay, and so do all rows of an id that stays; an empty table stays empty.
    """
    if texts is None:
        linked = docs
    else:
        ids = docs.select(F.col("doc_id").cast("long").alias("id")).distinct()
        ids = bounded(staged(ids, "ids"))
        linked = texts.join(ids, F.col("doc_id").cast("long") == F.col("id"), "left_semi")
    dropped = near_duplicates(linked).filter("NOT kept").select(F.col("doc_id").alias("dropped")).distinct()
    rows = docs.select(F.struct("*").alias("doc"))
    same = F.col("doc.doc_id").cast("long") == F.col("dropped")
    return rows.join(bounded(staged(dropped, "dropped")), same, "left_anti").select("doc.*")
