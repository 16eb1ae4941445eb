"""The best documents for every item of a query table, over an index that is partitioned by terms.

The terms of the queries are dealt to a few owners, rare terms to the first ones. Bundles of items
visit the owners one after the other: a bundle arrives with sparse accumulators (documents and their
scores so far), meets the owner's postings in a cogroup, adds their integer contributions and goes on.
Documents come in blocks of ``BLOCK``, and a bundle travels once per block, so a group's size depends
neither on the number of documents nor on how frequent a term is.

A document is left behind only where it cannot reach the ten best of its own block any more: its score
plus all that the later owners could add is below the tenth score so far. Results are exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import as_batch, bounded, discard, slices, staged
from tidegauge.llm.decontaminate import words_of

BLOCK_BITS = 13
BLOCK = 1 << BLOCK_BITS
OWNERS = 4
ITEMS = 256
PART = 1 << 20
# Fixed values of the score: no term occurrence adds more than its weight times FULL.
FULL = 1_000_000

_POSTINGS = "owner int, bundle int, block long, term int, places array<int>, gains array<long>"
_BUNDLES = "block long, bundle int, items array<int>, places array<int>, scores array<long>"
_BUNDLE_TYPE = pa.schema(
    [
        ("block", pa.int64()),
        ("bundle", pa.int32()),
        ("items", pa.list_(pa.int32())),
        ("places", pa.list_(pa.int32())),
        ("scores", pa.list_(pa.int64())),
    ]
)


class Queries(NamedTuple):
    """Items numbered from 0 and their terms, as parallel arrays in the order of items."""

    keys: list[int]
    vocabulary: dict[bytes, int]
    item: np.ndarray
    term: np.ndarray
    count: np.ndarray

    def terms_by_bundle(self) -> tuple[np.ndarray, np.ndarray]:
        """Each (term, bundle) in which an item has the term, ordered by term."""
        pairs = np.unique(np.stack([self.term, self.item // ITEMS], axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]


class Owners(NamedTuple):
    """By term its weight and its owner, and what the scores need of the whole collection."""

    weight: np.ndarray
    owner: np.ndarray
    n_docs: int
    n_terms: int


def term_counts(text: str) -> Counter:
    """How often each term occurs; long texts are split a part at a time."""
    if len(text) <= PART:
        return Counter(words_of(text))
    found: Counter = Counter()
    start = 0
    while start < len(text):
        end = start + PART
        while end < len(text) and (text[end].isalnum() or text[end] > "\x7f"):
            end += 1
        found.update(words_of(text[start:end]))
        start = end
    return found


def query_terms(items: DataFrame) -> DataFrame:
    """item, term and its occurrences in the item's text; null texts have none."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = term_counts(text or "")
                arrays = [pa.array([item] * len(found), pa.int64())]
                arrays += [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())]
                yield as_batch(["item", "term", "n"], arrays)

    return items.select("item", "text").mapInArrow(counted, "item long, term binary, n long")


def _queries(terms: DataFrame, part: int, parts: int) -> Queries:
    """The items of one part, of bounded size by the choice of ``parts``."""
    rows = terms.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).collect()
    rows.sort(key=lambda r: (r.item, r.term))
    numbers: dict[int, int] = {}
    vocabulary: dict[bytes, int] = {}
    item = np.array([numbers.setdefault(r.item, len(numbers)) for r in rows], np.int64)
    term = np.array([vocabulary.setdefault(bytes(r.term), len(vocabulary)) for r in rows], np.int64)
    return Queries(list(numbers), vocabulary, item, term, np.array([r.n for r in rows], np.int64))


def document_terms(docs: DataFrame, queries: Queries) -> DataFrame:
    """row, doc_id, n (terms) and the counts of query terms, for documents with a term.

    Rows are numbered in the order of doc_id within each partition, nulls first, so that equal scores
    of one block are in the order of the result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(queries.vocabulary)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches):
            sizes, terms, counts = [], [], []
            for text in batch.column(1).to_pylist():
                tally = term_counts(text or "")
                found = tally.keys() & known.keys()
                sizes.append(tally.total())
                terms.append([known[t] for t in found])
                counts.append([tally[t] for t in found])
            arrays = [
                pa.array(sizes, pa.int64()),
                pa.array(terms, pa.list_(pa.int32())),
                pa.array(counts, pa.list_(pa.int64())),
            ]
            yield as_batch(["doc_id", "n", "terms", "counts"], [batch.column(0), *arrays])

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        counted, "doc_id long, n long, terms array<int>, counts array<long>"
    )
    ordered = found.filter("n > 0").sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    return ordered.withColumn("row", F.monotonically_increasing_id())


def term_owners(index: DataFrame, queries: Queries) -> Owners:
    """Weights from document frequencies, and owners with about equal shares of the postings."""
    n_docs, n_terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = np.zeros(len(queries.vocabulary), np.int64)
    for row in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[row["term"]] = row["count"]
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in frequency]
    order = np.argsort(frequency, kind="stable")
    before = np.cumsum(frequency[order]) - frequency[order]
    owner = np.zeros(len(frequency), np.int64)
    owner[order] = np.minimum(before * OWNERS // max(int(frequency.sum()), 1), OWNERS - 1)
    return Owners(np.array(weight, np.int64), owner, n_docs, n_terms)


def postings(index: DataFrame, queries: Queries, owners: Owners) -> DataFrame:
    """Per owner, bundle, block and term the documents' places in the block and what they gain.

    Documents of one block come in one or more batches, so a term may have several rows in a block.
    """
    shared = index.sparkSession.sparkContext.broadcast((owners, *queries.terms_by_bundle()))

    def inverted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, wanted_term, wanted_bundle = shared.value
        for batch in batches:
            row, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            lists = batch.column(2)
            each = lists.value_lengths().to_numpy(zero_copy_only=False)
            term = lists.flatten().to_numpy(zero_copy_only=False)
            count = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            m = 25 + 75 * n * held.n_docs // held.n_terms
            row, m = np.repeat(row, each), np.repeat(m, each)
            gain = held.weight[term] * (1_000_000_000 * count // (1000 * count + 8 * m))
            some = np.flatnonzero(gain)
            some = some[np.lexsort((row[some], term[some], row[some] >> BLOCK_BITS))]
            row, term, gain = row[some], term[some], gain[some]
            if not len(row):
                continue
            block = row >> BLOCK_BITS
            first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])])
            low = np.searchsorted(wanted_term, term[first], "left")
            copies = np.searchsorted(wanted_term, term[first], "right") - low
            group = np.repeat(np.arange(len(first)), copies)
            nth = np.arange(len(group)) - np.repeat(np.cumsum(copies) - copies, copies)
            places = pa.array((row & (BLOCK - 1)).astype(np.int32))
            offsets = pa.array(np.append(first, len(row)).astype(np.int32))
            pick = pa.array(group)
            yield as_batch(
                ["owner", "bundle", "block", "term", "places", "gains"],
                [
                    pa.array(held.owner[term[first]][group].astype(np.int32)),
                    pa.array(wanted_bundle[low[group] + nth].astype(np.int32)),
                    pa.array(block[first][group]),
                    pa.array(term[first][group].astype(np.int32)),
                    pa.ListArray.from_arrays(offsets, places).take(pick),
                    pa.ListArray.from_arrays(offsets, pa.array(gain)).take(pick),
                ],
            )

    return index.select("row", "n", "terms", "counts").mapInArrow(inverted, _POSTINGS)


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and where each row's begin and end."""
    joined = column.combine_chunks()
    lengths = joined.value_lengths().to_numpy(zero_copy_only=False)
    return joined.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)])


def visited(bundles: DataFrame, owned: DataFrame, owner: int, shared, top: int) -> DataFrame:
    """Bundles after one owner added the contributions of its postings."""

    def added(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        queries, owners = shared.value
        block, bundle = key[0].as_py(), key[1].as_py()
        span = np.searchsorted(queries.item, [bundle * ITEMS, (bundle + 1) * ITEMS])
        items, terms, counts = (a[span[0] : span[1]] for a in (queries.item, queries.term, queries.count))
        later = owners.owner[terms] > owner
        bound = counts * owners.weight[terms] * FULL * later

        places, ends = _lists(right.column("places"))
        gains, _ = _lists(right.column("gains"))
        order = np.argsort(right.column("term").to_numpy(), kind="stable")
        listed = right.column("term").to_numpy()[order]
        carried, at, score = (_lists(left.column(c))[0] for c in ("items", "places", "scores"))

        numbers, begins = np.unique(items, return_index=True)
        out: list[list[np.ndarray]] = [[], [], []]
        for item, begin, end in zip(numbers.tolist(), begins.tolist(), [*begins[1:].tolist(), len(items)]):
            sums = np.zeros(BLOCK, np.int64)
            mine = slice(*np.searchsorted(carried, [item, item + 1]))
            sums[at[mine]] = score[mine]
            low = np.searchsorted(listed, terms[begin:end], "left")
            high = np.searchsorted(listed, terms[begin:end], "right")
            for k in np.flatnonzero(high > low).tolist():
                for posting in order[low[k] : high[k]].tolist():
                    part = slice(ends[posting], ends[posting + 1])
                    sums[places[part]] += counts[begin + k] * gains[part]
            alive = np.flatnonzero(sums)
            if owner == OWNERS - 1:
                alive = alive[np.lexsort((alive, -sums[alive]))[:top]]
            elif len(alive) > top:
                reach = np.partition(sums[alive], len(alive) - top)[len(alive) - top]
                alive = alive[sums[alive] + bound[begin:end].sum() >= reach]
            out[0].append(np.full(len(alive), item, np.int32))
            out[1].append(alive.astype(np.int32))
            out[2].append(sums[alive])
        flat = [np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]
        columns = [pa.array([block], pa.int64()), pa.array([bundle], pa.int32())]
        for values, field in zip(flat, list(_BUNDLE_TYPE)[2:]):
            whole = pa.array([0, len(values)], pa.int32())
            columns.append(pa.ListArray.from_arrays(whole, pa.array(values, field.type.value_type)))
        return pa.Table.from_arrays(columns, schema=_BUNDLE_TYPE)

    mine = owned.filter(F.col("owner") == owner).select("block", "bundle", "term", "places", "gains")
    pair = bundles.groupBy("block", "bundle").cogroup(mine.groupBy("block", "bundle"))
    return pair.applyInArrow(added, _BUNDLES)


def _best_rows(docs: DataFrame, queries: Queries, top: int) -> DataFrame:
    """item, row, doc_id and score of documents that lead all others of an item, ties included."""
    index = staged(document_terms(docs, queries), "search-index")
    owners = term_owners(index, queries)
    owned = staged(postings(index, queries, owners), "search-postings")
    shared = docs.sparkSession.sparkContext.broadcast((queries, owners))
    empty = [F.array().cast(kind).alias(name) for name, kind in
             (("items", "array<int>"), ("places", "array<int>"), ("scores", "array<long>"))]
    bundles = owned.select("block", "bundle").distinct().select("block", "bundle", *empty)
    for owner in range(OWNERS):
        bundles = visited(bundles, owned, owner, shared, top)
    scored = bundles.select(
        "block", F.explode(F.arrays_zip("items", "places", "scores")).alias("hit")
    ).select(
        F.col("hit.items").alias("item"),
        (F.shiftleft("block", BLOCK_BITS) + F.col("hit.places")).alias("row"),
        F.col("hit.scores").alias("score"),
    )
    standing = F.rank().over(Window.partitionBy("item").orderBy(F.desc("score")))
    leading = staged(scored.withColumn("standing", standing).filter(F.col("standing") <= top), "search-hits")
    discard(owned)
    found = index.select("row", "doc_id").join(bounded(leading), "row").select("item", "row", "doc_id", "score")
    found = staged(found, "search-found")
    discard(index, leading)
    return found


def ranked(docs: DataFrame, items: DataFrame, top: int = 10, at_once: int = 1_000_000) -> DataFrame:
    """item_id, rank, doc_id and score: the ``top`` documents with a score above 0 for each item.

    Equal scores are in the order of doc_id, a null id first, rows with one id as they come. Every row
    of ``items`` is answered, also where an item_id repeats or is null; items without a term, with
    null or empty text or without a document have no row, and so has an empty table on either side.
    Documents without a term count nowhere; other columns are ignored. The tables hold texts in
    ``text``, ids in ``item_id`` and ``doc_id``. About ``at_once`` terms of items are sent to every
    task; more items are answered in several passes.
    """
    asked = staged(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "search-items")
    terms = staged(query_terms(asked), "search-terms")
    parts = max(1, -(-terms.count() // at_once))
    answers = None
    for part in range(parts):
        queries = _queries(terms, part, parts)
        found = _best_rows(docs, queries, top)
        numbers = docs.sparkSession.createDataFrame(
            [(n, key) for n, key in enumerate(queries.keys)], "number int, item long"
        )
        found = found.withColumnRenamed("item", "number").join(numbers, "number").drop("number")
        answers = found if answers is None else answers.unionByName(found)
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first(), "row")
    best = answers.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)
    discard(terms)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
