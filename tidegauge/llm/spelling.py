"""Variants of a spelling, by permuterm rotations of all words.

A word and a terminator are written as a ring; a rotation of ``uv`` that starts behind ``u`` reads
``v$u``. Leave out the last letter of a rotation and what is left is a prefix: all words that share it
differ in that letter only (replacements), and a word whose whole rotation is that prefix lacks the
letter (insertions and deletions). So every rotation gives two keys, itself and its prefix; rows are
dealt and sorted by key, and one scan over the sorted rows sees each group at once. A group holds at
most one word for each letter of the alphabet and one without, whatever the number of words.

Groups emit one row for each member: how many others it met and the best of them. No pair is emitted.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import as_batch, discard, slices, staged, text_of

#: Words held by a task before it hands on what it has counted.
HELD = 200_000
END = "\x00"

# One byte for each code point up to U+00FF; only A-Z are lower-cased, other code points separate.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256)
)

#: Longer keys are hashed, so a word of any length has keys of bounded size in linear time.
LONGEST_KEY = 64
# A prime and a base for the hashes of long keys.
_PRIME, _BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F

_KEYS = "key string, id long, n long, whole boolean, counts boolean"
_MET = "id long, n long, met long, best_n long, best long"


def runs_of(text: str) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_FOLD).split(b" ")


def thinned(run: bytes, seed: int, every: int) -> bytes:
    """The run, or where ``every`` divides its hash, without the letter that the hash points to.

    ``seed`` is the crc32 of what stands before the run in the hashed text.
    """
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, least_length: int = 5, every: int = 97) -> DataFrame:
    """word and n over all texts, for words of ``least_length`` code points or more.

    Each run of letters is a word; a hash of the row's id and the run takes a letter out of some
    (one in ``every`` runs). Words are counted in each task before they are shuffled.
    """

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in slices(batches):
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seed = zlib.crc32(f"{name}:".encode())
                for run, n in Counter(runs_of(text)).items():
                    # One letter goes at most, so no shorter run becomes a word.
                    if len(run) >= least_length:
                        word = thinned(run, seed, every)
                        if len(word) >= least_length:
                            held[word] += n
                if len(held) > HELD:
                    yield _counts(held)
                    held.clear()
        yield _counts(held)

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name")
    texts = docs.select(name, text_of().alias("text"))
    found = texts.mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _counts(held: Counter) -> pa.RecordBatch:
    words = pa.array([w.decode("latin-1") for w in held], pa.string())
    return as_batch(["word", "n"], [words, pa.array(list(held.values()), pa.int64())])


def _windows(ring: str, size: int, length: int) -> list[str]:
    """The parts of ``length`` code points that begin at the first ``size`` places, long ones hashed."""
    if length <= LONGEST_KEY:
        return [ring[k : k + length] for k in range(size)]
    sums, whole = [0], 0
    for c in ring:
        whole = (whole * _BASE + ord(c) + 1) % _PRIME
        sums.append(whole)
    power = pow(_BASE, length, _PRIME)
    return [f"{(sums[k + length] - sums[k] * power) % _PRIME:032x}" for k in range(size)]


def rotation_keys(words: DataFrame) -> DataFrame:
    """Two keys for each rotation: the whole one, and the prefix that skips the last letter.

    In a row of equal letters the loss of any of them gives the same word; ``counts`` marks one.
    """

    def rotated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            keys, sizes, whole, counts = [], [], [], []
            for word in batch.column(0).to_pylist():
                ring, size = word + END + word, len(word)
                keys += _windows(ring, size + 1, size + 1)
                keys += _windows(ring[1:], size, size)
                sizes.append(2 * size + 1)
                whole += [True] * (size + 1) + [False] * size
                counts += [True] * (size + 1)
                counts += [a != b for a, b in zip(word, ring[1 : size + 1])]
            pick = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            columns = [pa.array(keys, pa.string()), batch.column(1).take(pick), batch.column(2).take(pick)]
            columns += [pa.array(whole, pa.bool_()), pa.array(counts, pa.bool_())]
            yield as_batch(["key", "id", "n", "whole", "counts"], columns)

    return words.select("word", "id", "n").mapInArrow(rotated, _KEYS)


def met_in_groups(keys: DataFrame) -> DataFrame:
    """For each word of a key that others have too: how many new ones it meets, and the best other.

    Rows with one key must lie together, those of the largest ``n`` first, ties by id.
    """

    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            here = pa.Table.from_batches([batch])
            here = pa.concat_tables([rest, here]) if rest is not None else here
            here = here.combine_chunks()
            key = here.column("key")
            if not len(key):
                continue
            # The last group may go on in the next batch.
            open_at = pc.index(key, key[-1]).as_py()
            rest = here.slice(open_at)
            yield from _met(here.slice(0, open_at))
        if rest is not None:
            yield from _met(rest)

    return keys.mapInArrow(scanned, _MET)


def _flat(column: pa.ChunkedArray) -> pa.Array:
    joined = column.combine_chunks()
    return pa.concat_arrays(joined.chunks) if isinstance(joined, pa.ChunkedArray) else joined


def _met(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    if rows.num_rows < 2:
        return
    key = _flat(rows.column("key"))
    same = pc.equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
    shared = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
    if not len(shared):
        return
    first = ~np.r_[False, same][shared]
    group = np.cumsum(first) - 1
    begin = np.flatnonzero(first)
    rows = rows.take(pa.array(shared))
    whole, counts = (rows.column(c).to_numpy() for c in ("whole", "counts"))
    size = np.bincount(group)
    lacking = np.bincount(group, whole).astype(np.int64)
    new = np.bincount(group, counts & ~whole).astype(np.int64)
    met = np.where(whole, new[group], (size - lacking)[group] - 1 + lacking[group] * counts)
    best = begin[group] + (np.arange(len(group)) == begin[group])
    n, ids, best = _flat(rows.column("n")), _flat(rows.column("id")), pa.array(best)
    yield as_batch(
        ["id", "n", "met", "best_n", "best"],
        [ids, n, pa.array(met), n.take(best), ids.take(best)],
    )


def neighbours(words: DataFrame) -> DataFrame:
    """id, n, n_near and, of the near words of largest n, the one with the smallest id.

    Two words are near that differ by one code point inserted, deleted or replaced. Words without a
    near one are not returned; words and ids must be distinct.
    """
    keys = rotation_keys(words)
    sorted_keys = keys.repartition("key").sortWithinPartitions("key", F.desc("n"), "id")
    met = met_in_groups(sorted_keys)
    return met.groupBy("id", "n").agg(
        F.sum("met").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("best")
    ).select("id", "n", "n_near", (-F.col("best.n")).alias("best_n"), "best.best")


def roots(forms: DataFrame) -> DataFrame:
    """id and the end of its chain of forms, for rows of id and form; there are no rings.

    Each round replaces the end found so far by that word's own end, so a chain is followed in a
    number of rounds that is logarithmic in its length.
    """
    ends = staged(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        ahead = ends.select(F.col("id").alias("root"), F.col("root").alias("next"))
        moved = staged(ends.join(ahead, "root", "left").select("id", "root", "next"), "roots")
        discard(ends)
        ends = moved.select("id", F.coalesce("next", "root").alias("root"))
        ends._staged_at = moved._staged_at
        if moved.filter("next is not null").isEmpty():
            return ends


def spelling_groups(
    docs: DataFrame, least_length: int = 5, least_count: int = 3, every: int = 97, times: int = 2
) -> DataFrame:
    """word, form, root, n, n_near and form_n for every word that occurs ``least_count`` times.

    A word's form is its near word of the largest n (ties: the first in code-point order) where that
    is at least ``times`` its own n, else null; the root is the last of the forms that follow from it,
    or the word. ``times`` must be over 1. Null and empty texts have no words, repeated rows count
    each, a null id hashes as an empty one, words may be of any length, and other columns are ignored;
    an empty table gives no rows.
    """
    counted = word_counts(docs, least_length, every).filter(F.col("n") >= least_count)
    # Ids of a sorted table are in the order of the words.
    words = staged(counted.orderBy("word").withColumn("id", F.monotonically_increasing_id()), "words")
    found = neighbours(words)
    named = F.col("best_n") >= times * F.col("n")
    found = staged(
        found.select("id", "n_near", F.when(named, F.col("best")).alias("form"), F.when(named, F.col("best_n")).alias("form_n")),
        "near-words",
    )
    last = roots(found.filter("form is not null"))

    def word_of(column: str, name: str) -> DataFrame:
        return words.select(F.col("id").alias(column), F.col("word").alias(name))

    linked = found.join(last, "id", "left").join(word_of("form", "form_word"), "form", "left")
    linked = linked.join(word_of("root", "root_word"), "root", "left")
    return words.join(linked, "id", "left").select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
