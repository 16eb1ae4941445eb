"""Token counts per document by a two-tier lookup on the map side.

Tier one is a table of the lengths of frequent words (a word with the space or line break before it,
which no pre-token crosses), sent to every worker; tier two is a bounded cache in each worker, filled
by encoding what tier one lacks. No occurrence of a word is shuffled. The table is built from bounded
summaries, one per task over all its documents, that are summed; it only saves time, counts never
depend on it.
"""

from __future__ import annotations

import uuid
from collections import Counter as Tally

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import as_batch, discard, leading, slices, staged, text_of
from tidegauge.llm.encoding import Counter, SpacedWords, load_tokenizer

_COUNTERS: dict[str, Counter] = {}
_COUNTS = "doc_id long, n_bytes long, n_tokens long"
_SUMMARY = "unit string, n long"


def frequent_lengths(
    docs: DataFrame, tokenizer_path: str, size: int = 65_536, per_task: int = 8_192
) -> dict[str, int]:
    """Lengths of the ``size`` words that lead the tasks' summaries of ``per_task`` words each."""

    def summaries(batches):
        splitter, seen = SpacedWords(load_tokenizer(tokenizer_path)), Tally()
        for batch in slices(batches, 4096):
            words = pc.value_counts(splitter.units(batch.column(0)).flatten())
            seen.update(dict(zip(words.field(0).to_pylist(), words.field(1).to_pylist())))
            if len(seen) > 32 * per_task:
                seen = Tally(dict(seen.most_common(8 * per_task)))
        top = [(u, n) for u, n in seen.most_common(per_task) if 0 < len(u) <= 64]
        yield as_batch(
            ["unit", "n"],
            [pa.array([u for u, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
        )

    summed = docs.select(text_of().alias("text")).mapInArrow(summaries, _SUMMARY)
    # Written, as it is read twice: for the histogram of counts and for the leading words.
    totals = staged(summed.groupBy("unit").agg(F.sum("n").alias("n")), "frequent")
    counter = Counter(tokenizer_path, {}, size)
    lengths = {row.unit: counter.length(row.unit) for row in leading(totals, size).collect()}
    discard(totals)
    return {unit: n for unit, n in lengths.items() if n > 0}


def _process_counter(version: str, tokenizer_path: str, frequent) -> Counter:
    """The worker process's counter for one broadcast table; its cache outlives tasks."""
    if version not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[version] = Counter(tokenizer_path, frequent.value)
    return _COUNTERS[version]


def token_counts(docs: DataFrame, tokenizer_path: str, frequent: dict[str, int]) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every text as the tokenizers library counts them.

    Null texts are empty, empty texts have no tokens, repeated rows are counted one by one and other
    columns are ignored. The path must be readable on every worker.
    """
    shared, version = docs.sparkSession.sparkContext.broadcast(frequent), uuid.uuid4().hex

    def counted(batches):
        counter = _process_counter(version, tokenizer_path, shared)
        for batch in slices(batches, 4096):
            lengths = pa.array(counter.counts(batch.column(1)))
            yield as_batch(
                ["doc_id", "n_bytes", "n_tokens"], [batch.column(0), batch.column(2), lengths]
            )

    text = text_of()
    wanted = docs.select(
        F.col("doc_id").cast("long"),
        text.alias("text"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    return wanted.mapInArrow(counted, _COUNTS)
