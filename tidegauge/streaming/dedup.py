"""Deduplication within the watermark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidegauge.streaming.sources import watermarked, with_event_time


def _newest_copies(
    event_time: str, keys: list[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keeps the newest row per key of each record batch, in its place.

    The newest is late only if all copies are, so no key is lost to the late-row filter.
    """

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Codes rather than values: exact for large integers, and null differs from NaN.
            codes = {k: _codes(batch.column(k)) for k in keys}
            micros = batch.column(event_time).cast(pa.int64()).fill_null(np.iinfo(np.int64).min)
            newest_first = np.argsort(micros.to_numpy(), kind="stable")[::-1]
            copies = pd.DataFrame(codes).iloc[newest_first].duplicated().to_numpy()
            kept = np.sort(newest_first[~copies])
            yield batch if len(kept) == len(batch) else batch.take(pa.array(kept))

    return thin


def _codes(values: pa.Array) -> np.ndarray:
    return values.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)


_NESTED = (T.ArrayType, T.MapType, T.StructType)


def deduplicated(
    stream: DataFrame, event_time: str, delay: str, keys: list[str], thin: bool = True
) -> DataFrame:
    """One row per key among rows within ``delay`` of each other.

    Copies further apart may or may not be merged, as with Spark's own operator, which keeps one
    row per key of a micro-batch anyway. ``thin`` does part of that before the shuffle, so a key
    that holds a third of all rows sends one row per record batch to the task that owns it.
    """
    timed = with_event_time(stream, event_time)
    if thin and not any(isinstance(timed.schema[k].dataType, _NESTED) for k in keys):
        timed = timed.mapInArrow(_newest_copies(event_time, keys), timed.schema)
    return watermarked(timed, event_time, delay).dropDuplicatesWithinWatermark(keys)
