"""Token ids as files of framed binary records, with an offset index for shuffled reads.

A record is: the payload's length (8 bytes), the masked CRC-32C of those 8 bytes (4), the payload, the
masked CRC-32C of the payload (4), all little-endian. The payload is a header of 12 bytes (flag: 1
where the id is null; bytes per token id; two zero bytes; the document id) and the token ids.

Every task writes files of its own under names that no other attempt uses and returns their index
rows, which Spark commits. A file that a lost or repeated attempt left behind is in no index row, so
readers never see it. Files go below a folder that driver and executors share, by pyarrow's file
systems (file, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.checksums import crc32c, masked
from tidegauge.llm.common import as_batch, slices, text_of
from tidegauge.llm.encoding import process_encoder

INDEX = "shard int, row long, file string, offset long, length int, doc_id long, n_tokens long, before long"
_READ = "shard int, row long, before long, doc_id long, n_tokens long, ids_crc32 long"

_HEADER, _HEADER_BYTES = "<BBxxq", 12


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark names it, and the path within it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def framed(payloads: list[bytes]) -> list[bytes]:
    """The parts of the records of these payloads, in order: length, check, payload, check, ..."""
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    head_checks = masked(crc32c(heads)).astype("<u4").tobytes()
    checks = masked(crc32c(payloads)).astype("<u4").tobytes()
    parts = []
    for i, (head, payload) in enumerate(zip(heads, payloads)):
        parts += (head, head_checks[4 * i : 4 * i + 4], payload, checks[4 * i : 4 * i + 4])
    return parts


def unframed(data: bytes) -> list[bytes]:
    """The payloads of whole records that follow each other; any damage raises."""
    heads, payloads, stored, at = [], [], [], 0
    while at < len(data):
        head = data[at : at + 8]
        end = at + 12 + (int.from_bytes(head, "little") if len(head) == 8 else len(data))
        if end + 4 > len(data):
            raise ValueError("a record is cut off or its length is wrong")
        heads.append(head)
        payloads.append(data[at + 12 : end])
        stored.append(data[at + 8 : at + 12] + data[end : end + 4])
        at = end + 4
    found = np.stack([masked(crc32c(heads)), masked(crc32c(payloads))], axis=1).astype("<u4")
    if found.tobytes() != b"".join(stored):
        raise ValueError("a record's checksum is wrong")
    return payloads


def write_records(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 0,
    file_bytes: int = 256 << 20,
) -> DataFrame:
    """Encode ``text`` and write records below ``path`` in ascending doc_id order; returns the index.

    Shards follow doc_id ranges, equal ids in the order of their texts' hashes and null ids first.
    Null texts are empty, every document ends in ``end_id``, repeated rows give repeated records and
    other columns are ignored. An empty table gives an index without rows. A task holds one block of
    records and the index rows of its file in memory.
    """
    target = path.rstrip("/")

    def write(batches):
        encoder = process_encoder(tokenizer_path)
        system, folder = file_system(f"{target}/data")
        system.create_dir(folder, recursive=True)
        shard = TaskContext.get().partitionId()
        end = np.array([end_id], encoder.dtype).tobytes()
        out, name, rows, offset, number, before = None, "", [], 0, 0, 0
        for batch in slices(batches, 4096):
            payloads, ids = [], batch.column(0).to_pylist()
            for doc_id, tokens in zip(ids, encoder.packed(batch.column(1))):
                head = struct.pack(_HEADER, doc_id is None, encoder.width, doc_id or 0)
                payloads.append(head + tokens + end)
            if out is None:
                name = f"part-{shard:06d}-{uuid.uuid4().hex}.rec"
                out, offset, rows = system.open_output_stream(f"{folder}/{name}"), 0, []
            out.write(b"".join(framed(payloads)))
            for doc_id, payload in zip(ids, payloads):
                tokens = (len(payload) - _HEADER_BYTES) // encoder.width
                size = len(payload) + 16
                rows.append((shard, number, f"data/{name}", offset, size, doc_id, tokens, before))
                offset, number, before = offset + size, number + 1, before + tokens
            if offset >= file_bytes:
                out.close()
                out = None
                yield _index_batch(rows)
        if out is not None:
            out.close()
            yield _index_batch(rows)

    ordered = (
        docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .drop("tie")
    )
    ordered.mapInArrow(write, INDEX).write.parquet(f"{target}/index")
    return read_index(docs.sparkSession, target)


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["shard", "row", "file", "offset", "length", "doc_id", "n_tokens", "before"]
    kinds = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int32()] + [pa.int64()] * 3
    return as_batch(names, [pa.array(c, t) for c, t in zip(zip(*rows), kinds)])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path.rstrip('/')}/index")


def _payloads(system, root: str, files, offsets, lengths, most: int = 8 << 20):
    """Payloads of index rows in their order; neighbours in a file are fetched together."""
    at = 0
    while at < len(files):
        end, size = at + 1, lengths[at]
        while (
            end < len(files)
            and files[end] == files[at]
            and offsets[end] == offsets[at] + size
            and size + lengths[end] <= most
        ):
            size += lengths[end]
            end += 1
        with system.open_input_file(f"{root}/{files[at]}") as source:
            yield from unframed(source.read_at(size, offsets[at]))
        at = end


def decoded(payload: bytes) -> tuple[int | None, np.ndarray]:
    """Document id and token ids (little-endian unsigned 32 bit) of a payload."""
    null, width, doc_id = struct.unpack_from(_HEADER, payload)
    ids = np.frombuffer(payload, "<u2" if width == 2 else "<u4", offset=_HEADER_BYTES).astype("<u4")
    return (None if null else doc_id), ids


def read_digests(index: DataFrame, path: str) -> DataFrame:
    """Reads the files by the index, in any order of its rows, and digests each record's ids."""
    root_path = path.rstrip("/")

    def read(batches):
        system, root = file_system(root_path)
        for batch in slices(batches, 4096):
            files, offsets, lengths = (batch.column(i).to_pylist() for i in (2, 3, 4))
            found = []
            for payload in _payloads(system, root, files, offsets, lengths):
                doc_id, ids = decoded(payload)
                found.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
            columns = list(zip(*found)) or [(), (), ()]
            arrays = [batch.column(0), batch.column(1), batch.column(7)]
            arrays += [pa.array(c, pa.int64()) for c in columns]
            yield as_batch(["shard", "row", "before", "doc_id", "n_tokens", "ids_crc32"], arrays)

    return index.mapInArrow(read, _READ)


def with_starts(records: DataFrame, index: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all records before. Only one row per shard passes a single task."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("_tokens"))
    bases = totals.select("shard", F.coalesce(F.sum("_tokens").over(earlier), F.lit(0)).alias("_base"))
    return records.join(bases, "shard").withColumn("start", F.col("_base") + F.col("before"))
