"""Record files: checksums, framing, damage, order and a round trip."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest

from tidegauge.llm import records
from tidegauge.llm.checksums import crc32c, masked
from tidegauge.llm.encoding import load_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_crc32c(data):
    register = 0xFFFFFFFF
    for byte in data:
        register ^= byte
        for _ in range(8):
            register = (register >> 1) ^ (0x82F63B78 if register & 1 else 0)
    return register ^ 0xFFFFFFFF


def test_checksums():
    deal = random.Random(1)
    strings = [deal.randbytes(n) for n in (0, 1, 7, 511, 512, 513, 1024, 3000, 0, 5)]
    assert crc32c([b"123456789"])[0] == 0xE3069283
    assert crc32c(strings).tolist() == [plain_crc32c(s) for s in strings]
    rotated = ((0xE3069283 >> 15) | (0xE3069283 << 17)) & 0xFFFFFFFF
    assert masked(crc32c([b"123456789"]))[0] == (rotated + 0xA282EAD8) & 0xFFFFFFFF


def test_frames():
    payloads = [b"", b"a", b"\0" * 1000]
    data = b"".join(records.framed(payloads))
    assert struct.unpack_from("<Q", data, 16)[0] == 1
    assert records.unframed(data) == payloads
    for damaged in (data[:-1], b"\1" + data[1:], data[:-3] + b"zzz"):
        with pytest.raises(ValueError):
            records.unframed(damaged)


def written(spark, docs, folder):
    index = records.write_records(docs, folder, PATH)
    found = records.with_starts(records.read_digests(index, folder), index)
    return index, sorted(found.collect(), key=lambda r: r.start)


def test_round_trip(spark, awkward, folder):
    index, found = written(spark, awkward, folder)
    tokenizer, start = load_tokenizer(PATH), 0
    want = {}
    for row in awkward.collect():
        ids = np.array(tokenizer.encode(row.text or "", add_special_tokens=False).ids + [0], "<u4")
        want.setdefault(row.doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    assert [r.doc_id for r in found] == sorted(
        (r.doc_id for r in found), key=lambda d: (d is not None, d or 0)
    )
    for row in found:
        assert row.start == start
        want[row.doc_id].remove((row.n_tokens, row.ids_crc32))
        start += row.n_tokens
    assert not any(want.values())


def test_shuffled_reads(spark, awkward, folder):
    index, found = written(spark, awkward, folder)
    mixed = index.repartition(5, "offset")
    digests = records.read_digests(mixed, folder).collect()
    assert sorted(r.ids_crc32 for r in digests) == sorted(r.ids_crc32 for r in found)


def test_files_without_index_rows_are_never_read(spark, awkward, folder):
    index, found = written(spark, awkward, folder)
    with open(f"{folder}/data/part-000000-stray.rec", "wb") as stray:
        stray.write(b"left behind")
    assert records.read_digests(records.read_index(spark, folder), folder).count() == len(found)


def test_empty_table(spark, empty, folder):
    assert written(spark, empty, folder)[1] == []
