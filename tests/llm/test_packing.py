"""Packing: the schedule, whole coverage, the mixture, and odd tables."""

import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest

from tests.llm.conftest import PROSE, row
from tidegauge.llm import packing
from tidegauge.llm.encoding import load_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("case", range(12))
def test_schedule_places_every_token_once(case):
    deal = np.random.default_rng(case)
    totals = deal.integers(0, 9000, int(deal.integers(1, 8))).tolist()
    totals[-1] = 1 if case % 5 == 0 else totals[-1]
    shares = None if case % 2 else (deal.random(len(totals)) + 0.01).tolist()
    schedule = packing.Schedule(totals, shares, window=64, grain=int(deal.integers(1, 20)))
    queue, first, n = [], [], []
    for q, total in enumerate(totals):
        at = 0
        while at < total:
            size = min(int(deal.integers(1, 700)), total - at)
            queue.append(q), first.append(at), n.append(size)
            at += size
    order = deal.permutation(len(n))
    rows = schedule.documents(*(np.array(v, np.int64)[order] for v in (queue, first, n)))
    seen = np.zeros(sum(totals), int)
    for _, _, length, position in rows.tolist():
        assert position // 64 == (position + length - 1) // 64
        seen[position : position + length] += 1
    assert (seen == 1).all()
    sizes = np.bincount(rows[:, 0], rows[:, 2], len(n))
    assert (sizes == np.array(n)[order]).all()


def test_targets_hold_until_a_queue_runs_dry():
    schedule = packing.Schedule([100_000, 100_000], [3.0, 1.0], window=2048, grain=64)
    served = schedule.given(np.array([10, 20, 60]))
    assert abs(served[0] - np.array([15360, 5120])).max() <= 64
    assert abs(served[1] - np.array([30720, 10240])).max() <= 64
    assert served[2][0] > 85_000
    with pytest.raises(ValueError):
        packing.Schedule([5, 5], [1.0, 0.0])


def check(found, docs, end_id=1):
    tokenizer = load_tokenizer(PATH)
    want = sorted(
        (
            r.doc_id or -1,
            np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [end_id], "<u4").tobytes(),
        )
        for r in docs
    )
    pieces = sorted(found, key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in pieces:
        assert r.sequence_id * 2048 + r.offset == at
        at += r.length
        wide = np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()
        assert len(wide) == 4 * r.length and zlib.crc32(wide) == r.ids_crc32
    assert at == sum(len(ids) // 4 for _, ids in want)
    return pieces, want


def test_every_document_is_whole(awkward):
    pieces, want = check(packing.packed(awkward, PATH).collect(), awkward.collect())
    by_doc = {}
    for r in sorted(pieces, key=lambda r: r.start):
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, ids in want:
        if doc_id in (6, 9):
            parts = by_doc[doc_id]
            assert [p.start for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
            assert b"".join(np.frombuffer(p.ids, "<u2").astype("<u4").tobytes() for p in parts) == ids
            assert {p.doc_tokens for p in parts} == {len(ids) // 4}


def test_more_sources_than_queues(make):
    docs = make([row(k, f"word {k} " * 50, source=f"s{k % 9}") for k in range(200)])
    pieces, _ = check(packing.packed(docs, PATH, {"s1": 3.0, "s8": 1.0}, queues=4).collect(), docs.collect())
    assert {p.queue for p in pieces} == {0, 1, 2, 3}


def test_empty_table(empty):
    assert packing.packed(empty, PATH).count() == 0


def test_a_queue_that_is_seldom_served_takes_little_memory():
    totals, shares = np.full(1024, 500_000), np.full(1024, 2.0)
    totals[7], shares[7] = 100_000, 0.2
    schedule = packing.Schedule(totals, shares)
    tracemalloc.start()
    found = schedule.pieces(7, 1000, 90_000)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found[:, 1].sum() == 90_000 and peak < 200e6
    assert (np.diff(found[:, 2]) > 0).all()


def test_targets_have_queues_before_larger_sources(make):
    rows = [row(k, PROSE, source=f"s{k % 5}") for k in range(50)] + [row(99, PROSE, source="rare")]
    docs = make(rows)
    numbers = packing._queues(docs, "source", 3, {"rare": 1.0, "none": 2.0})
    assert numbers == {"rare": 1, "none": 2}
    assert len(packing._queues(docs, "source", 4, {"rare": 1.0})) == 3
    pieces, _ = check(packing.packed(docs, PATH, {"rare": 3.0, "s1": 1.0}, queues=3, power=0.5).collect(), docs.collect())
