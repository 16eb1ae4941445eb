"""Ranked search against a plain loop over all documents and items."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import types as T

from tests.llm.conftest import PROSE, row
from tidegauge.llm import ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = T.StructType(
    [T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in ("item", "term", "rank", "score", "block")]
)


def terms_of(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def plain(docs, items, top=10):
    """(item_id, rank, doc_id, score); ids of equal documents are not told apart."""
    held = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    held = [(doc_id, c) for doc_id, c in held if c]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in held:
            m = 25 + (75 * c.total() * n_docs) // n_terms
            score = 0
            for t, q in Counter(terms_of(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += q * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores, key=lambda s: s[:3])[:top], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()], key=str)


def table(spark, items):
    return spark.createDataFrame([(k, t, *["x"] * 5) for k, t in items], ITEMS)


WORDS = PROSE.split()


@pytest.fixture(scope="module")
def mixed():
    """Texts over few words, so that many scores are equal."""
    return [(k * 7 % 401, " ".join(WORDS[(k * j) % len(WORDS)] for j in range(1, 2 + k % 9))) for k in range(400)]


ASKED = [
    (1, "the quick quick fox"),
    (1, "The QUICK fox; lazy-dog"),
    (None, "honey"),
    (2, None),
    (3, ""),
    (4, "absent words only"),
    (5, PROSE * 3),
    (6, "ünïcode 日本 honey"),
]


def test_equals_plain_search(spark, make, mixed):
    docs = make([row(k, t) for k, t in mixed]).repartition(5)
    got = rows_of(ranked_search.ranked(docs, table(spark, ASKED)))
    assert got == plain(mixed, ASKED)


def test_many_small_blocks_bundles_and_passes(spark, make, mixed, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_BITS", 3)
    monkeypatch.setattr(ranked_search, "BLOCK", 8)
    monkeypatch.setattr(ranked_search, "ITEMS", 2)
    docs = make([row(k, t) for k, t in mixed]).repartition(3)
    got = rows_of(ranked_search.ranked(docs, table(spark, ASKED), top=4, at_once=12))
    assert got == plain(mixed, ASKED, top=4)


def test_awkward_table(spark, awkward):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    assert rows_of(ranked_search.ranked(awkward, table(spark, ASKED))) == plain(docs, ASKED)


def test_empty_tables(spark, empty, awkward):
    assert rows_of(ranked_search.ranked(empty, table(spark, ASKED))) == []
    assert rows_of(ranked_search.ranked(awkward, table(spark, []))) == []
    assert rows_of(ranked_search.ranked(awkward, table(spark, [(1, None), (2, "?!")]))) == []


def test_long_texts_are_split_between_terms(monkeypatch):
    text = "The quick brown fox, ünïcode 日本語 and x1y2z3 " * 50
    whole = Counter(ranked_search.words_of(text))
    monkeypatch.setattr(ranked_search, "PART", 7)
    assert ranked_search.term_counts(text) == whole
