"""Benchmark passages against a plain scan."""

import random
import re

from tests.llm.conftest import row
from tidegauge.llm import decontaminate as d

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(docs, items):
    windows = {}
    for item, text in items:
        words = WORD.findall(lowered(text))
        n = min(10, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[k : k + n]), set()).add("" if item is None else str(item))
    found = []
    for doc_id, text in docs:
        words, hit, named = WORD.findall(lowered(text)), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    named |= windows[tuple(words[k : k + n])]
        found.append((doc_id, len(words), len(hit), sorted(named)))
    return sorted(found, key=str)


def digest(frame):
    rows = frame.select("doc.doc_id", "n_words", d.hit_words().alias("n_hit"), "items").collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows), key=str)


def made(seed=1):
    deal = random.Random(seed)
    words = ["a", "B", "c1", "Été", "x_y", "don't", "日本", "z"]
    passage = lambda n: " ".join(deal.choice(words) + deal.choice(["", ".", "\n"]) for _ in range(n))
    items = [(k, passage(deal.randrange(3, 30))) for k in range(12)] + [(7, "only three words here"), (12, ""), (13, None)]
    items += [(None, "nobody named this item but it has more than ten words in all")]
    docs = [(k, passage(60)) for k in range(40)]
    docs += [(100 + k, passage(9) + " " + (items[k][1] or "") + " " + passage(9)) for k in range(15)]
    return docs + [(200, None), (201, ""), (None, items[0][1])], items


def test_equal_to_a_plain_scan_in_any_number_of_blocks(spark, make):
    docs, items = made()
    frame = make([row(*r) for r in docs])
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    want = plain(docs, items)
    assert any(n for _, _, n, _ in want) and any(not n for _, _, n, _ in want)
    assert digest(d.scanned(frame, benchmark)) == want
    assert digest(d.scanned(frame, benchmark, block_windows=20)) == want


def test_awkward_and_empty_tables(spark, awkward, empty):
    benchmark = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog while seven")], "item_id int, text string")
    found = d.scanned(awkward, benchmark).collect()
    assert len(found) == awkward.count()
    assert {r.doc.doc_id for r in found if r.spans} >= {1, 2, 9, None}
    assert d.scanned(empty, benchmark).count() == 0
    none = benchmark.limit(0)
    assert d.scanned(awkward, none).filter("size(spans) > 0").isEmpty()


def test_documents_or_spans_go(spark, make):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = make([row(1, f"Keep this. {passage.upper()}! And this."), row(2, "clean text"), row(3, None)])
    benchmark = spark.createDataFrame([(1, passage)], "item_id int, text string")
    whole = d.clean_documents(docs, benchmark)
    assert whole.columns == docs.columns and sorted(r.doc_id for r in whole.collect()) == [2, 3]
    cut = {r.doc_id: r.text for r in d.clean_documents(docs, benchmark, spans=True).collect()}
    assert cut == {1: "Keep this. ! And this.", 2: "clean text", 3: None}
