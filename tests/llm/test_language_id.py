"""Cross-parsing against a plain search for the longest match, and accuracy on held-out texts."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import PROSE, row
from tidegauge.llm import language_id
from tidegauge.llm.queries import register

GERMAN = "der schnelle braune fuchs springt über den faulen hund während sieben zauberer mischen"
GREEK = "η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί"


def symbols_of(text, table):
    out = []
    for c in text:
        s = int(table[ord(c)])
        if s or not out or out[-1]:
            out.append(s)
    return out


def plain_phrases(text, sample, table):
    """Phrases of all blocks by looking for ever longer parts in the sample."""
    whole = bytes(symbols_of(sample, table))
    count = 0
    for start in range(0, len(text), language_id.BLOCK):
        rest = bytes(symbols_of(text[start : start + language_id.BLOCK], table))
        while rest:
            size = 1
            while size < len(rest) and rest[: size + 1] in whole:
                size += 1
            rest, count = rest[size:], count + 1
    return count


@pytest.fixture(scope="module")
def model():
    samples = [GERMAN, GREEK, PROSE * 2]
    return language_id.Model(["de", "el", "en"], samples, language_id._letters(samples))


TEXTS = [PROSE, GERMAN.upper(), GREEK, "", "x", "?!", "Ünï ﬁ İstanbul 日本", "the fuchs " * 400, " \n" * 700 + "end", "q" * 1500]


def test_phrases_equal_plain_parse(model, monkeypatch):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice(GERMAN + PROSE + "ß.") for _ in range(rng.randrange(1, 1400))) for _ in range(20)]
    parser = language_id.Parser(model)
    for chunk in (language_id.CHUNK, language_id.BLOCK):
        monkeypatch.setattr(language_id, "CHUNK", chunk)
        sizes, phrases = parser.phrases(texts)
        for k, text in enumerate(texts):
            blocks = [text[s : s + language_id.BLOCK] for s in range(0, len(text), language_id.BLOCK)]
            assert sizes[k] == sum(len(symbols_of(b, parser.symbols)) for b in blocks)
            for row_, sample in enumerate(model.samples):
                assert phrases[row_, k] == plain_phrases(text, sample, parser.symbols), (k, row_)


def test_automaton_spells_the_parts_of_its_text():
    rng = random.Random(5)
    text = [rng.randrange(3) for _ in range(60)]
    edges = language_id.suffix_automaton(text)
    parts = {tuple(text[i:j]) for i in range(60) for j in range(i + 1, min(i + 7, 61))}
    for _ in range(3000):
        part = tuple(rng.randrange(3) for _ in range(rng.randrange(1, 7)))
        state = 0
        for symbol in part:
            state = edges[state].get(symbol) if state is not None else None
        assert (state is not None) == (part in parts)


def test_costs_and_scores(model):
    parser = language_id.Parser(model)
    langs, scores, sizes, bits = parser.answers(TEXTS)
    assert langs[:4] == ["en", "de", "el", "und"] and langs[5] == "und" and scores[3] == 0.0
    assert all(0 <= s <= 1 for s in scores)
    read = len(symbols_of(GREEK, parser.symbols))
    phrases = plain_phrases(PROSE, GREEK, parser.symbols)
    assert np.isclose(bits[0][1], phrases * math.log2(read + 1) / sizes[0])


def test_awkward_and_empty_tables(awkward, empty, make):
    teaching = make([row(1, PROSE, "en"), row(2, GERMAN, "de"), row(3, None, "fr"), row(4, "?", "it"), row(5, PROSE, None)])
    model = language_id.train(teaching)
    assert model.languages == ["de", "en"]
    got = [(r.doc_id, r.lang_pred) for r in language_id.identified(awkward, model).collect()]
    want = {1: "en", 2: "en", 3: "und", 4: "und", 5: "und", 6: "en", 9: "en"}
    assert len(got) == awkward.count()
    assert all(lang == want.get(k, lang) for k, lang in got)
    assert language_id.identified(empty, model).collect() == []
    untaught = language_id.train(empty)
    assert {r.lang_pred for r in language_id.identified(awkward, untaught).collect()} == {"und"}


def test_sample_is_bounded_and_whole_where_there_is_little(make):
    long = " ".join(f"{w}{k % 97}" for k in range(20_000) for w in PROSE.split()[:3])
    model = language_id.train(make([row(1, long, "en"), row(2, GERMAN, "de")]), per_language=5_000)
    assert model.languages == ["de", "en"]
    assert model.samples[0] == GERMAN and 2_500 < len(model.samples[1]) <= 5_000


def test_held_out_texts(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = register.queries["op13_language_id"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    held = found.filter("held_out").join(docs, "doc_id")
    right = held.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held.count() > 250 and right > 0.98
