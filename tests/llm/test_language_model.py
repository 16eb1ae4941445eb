"""The language model: base scores against plain counts, proper distributions, and learning."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import row
from tidegauge.llm import language_model as m


def plain(rows):
    tokens = [((text or "").encode().lower().split() + [None], train) for text, train in rows]
    counts = Counter(w for words, train in tokens if train for w in words)
    total = sum(counts.values())
    below = math.log10(total + len(counts) + 1)
    return total, [
        (len(words), sum(w in counts for w in words), sum(math.log10(counts.get(w, 0) + 1) - below for w in words))
        for words, _ in tokens
    ]


@pytest.mark.parametrize("frequent", [5, 1 << 18])
def test_base_scores(awkward, frequent):
    docs = awkward.withColumn("train", F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False)))
    rows = docs.select("text", "train").collect()
    total, want = plain(rows)
    found = m.scored(docs, frequent).collect()
    assert {r.train_tokens for r in found} == {total}
    got = sorted((r.n_tokens, r.n_known, r.base_score) for r in found)
    assert np.allclose(got, sorted(want))
    assert all(np.isfinite(r.score) and r.score < 0 for r in found)


def test_scores_are_probabilities(make):
    """Over all words and one unseen word per bucket, one-word texts and the empty text add up."""
    words = [f"w{k}" for k in range(40)]
    deal = random.Random(1)
    docs = make([row(k, " ".join(deal.choices(words, k=12))) for k in range(60)])
    docs = docs.withColumn("train", F.lit(True))
    counts = m.word_counts(docs)
    found = m.vocabulary(counts, 20)
    noise = found.class_counts() / found.class_counts().sum()
    table = m.trained(m.prepared(docs, found), noise)
    model = m.LogBilinear(table)
    before, last = np.array([0, 3, 9]), np.array([0, 5, 1000])
    scores = model.contexts(before, last) @ model.outer[1:].T + model.bias[1:]
    share = np.exp(scores - model.log_sums(before, last)[:, None]).sum(axis=1)
    assert np.allclose(share, 1, atol=1e-4)
    sizes = np.ones(m.BUCKETS)
    head = set(found.words[: m.WORDS + 1])
    for r in counts.collect():
        if bytes(r.word) and bytes(r.word) not in head:
            sizes[m._bucket(bytes(r.word))] += r.n + 1
    assert (sizes == found.buckets).all()


def test_learns_what_follows_what(make):
    deal, rows = random.Random(2), []
    for k in range(4000):
        side = deal.choice("ab")
        rows.append(row(k, " ".join(f"{side}{deal.randrange(12)}" for _ in range(40))))
    docs = make(rows).withColumn("train", F.col("doc_id") < 3600)
    held = [r for r in m.scored(docs).collect() if not r.train]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def test_nothing_to_learn_from_and_empty_table(make, empty):
    docs = make([row(1, "a b"), row(2, None)]).withColumn("train", F.lit(False))
    found = sorted(m.scored(docs).collect(), key=lambda r: r.doc_id)
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in found] == [(3, 0, 0), (1, 0, 0)]
    assert [r.base_score for r in found] == [0, 0] and all(np.isfinite(r.score) for r in found)
    assert m.scored(empty.withColumn("train", F.lit(True))).count() == 0


def test_gradient_steps_raise_the_contrast():
    deal = np.random.default_rng(1)
    noise = np.zeros(m.CLASSES)
    noise[1:20] = 1 / 19
    trainer = m._Trainer(m.LogBilinear.initial(noise).table, noise, seed=1)
    last = deal.integers(1, 20, 4000)
    word = (last % 19) + 1
    for _ in range(30):
        trainer.step(np.zeros_like(last), last, word)
    score = trainer.model
    context = score.contexts(np.array([0]), np.array([7]))
    best = (context @ score.outer[1:20].T + score.bias[1:20]).argmax() + 1
    assert best == 8
