"""The line field: marginals against all labelings, learning, and odd tables."""

import itertools
import random

import numpy as np

from tests.llm.conftest import PROSE, row
from tidegauge.llm import line_crf as c


def test_marginals_equal_a_sum_over_all_labelings():
    deal = np.random.default_rng(1)
    counts = np.array([4, 1, 3, 2])
    x = deal.normal(size=(10, 5))
    field = c.LineField(deal.normal(size=5), np.array([0.7, -0.3]), np.zeros(5), np.ones(5))
    good, pair = field.marginals(counts, x)
    odds, at = x @ field.weights, 0
    for n in counts.tolist():
        total, one, both = 0.0, np.zeros(n), np.zeros((n, 2))
        for labels in itertools.product([0, 1], repeat=n):
            score = sum(odds[at + k] for k in range(n) if labels[k])
            score += sum(field.stay[a] for a, b in zip(labels, labels[1:]) if a == b)
            weight = np.exp(score)
            total += weight
            one += weight * np.array(labels)
            for k in range(1, n):
                if labels[k] == labels[k - 1]:
                    both[k, labels[k]] += weight
        assert np.allclose(good[at : at + n], one / total)
        assert np.allclose(pair[at + 1 : at + n], both[1:] / total)
        at += n


def test_features_per_line():
    counts, length, x = c.line_features(["One two\nONE # |", "", "a a a\na a a"])
    assert counts.tolist() == [2, 1, 2] and length.tolist() == [7, 7, 0, 5, 5]
    own = x[:, : c._OWN]
    assert own[1, 3] == 2 / 3 and own[1, 11] == np.float32(1 / 3)
    assert own[3, 7] == np.float32(2 / 3) and own[4, 9] == 1 and own[3, 9] == 0
    assert (x[0, c._OWN : 2 * c._OWN] == 0).all() and (x[1, c._OWN : 2 * c._OWN] == own[0]).all()
    assert (x[0, 2 * c._OWN :] == own[1]).all() and (x[1, 2 * c._OWN :] == 0).all()


def made():
    deal = random.Random(1)
    rows, labels = [], []
    for k in range(240):
        words = [deal.choice(PROSE.split()) for _ in range(60)]
        bad = k % 4 == 0
        rows.append(row(k, "\n".join(" ".join(f"{w}###" if bad else w for w in words[i : i + 12]) for i in range(0, 60, 12))))
        labels.append((k, 0 if bad else 1))
    return rows, labels


def test_learns_from_labels_it_is_given(spark, make):
    rows, labels = made()
    docs = make(rows)
    seen = spark.createDataFrame(labels[:160], "doc_id long, label int")
    field = c.train(docs, seen, sample=120, epochs=40)
    scores = {r.doc_id: r.score for r in c.scored(docs, field).collect()}
    assert all((scores[k] >= 0.3) == bool(label) for k, label in labels[160:])


def test_awkward_and_empty_tables(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (7, 0), (8, 0), (None, 1), (9, None), (3, 1)], "doc_id long, label int")
    field = c.train(awkward, labels, epochs=5)
    found = c.scored(awkward, field).collect()
    assert len(found) == awkward.count() and all(0 <= r.score <= 1 for r in found)
    same = [r.score for r in found if r.doc_id in (1, 2)]
    assert len(set(same)) == 1
    unknown = c.train(awkward, labels.limit(0))
    assert {r.score for r in c.scored(awkward, unknown).collect()} == {0.5}
    assert c.scored(empty, field).count() == 0
