"""Near duplicates against exact Jaccard over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import PROSE, row
from tidegauge.llm import near_dup
from tidegauge.llm.components import components


def plain_sets(rows):
    found = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        if len(words) < 5:
            found.append({tuple(words)} if words else set())
        else:
            found.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    return found


def plain_components(rows):
    sets, parent = plain_sets(rows), list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    smallest = {}
    for k, (doc_id, _) in enumerate(rows):
        smallest[root(k)] = min(smallest.get(root(k), doc_id), doc_id)
    return {rows[k][0]: (len(sets[k]), smallest[root(k)]) for k in range(len(rows))}


def copies(deal, base, n, edits):
    for _ in range(n):
        words = base.split()
        for _ in range(deal.randrange(edits)):
            words[deal.randrange(len(words))] = f"w{deal.randrange(60)}"
        yield " ".join(words)


def test_components_equal_all_pairs(make):
    deal = random.Random(2)
    vocabulary = [f"v{k}" for k in range(300)]
    texts = [" ".join(deal.choices(vocabulary, k=deal.randrange(0, 90))) for _ in range(120)]
    for size, n, edits in ((150, 160, 6), (60, 40, 3), (40, 30, 2)):
        texts += copies(deal, " ".join(deal.choices(vocabulary, k=size)), n, edits)
    deal.shuffle(texts)
    rows = [(1000 - 2 * k, text) for k, text in enumerate(texts)]
    found = near_dup.near_duplicates(make([row(*r) for r in rows])).collect()
    want = plain_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_awkward_rows(awkward):
    found = near_dup.near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[1].component_id == by_id[2].component_id == 1 and not by_id[2].kept
    assert by_id[3].n_shingles == by_id[4].n_shingles == by_id[5].n_shingles == 0
    assert all(by_id[k].kept and by_id[k].component_id == k for k in (3, 4, 5, 6, 10))
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)


def test_deduplicated_keeps_columns_and_unnamed_rows(awkward):
    kept = near_dup.deduplicated(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 2 not in ids and ids.count(None) == 2 and {3, 4, 5, 10} <= set(ids)


def test_empty_table(empty):
    assert near_dup.near_duplicates(empty).count() == 0


def test_signature_coordinates_are_shifts_of_one_permutation():
    c = near_dup.Circulant(coordinates=6, circle=64)
    one = c.signature(np.array([5], np.uint64))
    place = int(c.scatter[5])
    assert one.tolist() == [int(c.shifted[(place + k) % 64][0]) for k in range(6)]
    both = c.signature(np.array([5, 9], np.uint64))
    assert both.tolist() == np.minimum(one, c.signature(np.array([9], np.uint64))).tolist()


def test_signatures_estimate_similarity():
    deal, c = np.random.default_rng(1), near_dup.Circulant()
    sets = deal.integers(0, 1 << 62, 1000).astype(np.uint64)
    a, b = c.signature(sets[:900]), c.signature(sets[100:])
    assert abs((a == b).mean() - 0.8) < 0.12


def test_parity_never_differs_more_than_the_sets():
    deal = np.random.default_rng(3)
    for _ in range(50):
        sets = np.unique(deal.integers(0, 1 << 62, 300).astype(np.uint64))
        a, b = sets[: deal.integers(1, 300)], sets[deal.integers(0, 299) :]
        flips = sum(int(x).bit_count() for x in (near_dup._parity(a) ^ near_dup._parity(b)).view(np.uint64))
        assert flips <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("shape", ["chain", "star", "rings"])
def test_connected_components(spark, shape):
    links = {
        "chain": [(k, k + 1) for k in range(40)],
        "star": [(99, k) for k in range(30)],
        "rings": [(10 * r + k, 10 * r + (k + 1) % 10) for r in range(4) for k in range(10)],
    }[shape]
    deal = random.Random(5)
    names = list(range(200))
    deal.shuffle(names)
    named = [(names[a], names[b]) for a, b in links]
    found = dict(components(spark.createDataFrame(named, "a long, b long")).collect())
    parent = {k: k for pair in named for k in pair}
    for _ in parent:
        for a, b in named:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == parent


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_prose_is_not_linked_with_itself_cut_short(make):
    words = PROSE.split()
    docs = make([row(1, PROSE), row(2, " ".join(words[:10])), row(3, PROSE.upper())])
    found = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 1}


def test_texts_that_share_an_id_keep_their_links(make):
    other = " ".join(f"word{k}" for k in range(40))
    rows = [row(1, PROSE * 3), row(1, other), row(5, PROSE * 3 + " more"), row(6, other + " more")]
    found = sorted((r.doc_id, r.component_id) for r in near_dup.near_duplicates(make(rows)).collect())
    assert found == [(1, 1), (1, 1), (5, 1), (6, 1)]


def test_links_by_other_texts_and_clashing_names(make):
    docs = make([row(1, "kept scrap"), row(2, "another one"), row(3, "alone"), row(None, "alone")])
    docs = docs.withColumns({c: F.lit("x") for c in ("_dropped", "dropped", "id", "_removed", "removed", "text2")})
    texts = make([row(1, PROSE * 3), row(2, PROSE * 3 + " more"), row(9, PROSE * 3)])
    left = near_dup.deduplicated(docs, texts)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == [(0, "alone"), (1, "kept scrap"), (3, "alone")]
