"""Spelling groups against a plain version that compares every word with every edit."""

import re
import zlib
from collections import Counter

import pandas as pd
import pytest

from tests.llm.conftest import row
from tidegauge.llm import spelling
from tidegauge.llm.queries import register

SF_DIR = "/root/testdata/sf0.01"


def plain_counts(docs, least_length=5, least_count=3, every=97):
    found = Counter()
    for doc_id, text in docs:
        name = "" if doc_id is None else str(doc_id)
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{name}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least_length and n >= least_count}


def near(word, letters):
    out = {word[:k] + word[k + 1 :] for k in range(len(word))}
    for c in letters:
        out |= {word[:k] + c + word[k:] for k in range(len(word) + 1)}
        out |= {word[:k] + c + word[k + 1 :] for k in range(len(word))}
    return out - {word}


def plain_groups(counts, times=2):
    letters = {c for w in counts for c in w}
    rows = {}
    for word, n in counts.items():
        found = [w for w in near(word, letters) if w in counts]
        best = min(found, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= times * n else None
        rows[word] = (form, n, len(found), counts.get(form))
    out = {}
    for word, (form, *rest) in rows.items():
        root = word
        while rows[root][0] is not None:
            root = rows[root][0]
        out[word] = (form, root, *rest)
    return out


def groups_of(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_query_equals_plain_version(spark):
    docs = pd.read_parquet(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"])
    want = plain_groups(plain_counts(list(docs.itertuples(index=False))))
    assert groups_of(register.queries["op11_spelling_groups"](spark, SF_DIR)) == want
    assert sum(w[0] is not None for w in want.values()) > 500
    # Chains of more than one form occur.
    assert any(w[0] is not None and w[0] != w[1] for w in want.values())


@pytest.mark.parametrize("every", [1, 97])
def test_awkward_table(awkward, every):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    got = groups_of(spelling.spelling_groups(awkward, every=every, least_count=1))
    long = {w: got.pop(w) for w in list(got) if len(w) > 1000}
    counts = plain_counts(docs, least_count=1, every=every)
    assert long == {w: (None, w, counts.pop(w), 0, None) for w in list(counts) if len(w) > 1000}
    assert long and got == plain_groups(counts)


def test_words_of_any_length(make):
    """Near words on both sides of the length from which keys are hashed."""
    words = {"ab" * 31 + "q" * k: 3 + 4 * k for k in range(6)}
    words |= {"cab" * 40 + "z" * k + "y": 3 ** (k + 1) for k in range(3)}
    words |= {"cab" * 40 + c + "y": 5 for c in "lmn"} | {"x" * 50_000: 4, "x" * 50_001: 8}
    text = " ".join(f"{w} " * n for w, n in words.items())
    got = groups_of(spelling.spelling_groups(make([row(1, text)]), every=1 << 40))
    assert got.pop("x" * 50_000) == ("x" * 50_001, "x" * 50_001, 4, 1, 8)
    assert got.pop("x" * 50_001) == (None, "x" * 50_001, 8, 1, None)
    assert got == plain_groups({w: n for w, n in words.items() if w[0] != "x"})


def test_ties_runs_of_letters_and_code_points(make):
    words = {"aabbb": 3, "aabb": 5, "aabbbb": 9, "xaabbb": 9, "aacbb": 7, "ça×vaÿ": 4, "çavaÿ": 8, "ÉCOLE": 3}
    words |= {"école": 6, "École": 3, "abcde": 3, "abcdf": 6, "abcdg": 12, "abcdefgh": 3}
    text = " ".join(f"{w}-" * n for w, n in words.items()) + " Ālong 日本語 o'clock"
    docs = [(1, text)]
    got = groups_of(spelling.spelling_groups(make([row(1, text)]), least_length=4))
    assert got == plain_groups(plain_counts(docs, least_length=4))
    assert got["aabbb"][0] == "aabbbb" and got["abcde"][:2] == ("abcdg", "abcdg")


def test_groups_go_on_over_record_batches(spark, make):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"])
    rows = list(docs.itertuples(index=False))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        frame = make([row(int(d), t) for d, t in rows[:40]])
        got = groups_of(spelling.spelling_groups(frame, least_count=1))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == plain_groups(plain_counts(rows[:40], least_count=1))


def test_empty_table(empty):
    assert spelling.spelling_groups(empty).collect() == []


def test_no_pair_is_emitted(spark):
    """A group of the whole alphabet gives a row for each word, not for each pair."""
    words = [("aaaa" + chr(c), c, 3) for c in range(0x61, 0x7B)]
    keys = spelling.rotation_keys(spark.createDataFrame(words, "word string, id long, n long")).coalesce(1)
    met = spelling.met_in_groups(keys.sortWithinPartitions("key", "n", "id")).collect()
    assert max(r.met for r in met) == 25
    assert sum(r.met == 25 for r in met) == 26
