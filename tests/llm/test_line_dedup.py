"""Repeated lines: the edit join and its verification against plain edit distance."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import PROSE, row
from tidegauge.llm import line_dedup as d


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def edited(deal, text, n, letters="abc é"):
    text = list(text)
    for _ in range(n):
        place, what = deal.randrange(len(text) + 1), deal.random()
        if what < 0.34 and place < len(text):
            text[place] = deal.choice(letters)
        elif what < 0.67:
            text.insert(place, deal.choice(letters))
        elif place < len(text):
            del text[place]
    return "".join(text)


@pytest.mark.parametrize("edits", [1, 2])
def test_verification(spark, edits):
    deal, pairs = random.Random(3), []
    for _ in range(400):
        a = "".join(deal.choice("ab cé") for _ in range(deal.randrange(40)))
        pairs.append((a, edited(deal, a, deal.randrange(5))))
    pairs += [("", ""), ("a", ""), ("", "ab"), ("x y z", "x z"), ("ab", "ba"), ("abc", "")]
    frame = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "i int, of_a string, of_b string")
    found = {r.i for r in d.verified(frame.repartition(3), edits).collect()}
    assert found == {k for k, (a, b) in enumerate(pairs) if distance(a, b) <= edits}


@pytest.mark.parametrize("edits", [1, 2])
def test_join_finds_every_link(spark, edits):
    deal = random.Random(edits)
    bases = ["".join(deal.choice("abcd ef") for _ in range(deal.randrange(9, 40))) for _ in range(40)]
    lines = sorted({x for b in bases for x in [b, *(edited(deal, b, deal.randrange(4)) for _ in range(4))]})
    lines = [x for x in lines if len(x) >= 8]
    frame = spark.createDataFrame([(k, x, len(x)) for k, x in enumerate(lines)], "id long, line string, n int")
    found = {tuple(sorted(r)) for r in d.edit_links(frame, edits).collect()}
    want = {
        (i, j)
        for j in range(len(lines))
        for i in range(j)
        if abs(len(lines[i]) - len(lines[j])) <= edits and distance(lines[i], lines[j]) <= edits
    }
    assert len(want) > 20 and found == want


LINE = "a line that is long enough to be compared with others"


def test_report_and_removal(make):
    docs = make(
        [
            row(1, f"{LINE}\nfirst of its kind, and rather long as well"),
            row(2, f"before it\n{LINE}\n" + "short\n" * 18),
            row(3, f"{LINE}!"),
            row(4, f"{LINE[:-1]}Z\nand some more that nobody else says here"),
            row(5, "nothing in common with the others, whatever they say"),
            row(6, f"{LINE}\n{LINE}"),
            row(7, "short\nshort"),
            row(8, f"before it\n{LINE}\nshort"),
        ]
    )
    report = {r.doc_id: r for r in d.line_report(docs).collect()}
    assert [report[k].n_removed for k in range(1, 8)] == [0, 1, 1, 1, 0, 2, 0]
    assert [report[k].first_doc_id for k in range(1, 8)] == [1, 1, 1, 1, None, 1, None]
    assert report[3].n_links == 2 and report[7].n_lines == 0 and report[1].n_lines == 2
    left = {r.doc_id: r.text for r in d.without_repeats(docs).collect()}
    assert set(left) == {1, 2, 4, 5, 7}
    assert left[2] == "before it\n" + "short\n" * 18 and left[7] == "short\nshort"
    assert left[4] == "and some more that nobody else says here"


def test_awkward_and_empty_tables(awkward, empty):
    assert d.line_report(awkward).count() == awkward.select("doc_id").distinct().count()
    left = d.without_repeats(awkward)
    assert left.columns == awkward.columns
    ids = [r.doc_id for r in left.collect()]
    assert ids.count(None) == 2 and 2 not in ids and {3, 4, 5, 6, 8, 10, 11} <= set(ids)
    assert d.line_report(empty).count() == d.without_repeats(empty).count() == 0


def test_prose_lines_repeat_within_a_document(make):
    found = d.line_report(make([row(9, f"{PROSE}\n{PROSE}")])).first()
    assert (found.n_lines, found.n_repeated, found.n_removed, found.first_doc_id) == (2, 2, 1, 9)


def test_short_lines_repeat_exactly(make):
    docs = make([row(1, f"Les.\n{LINE}\n \nand"), row(2, "Les.\nLes!\nsome"), row(3, f"Les.\n{LINE}!")])
    report = {r.doc_id: r for r in d.line_report(docs, exact_chars=1).collect()}
    assert [report[k].n_lines for k in (1, 2, 3)] == [3, 3, 2]
    assert [report[k].n_repeated for k in (1, 2, 3)] == [2, 1, 2]
    assert [report[k].n_removed for k in (1, 2, 3)] == [0, 1, 2]
    assert [report[k].n_links for k in (1, 2, 3)] == [1, 0, 1]
    left = {r.doc_id: r.text for r in d.without_repeats(docs, least_words=1, exact_chars=1).collect()}
    assert left == {1: f"Les.\n{LINE}\n \nand", 2: "Les!\nsome"}


def test_query_counts_short_lines(spark, folder, make):
    from tidegauge.llm.queries import register

    make([row(1, "Les."), row(2, "Les.")]).write.parquet(f"{folder}/documents.parquet")
    found = {r.doc_id: r for r in register.queries["op10_line_dedup"](spark, folder).collect()}
    assert (found[1].n_lines, found[2].n_removed, found[2].first_doc_id) == (1, 1, 1)


def test_columns_with_the_names_of_helpers(make):
    docs = make([row(1, "a line that is long enough to count as one"), row(2, "a line that is long enough to count as one\nand one more line of its own, as long")])
    docs = docs.withColumns({c: F.lit("x") for c in ("_removed", "_removed_id", "removed", "id")})
    left = d.without_repeats(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text.count("\n"), r.removed) for r in left.collect()) == [(1, 0, "x"), (2, 0, "x")]
