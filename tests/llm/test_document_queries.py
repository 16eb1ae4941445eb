"""The registered queries on the smallest tables: SQL where there is any, else their contract."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.compare import differences
from tests.llm.conftest import row
from tests.llm.test_decontaminate import plain
from tests.llm.test_line_dedup import distance
from tests.llm.test_near_dup import plain_components
from tests.llm.test_packing import check
from tidegauge.llm.common import staged
from tidegauge.llm.queries import register

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in register.queries)
    assert numbers == list(range(1, 14))
    assert set(register.queries) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(register.oracles))
def test_query_equals_sql(spark, db, name):
    got = register.queries[name](spark, SF_DIR).toPandas()
    assert differences(got, db.sql(register.oracles[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(register.queries) - set(register.oracles) - {"op11_spelling_groups"}))
def test_query_answers_for_every_document(spark, db, name):
    found = register.queries[name](spark, SF_DIR)
    ids = {r.doc_id for r in found.select("doc_id").collect()}
    assert ids == {r[0] for r in db.sql("SELECT doc_id FROM documents").fetchall()}


def test_quality_scores_hold_out(spark, db):
    scores = register.queries["op2_line_crf"](spark, "/root/testdata/sf0.01").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet")
    held = scores[scores.held_out].merge(labels, on="doc_id")
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95


def test_language_model_beats_counts_on_held_out_texts(spark):
    found = register.queries["op4_language_model"](spark, "/root/testdata/sf0.01").toPandas()
    held = found[found.held_out]
    assert held.score.sum() > held.base_score.sum()


def plain_lines(db, docs):
    """Texts by document without lines of a class that occurred before, by all pairs of lines."""
    places = [
        (doc_id, k, line)
        for doc_id, text in sorted(docs.items())
        for k, line in enumerate((text or "").split("\n"))
        if len(line) >= 32 and line.split()
    ]
    texts = sorted({line for _, _, line in places})
    frame = pd.DataFrame({"id": range(len(texts)), "line": texts, "n": [len(t) for t in texts]})  # noqa: F841
    # Byte distances bound the distance in characters: two edits change eight bytes at most.
    near = db.sql(
        """SELECT a.id, b.id FROM frame a JOIN frame b ON a.id < b.id AND abs(a.n - b.n) <= 2
           AND levenshtein(a.line, b.line) <= 8"""
    ).fetchall()
    part = list(range(len(texts)))
    links = [(i, j) for i, j in near if distance(texts[i], texts[j]) <= 2]
    for _ in range(len(links)):
        before = list(part)
        for i, j in links:
            part[i] = part[j] = min(part[i], part[j])
        if part == before:
            break
    number, seen, removed = {t: k for k, t in enumerate(texts)}, set(), {}
    for doc_id, k, line in places:
        if part[number[line]] in seen:
            removed.setdefault(doc_id, set()).add(k)
        seen.add(part[number[line]])
    left = {}
    for doc_id, text in docs.items():
        if doc_id not in removed:
            left[doc_id] = text
            continue
        kept = [line for k, line in enumerate(text.split("\n")) if k not in removed[doc_id]]
        if any(len(line) >= 32 and line.split() for line in kept) or len(" ".join(kept).split()) >= 20:
            left[doc_id] = "\n".join(kept)
    return left


def test_pipeline_stages_equal_plain_versions(spark, db):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, first = docs.columns, docs.count()
    items = db.sql("SELECT item_id, text FROM benchmark").fetchall()

    def texts(frame):
        return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}

    before = came = texts(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF_DIR), "test")
        after = texts(docs)
        if name == "quality_rules":
            kept = db.sql(f"SELECT doc_id FROM ({register.oracles['op3_quality_rules']}) WHERE kept")
            want = {r[0]: before[r[0]] for r in kept.fetchall()}
        elif name == "line_dedup":
            want = plain_lines(db, before)
        elif name == "near_dedup":
            parts = plain_components(sorted((k, came[k]) for k in before))
            whole = {k: t for k, t in before.items() if parts[k][1] == k}
            parts = plain_components(sorted(whole.items()))
            want = {k: t for k, t in whole.items() if parts[k][1] == k}
        else:
            hit = {doc_id for doc_id, _, n, _ in plain(sorted(before.items()), items) if n}
            want = {k: t for k, t in before.items() if k not in hit}
        assert docs.columns == columns and after == want, name
        assert docs.filter("n_chars != length(text)").isEmpty()
        before = after
    assert 0 < len(before) < first
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    check(pieces, docs.collect())
    assert {p.doc_id for p in pieces} == set(before)


def test_near_copies_go_whole_in_the_pipeline(spark, make, tmp_path):
    """The stage before cuts the copy down to its changed lines, which must not stay as a scrap."""
    lines = [f"line {k} of the first text goes on with words {k * 7} {k * 11} {k * 13} to its end" for k in range(30)]
    changed = "\n".join(lines[:-1] + ["an ending that only the copy has, with twenty words in all or more of them " * 2])
    rows = [(1, "\n".join(lines)), (2, changed), (3, "some other document with enough words to stay " * 4)]
    docs = make([row(k, t) for k, t in rows])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    cut = staged(stages["line_dedup"](spark, docs, str(tmp_path)), "test")
    assert {r.doc_id for r in cut.collect()} == {1, 2, 3}
    left = stages["near_dedup"](spark, cut, str(tmp_path))
    assert {r.doc_id for r in left.collect()} == {1, 3} and left.columns == docs.columns
