"""Quality rules: base counts against plain Python, sketches, limits and verdicts."""

import re

from pyspark.sql import functions as F

from tests.llm.conftest import PROSE, row
from tidegauge.llm import quality_rules as q

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {k + i for at in windows.values() if len(at) > 1 for k in at for i in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall("[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def counts(frame):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return sorted((str(r.doc.doc_id), tuple(r[n] for n in names)) for r in frame.collect())


def test_counts(awkward, make):
    extra = make(
        [
            row(20, f"{PROSE} {PROSE} tail"),
            row(21, "a b c d e f g h " * 40),
            row(22, "# $ % & | < > * x#y"),
            row(23, "x " * 9),
            row(24, " 　 \x1c\x85 é"),
            row(25, f"{PROSE}\n{PROSE}\n \n {PROSE}"),
        ]
    )
    docs = awkward.unionByName(extra)
    want = sorted((str(r.doc_id), plain(r.text)) for r in docs.collect())
    assert counts(q.measured(docs)) == want


def test_verdicts(awkward):
    found = q.judged(awkward).collect()
    assert len(found) == awkward.count()
    kept = {r.doc.doc_id for r in found if r.kept}
    assert not kept & {3, 4, 5, 7, 8, 10}
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in found)
    assert q.kept_documents(awkward).columns == awkward.columns


def test_limits_differ_between_groups(spark):
    """On real-looking data each group's own quantiles decide, and no constant."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    docs = docs.withColumn("source", F.substring("source", 1, 4))
    values = q._values(q.measured(docs))
    limits = q.thresholds(q.sketches(values)).toPandas()
    for name in ("dup_lines", "repeats", "word_length"):
        assert limits[f"high_{name}"].nunique() > 4, name
    assert limits["low_word_length"].nunique() > 4


def test_limits_follow_each_group(make):
    texts = [f"{PROSE} and a few more {k}" for k in range(150)]
    clean = [row(k, text, source="prose") for k, text in enumerate(texts)]
    marked = [row(1000 + k, " ".join(f"{w}#" for w in text.split()), source="code") for k, text in enumerate(texts)]
    odd = [row(5000, " ".join(f"{w}#" for w in PROSE.split() + ["end", "x", "y"]), source="prose")]
    found = {r.doc.doc_id: r.kept for r in q.judged(make(clean + marked + odd)).collect()}
    assert not found.pop(5000) and all(found.values())


def test_sketches_merge(make):
    docs = [row(k, f"{PROSE} {'w' * k}", source=f"s{k % 3}") for k in range(90)]
    whole = q.sketches(q._values(q.measured(make(docs))))
    halves = q.sketches(q._values(q.measured(make(docs[:40])))).unionByName(
        q.sketches(q._values(q.measured(make(docs[40:]))))
    )
    merged = halves.groupBy("lang", "source", "metric", "bin").sum("n")
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, merged.collect()), key=str)


def test_empty_table(empty):
    assert q.judged(empty).count() == 0
