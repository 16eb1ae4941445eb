"""Quality rules whose thresholds follow the data: quantile sketches per language and source.

A sketch is a histogram of integer values on a fixed grid (exact below 1024, ten significant bits
above), so sketches of any two parts of the data merge by adding counts, and thresholds do not depend
on how the rows were dealt out. Each (language, source) group sets its own limits from the quantiles
of its sketch over the documents that pass the base rules; a group with few documents takes those of
its language, else those of all documents.

Built-in functions only: nothing here runs Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import SPACES, bounded, staged, text_of

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30

# Per metric its formula, the hundredths of its lower and upper quantile, and the slack: a document
# fails beyond a quantile by more than ``slack`` times the quantile's own distance from the median.
# Where that is little, a twentieth of the quantile is allowed, and one unit where the quantile is 0.
METRICS = {
    "symbols": ("n_symbols * 1000 div n_words", 1, 90, 1),
    "dup_lines": ("n_dup_lines * 1000 div greatest(n_lines, 1)", 1, 99, 1),
    "repeats": ("n_repeat_words * 1000 div n_words", 1, 99, 1),
    "word_length": ("word_chars * 100 div n_words", 10, 90, 2),
}
LEAST_DOCS = 100

_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_LINE_WORD = r"[^\x20\x09-\x0D]"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(starts: Column) -> Column:
    """Words covered by windows that begin at these ascending positions."""
    zero = F.struct(F.lit(0).alias("total"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        starts,
        zero,
        lambda a, p: F.struct(
            (a["total"] + F.least(F.lit(WINDOW), p - a["last"])).alias("total"), p.alias("last")
        ),
        lambda a: a["total"],
    )


def _repeated_starts(hashes: Column) -> Column:
    """Ascending positions whose hash occurs at another position as well."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(
        pairs,
        lambda s: F.sort_array(
            F.transform(
                F.filter(
                    s,
                    lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]),
                ),
                lambda x: x["i"],
            )
        ),
    )


def _repeat_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more, the first one included."""
    windows = F.size(words) - WINDOW + 1
    hashes = _let(
        words,
        lambda w: F.transform(
            F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, WINDOW))
        ),
    )
    repeated = _let(
        hashes,
        lambda h: F.when(
            F.size(F.array_distinct(h)) < F.size(h), _covered(_repeated_starts(h))
        ).otherwise(0),
    )
    return F.when(windows > 1, repeated).otherwise(0)


def measured(docs: DataFrame) -> DataFrame:
    """``doc`` (the row as it came) and its counts. Null texts have no words."""
    text = text_of("doc.text")
    spaced = F.translate(text, SPACES, " " * len(SPACES))
    in_words = F.length(F.translate(text, SPACES, ""))
    plain = F.length(F.translate(text, SPACES + SYMBOLS, ""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(_LINE_WORD))
    rows = docs.select(F.struct("*").alias("doc"))
    first = rows.select(
        "doc",
        F.array_remove(F.split(spaced, " ", -1), "").alias("words"),
        lines.alias("lines"),
        in_words.cast("long").alias("word_chars"),
        (in_words - plain).cast("long").alias("n_symbols"),
    )
    return first.select(
        "doc",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def _values(counts: DataFrame) -> DataFrame:
    """Adds base_failed and the integer metrics (null without words)."""
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    metrics = [
        F.expr(f"if(n_words > 0, {formula}, null)").alias(f"m_{name}")
        for name, (formula, *_) in METRICS.items()
    ]
    return counts.select("*", failed.alias("base_failed"), *metrics)


def sketches(values: DataFrame) -> DataFrame:
    """lang, source, metric, bin and n: documents per grid value, the mergeable form.

    Documents that fail the base rules go anyway and say nothing about the others.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"m_{m}").alias("v")) for m in METRICS])
    )
    rows = values.filter("NOT base_failed").select("doc.lang", "doc.source", pairs.alias("p"))
    value = F.col("p.v")
    coarse = "shiftleft(shiftright(p.v, length(bin(p.v)) - 10), length(bin(p.v)) - 10)"
    grid = F.when(value < 1024, value).otherwise(F.expr(coarse))
    return (
        rows.filter(value.isNotNull())
        .groupBy("lang", "source", F.col("p.metric").alias("metric"), grid.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _limits(merged: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: documents, and the lowest and highest value each metric may take."""
    group = [*keys, "metric"]
    upto = Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*group)
    ranked = merged.select(
        *group, "bin", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("docs")
    )

    def quantile(hundredth: int) -> Column:
        return F.min(F.when(100 * F.col("upto") >= hundredth * F.col("docs"), F.col("bin")))

    hundredths = sorted({50, *(h for _, low, high, _ in METRICS.values() for h in (low, high))})
    quantiles = ranked.groupBy(*group).agg(
        F.max("docs").alias("docs"), *[quantile(h).alias(f"q{h}") for h in hundredths]
    )
    per_key = []
    for name, (_, low, high, slack) in METRICS.items():
        here = F.col("metric") == name
        below, above = F.col("q50") - F.col(f"q{low}"), F.col(f"q{high}") - F.col("q50")
        lowest = F.col(f"q{low}") - F.greatest(slack * below, F.expr(f"q{low} div 20"), F.lit(1))
        highest = F.col(f"q{high}") + F.greatest(slack * above, F.expr(f"q{high} div 20"), F.lit(1))
        per_key.append(F.max(F.when(here, lowest)).alias(f"low_{name}"))
        per_key.append(F.max(F.when(here, highest)).alias(f"high_{name}"))
    return quantiles.groupBy(*keys).agg(F.max("docs").alias("docs"), *per_key)


def thresholds(sketch: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source and limits, each from the smallest group around it with ``least_docs``."""
    bounds = [f"{side}_{m}" for m in METRICS for side in ("low", "high")]
    own = _limits(sketch, ["lang", "source"])
    by_lang = sketch.groupBy("lang", "metric", "bin").agg(F.sum("n").alias("n"))
    overall = by_lang.groupBy("metric", "bin").agg(F.sum("n").alias("n"))
    # One row, or none without documents; it joins as literals.
    every = _limits(overall, []).first().asDict()
    joined = own.alias("o").join(
        _limits(by_lang, ["lang"]).alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang")), "left"
    )
    chosen = [
        F.when(F.col("o.docs") >= least_docs, F.col(f"o.{b}"))
        .when(F.col("l.docs") >= least_docs, F.col(f"l.{b}"))
        .otherwise(F.lit(every[b]).cast("long"))
        .alias(b)
        for b in bounds
    ]
    return joined.select(F.col("o.lang").alias("lang"), F.col("o.source").alias("source"), *chosen)


def judged(docs: DataFrame) -> DataFrame:
    """``doc``, its counts, ``base_failed`` and ``kept``.

    The counts are written once, as both the sketches and the verdicts read them. A null language or
    source is a group of its own; documents without words fail the base rules; equal rows get equal
    verdicts; an empty table gives an empty result. ``docs`` needs text, lang and source.
    """
    values = _values(staged(measured(docs), "quality"))
    limits = bounded(staged(thresholds(sketches(values)), "limits"), 100_000)
    same = F.col("doc.lang").eqNullSafe(F.col("lang")) & F.col("doc.source").eqNullSafe(F.col("source"))
    joined = values.join(limits, same, "left")
    within = F.lit(True)
    for name in METRICS:
        within &= F.col(f"m_{name}").between(F.col(f"low_{name}"), F.col(f"high_{name}"))
    kept = ~F.col("base_failed") & F.coalesce(within, F.lit(False))
    return joined.select("doc", *_STATS, "base_failed", kept.alias("kept"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    return judged(docs).filter("kept").select("doc.*")
