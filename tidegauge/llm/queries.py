"""One query per document operator, over the whole table it is meant for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import (
    decontaminate,
    language_id,
    language_model,
    line_crf,
    line_dedup,
    near_dup,
    packing,
    pii,
    quality_rules,
    ranked_search,
    records,
    spelling,
    token_counts,
)
from tidegauge.llm.common import documents, id_remainder
from tidegauge.queries.base import Registry
from tidegauge.session import scratch

register = Registry()


@register("op1_token_records")
def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all records, read back from the files that were written."""
    path = scratch(spark, "records")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    index = records.write_records(documents(spark, sf_dir), path, tokenizer)
    found = records.with_starts(records.read_digests(index, path), index)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "row")


@register("op2_line_crf")
def op2_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    known = labels.filter(~held_out).select("doc_id", F.col("quality").alias("label"))
    docs = documents(spark, sf_dir)
    scores = line_crf.scored(docs, line_crf.train(docs, known))
    predicted = (F.col("score") >= 0.3).cast("int")
    return scores.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


_METRICS_SQL = {
    "symbols": ("n_symbols * 1000 // n_words", 1, 90, 1),
    "dup_lines": ("n_dup_lines * 1000 // greatest(n_lines, 1)", 1, 99, 1),
    "repeats": ("n_repeat_words * 1000 // n_words", 1, 99, 1),
    "word_length": ("word_chars * 100 // n_words", 10, 90, 2),
}


def _quality_sql() -> str:
    rows = " UNION ALL ".join(
        f"""SELECT lang, source, '{m}' AS metric, {value} AS v, {low} AS lo, {high} AS hi, {slack} AS slack
            FROM counts WHERE n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words"""
        for m, (value, low, high, slack) in _METRICS_SQL.items()
    )
    def level(name, keys):
        group = ", ".join([*keys, "metric"])
        return f"""{name} AS (
            SELECT {group}, docs, ql - greatest(slack * (qm - ql), ql // 20, 1) AS low,
                qh + greatest(slack * (qh - qm), qh // 20, 1) AS high
            FROM (
                SELECT {group}, max(docs) AS docs, max(slack) AS slack, min(bin) FILTER (100 * upto >= 50 * docs) AS qm,
                    min(bin) FILTER (100 * upto >= lo * docs) AS ql, min(bin) FILTER (100 * upto >= hi * docs) AS qh
                FROM (SELECT {group}, bin, lo, hi, slack,
                        count(*) OVER (PARTITION BY {group} ORDER BY bin) AS upto,
                        count(*) OVER (PARTITION BY {group}) AS docs FROM grid)
                GROUP BY {group}))"""
    return f"""
    WITH words AS (
        SELECT doc_id, lang, source, coalesce(text, '') AS t,
            regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    windows AS (
        SELECT doc_id, i, list_slice(w, i, i + 7) AS k
        FROM words, unnest(range(1, len(w) - 6)) AS r(i) WHERE len(w) >= 8),
    twice AS (
        SELECT doc_id, i FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(8) AS o(j) GROUP BY doc_id),
    lines AS (
        SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
        FROM words, unnest(string_split(t, chr(10))) AS l(line)
        WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
    counts AS (
        SELECT doc_id, lang, source, len(w)::BIGINT AS n_words,
            coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
            (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
            coalesce(lines.dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
            coalesce(lines.n, 0) AS n_lines
        FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
    grid AS (
        SELECT lang, source, metric, lo, hi, slack,
            CASE WHEN v < 1024 THEN v ELSE (v >> (length(bin(v)) - 10)) << (length(bin(v)) - 10) END AS bin
        FROM ({rows})),
    {level('own', ['lang', 'source'])},
    {level('by_lang', ['lang'])},
    {level('every', [])},
    judged AS (
        SELECT m.lang, m.source, o.metric,
            CASE WHEN o.docs >= 100 THEN o.low WHEN l.docs >= 100 THEN l.low ELSE e.low END AS low,
            CASE WHEN o.docs >= 100 THEN o.high WHEN l.docs >= 100 THEN l.high ELSE e.high END AS high
        FROM (SELECT DISTINCT lang, source FROM counts) m
        JOIN own o ON o.lang IS NOT DISTINCT FROM m.lang AND o.source IS NOT DISTINCT FROM m.source
        JOIN by_lang l ON l.lang IS NOT DISTINCT FROM m.lang AND l.metric = o.metric
        JOIN every e ON e.metric = o.metric),
    verdicts AS (
        SELECT doc_id, bool_and(v BETWEEN low AND high) AS within
        FROM (SELECT doc_id, lang, source, metric, v FROM ({rows.replace('SELECT lang', 'SELECT doc_id, lang')})) v
        JOIN judged j ON j.lang IS NOT DISTINCT FROM v.lang
            AND j.source IS NOT DISTINCT FROM v.source AND j.metric = v.metric
        GROUP BY doc_id)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND coalesce(within, false) AS kept
    FROM counts LEFT JOIN verdicts USING (doc_id)
    """


@register("op3_quality_rules", _quality_sql())
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = quality_rules.judged(documents(spark, sf_dir))
    return judged.select("doc.doc_id", *columns, "base_failed", "kept")


@register("op4_language_model")
def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    found = language_model.scored(documents(spark, sf_dir).withColumn("train", ~held_out))
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return found.select("doc_id", (~F.col("train")).alias("held_out"), *names)


@register("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weigh their tokens to the power of 0.7, so small ones come up to large ones at first."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(documents(spark, sf_dir), tokenizer, power=0.7).drop("ids")


@register("op6_personal_data")
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.detected(docs, pii.train(docs))

    def joined(column: str) -> Column:
        return F.array_join(
            F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ","
        )

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in pii.KINDS]
    digest = F.sha2(joined("base"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, joined("spans").alias("spans"))


@register("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    docs = documents(spark, sf_dir)
    frequent = token_counts.frequent_lengths(docs, tokenizer)
    counts = token_counts.token_counts(docs, tokenizer, frequent)
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


_NEAR_SQL = """
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS k
        FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i) WHERE len(w) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
        FROM shingles x JOIN shingles y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
        WHERE 100 * pairs.n >= 85 * (p.n + q.n - pairs.n)),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (
        SELECT doc_id, doc_id AS other FROM words
        UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other),
    parts AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM parts LEFT JOIN sizes USING (doc_id)
"""


@register("op8_near_duplicates", _NEAR_SQL)
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir))


_DECONTAMINATE_SQL = """
    WITH d AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
    b AS (
        SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM benchmark),
    bw AS (
        SELECT DISTINCT item_id, list_slice(w, i, i + least(10, len(w)) - 1) AS k
        FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
    sizes AS (SELECT DISTINCT len(k) AS n FROM bw),
    dw AS (
        SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS k
        FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS r(i) WHERE len(w) >= n),
    found AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (k)),
    hit AS (
        SELECT doc_id, count(DISTINCT i + j) AS n_hit
        FROM found, unnest(range(n)) AS o(j) GROUP BY doc_id),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@register("op9_decontaminate", _DECONTAMINATE_SQL)
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontaminate.scanned(documents(spark, sf_dir), benchmark)
    return found.select(
        "doc.doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@register("op10_line_dedup")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a word, and repeated, removed and linked ones, per document."""
    return line_dedup.line_report(documents(spark, sf_dir), exact_chars=1)


@register("op11_spelling_groups")
def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(documents(spark, sf_dir))


_SEARCH_SQL = """
    WITH d AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
    b AS (
        SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM benchmark),
    asked AS (SELECT item_id, term, count(*) AS q FROM b, unnest(w) AS u(term) GROUP BY ALL),
    collection AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
    held AS (
        SELECT doc_id, len(w)::BIGINT AS n, term, count(*) AS tf FROM d, unnest(w) AS u(term)
        WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weights AS (
        SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
        FROM held, collection GROUP BY term, n_docs),
    gains AS (
        SELECT doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))) AS gain
        FROM held JOIN weights USING (term), collection),
    scores AS (
        SELECT item_id, doc_id, sum(q * gain)::BIGINT AS score FROM asked JOIN gains USING (term) GROUP BY ALL)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
        FROM scores WHERE score > 0)
    WHERE rank <= 10
"""


@register("op12_ranked_search", _SEARCH_SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return ranked_search.ranked(documents(spark, sf_dir), benchmark)


@register("op13_language_id")
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), id_remainder(F.col("doc_id"), 3) == 1
    found = language_id.identified(docs, language_id.train(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
