"""Lines that repeat, exactly or within a few edits, across and within documents.

Equal lines collapse first, from ``exact_chars`` code points on (LEAST_CHARS unless given; 1 takes every
line with a word). The edit join then cuts every distinct line of LEAST_CHARS code points or
more into EDITS + 1 segments: two lines within EDITS edits share a segment, at places that the
lengths bound (an index of segments is probed with the few substrings that can match), and their
letter counts are close, which is checked where two lines meet.
Pairs that share a segment are verified with a banded bit-parallel edit distance: one small bit
vector per diagonal band, moved over the characters that common words at both ends leave over.

Built-in functions only: nothing here runs Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import bounded, discard, staged, text_of
from tidegauge.llm.components import components

EDITS = 2
LEAST_CHARS = 32
LEAST_WORDS = 20

# Letters whose counts tell lines apart before they are compared.
LETTERS = "abcdefghijklmnopqrstuvwxyz"

_WORD = r"[^\x20\x09-\x0D]"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _eligible(line: Column, least_chars: int) -> Column:
    return (F.length(line) >= least_chars) & line.rlike(_WORD)


def occurrences(docs: DataFrame, least_chars: int) -> DataFrame:
    """doc_id, line_no (from 0), line and its digest, for every eligible line."""
    rows = docs.select(F.col("doc_id").cast("long"), F.posexplode(_lines(text_of())).alias("line_no", "line"))
    rows = rows.filter(_eligible(F.col("line"), least_chars))
    return rows.withColumn("digest", F.unhex(F.md5("line")))


def _keys(moves: list[tuple[int, int, int]], edits: int) -> Column:
    """Keys of substrings of ``line``, one for each (shorter, segment, move) in ``moves``.

    A line that is ``shorter`` by that many code points than this one is cut into edits + 1 segments
    (the last ones take the remainder); the substring lies where its segment does, moved by ``move``.
    Where it lies depends on the length's quotient and remainder by the number of segments only, so
    the places are worked out here, once per remainder.
    """
    parts, arms = edits + 1, []
    for rest in range(parts):
        # Offsets from multiples of the quotient, for any length with this remainder.
        n, places = 1000 * parts + rest, {}
        for shorter, i, move in moves:
            size, longer = divmod(n - shorter, parts)
            size -= 1000
            places[i, i * size + max(0, i - parts + longer) + move, size + (i >= parts - longer)] = None
        listed = ", ".join(f"struct({i} AS i, {a} AS a, {b} AS b)" for i, a, b in places)
        arms.append(f"WHEN {rest} THEN array({listed})")
    start, size = f"t.i * (n div {parts}) + t.a + 1", f"n div {parts} + t.b"
    piece = f"substring(line, cast({start} AS int), cast({size} AS int))"
    return F.expr(f"transform(CASE n % {parts} {' '.join(arms)} END, t -> xxhash64(t.i, {piece}))")


def _index(edits: int) -> Column:
    """Keys of a line's own segments."""
    return _keys([(0, i, 0) for i in range(edits + 1)], edits)


def _probes(edits: int) -> Column:
    """Keys of the substrings that can match a segment of a line that is as long or shorter.

    For the segment in which a match must exist, at most as many edits lie to its left as there are
    segments there, and the same on its right: both bound how far it can have moved.
    """
    return _keys(
        [
            (shorter, i, move)
            for shorter in range(edits + 1)
            for i in range(edits + 1)
            for move in range(max(-i, shorter - (edits - i)), min(i, shorter + (edits - i)) + 1)
        ],
        edits,
    )


def _profile() -> list[Column]:
    """How often each letter occurs in ``line``, modulo 256, in the bytes of four numbers."""
    packed = []
    for first in range(0, len(LETTERS), 7):
        value = F.lit(0).cast("long")
        for k, letter in enumerate(LETTERS[first : first + 7]):
            times = F.length("line") - F.length(F.replace("line", F.lit(letter)))
            value = value.bitwiseOR(F.shiftleft(times.cast("long").bitwiseAND(255), 8 * k))
        packed.append(value.alias(f"letters_{first // 7}"))
    return packed


def _alike(x: str, y: str, edits: int) -> Column:
    """Whether letter counts differ by two per edit at most, as an edit changes two by one or one."""
    changed = F.lit(0)
    for k in range(len(LETTERS)):
        word, place = f"letters_{k // 7}", 8 * (k % 7)
        more, less = (F.shiftright(f"{side}.{word}", place).bitwiseAND(255) for side in (x, y))
        up = (more - less).bitwiseAND(255)
        changed = changed + F.least(up, 256 - up)
    return changed <= 2 * edits


def _within(a: str, b: str, edits: int) -> str:
    """SQL: whether the character arrays ``a`` and ``b`` are within ``edits`` edits.

    Bit i of a vector stands for row j - edits + i of column j, so a vector spans the band of
    diagonals that matter and moves down one row with each column. ``vp`` and ``vn`` say where the
    distance rises or falls by one from the row above; ``score`` follows the lowest row of the band
    until it meets the last row, then stays on that.
    """
    width = 2 * edits + 1
    mask = (1 << width) - 1
    match = " + ".join(f"if(s.p[j + {i}] = s.t[j], {1 << i}, 0)" for i in range(width))
    diagonal = "((((x & v.vp) + v.vp) ^ v.vp) | x | v.vn) & " + str(mask)
    rises = f"(v.vn | (~(d | v.vp) & {mask}))"
    falls = "(d & v.vp)"
    last = f"s.m - v.j + {edits}"
    return f"""
        element_at(transform(
            array(struct(
                concat(array_repeat('', {edits}), {a}, array_repeat('', {width})) AS p,
                {b} AS t, size({a}) AS m)),
            s -> aggregate(
                transform(sequence(0, size(s.t)), j -> if(j = size(s.t), 0, {match})),
                struct({mask & ~((1 << edits) - 1)} AS vp, 0 AS vn, least({edits}, s.m) AS score, 1 AS j),
                (v, x) -> if(v.j > size(s.t), v, element_at(transform(array({diagonal}), d -> struct(
                    {falls} | (~(shiftright(d, 1) | {rises}) & {mask}) AS vp,
                    shiftright(d, 1) & {rises} AS vn,
                    if(v.j + {edits} <= s.m,
                        v.score + 1 - shiftright(d, {width - 1}),
                        v.score + (shiftright({rises}, {last}) & 1) - (shiftright({falls}, {last}) & 1)
                    ) AS score,
                    v.j + 1 AS j)), 1)),
                v -> v.score <= {edits})), 1)
    """


def verified(pairs: DataFrame, edits: int = EDITS) -> DataFrame:
    """The pairs whose lines ``of_a`` and ``of_b`` are within ``edits`` edits.

    Only what lies between the words that both lines begin and end with is compared. Words carry the
    space behind them, so what is cut off is the same text in both lines. It is one expression, as
    columns of its parts would be computed once per use.
    """

    def words(line: str) -> str:
        return f"transform(split({line}, ' ', -1), w -> concat(w, ' '))"

    shorter = "least(size(s.a), size(s.b))"
    same_first = f"array_min(filter(sequence(0, {shorter}), i -> i = {shorter} OR s.a[i] <> s.b[i]))"
    same_last = (
        f"array_min(filter(sequence(0, {shorter} - f), i -> i = {shorter} - f "
        "OR s.a[size(s.a) - 1 - i] <> s.b[size(s.b) - 1 - i]))"
    )

    def middle(side: str) -> str:
        inner = f"slice(s.{side}, f + 1, size(s.{side}) - f - l)"
        return f"array_remove(split(array_join({inner}, ''), ''), '')"

    return pairs.filter(
        F.expr(
            f"""
            element_at(transform(array(struct({words("of_a")} AS a, {words("of_b")} AS b)), s ->
                element_at(transform(array({same_first}), f ->
                    element_at(transform(array({same_last}), l ->
                        element_at(transform(array(struct({middle("a")} AS x, {middle("b")} AS y)), c ->
                            if(abs(size(c.x) - size(c.y)) <= {edits}, {_within("c.x", "c.y", edits)}, false)
                        ), 1)), 1)), 1)), 1)
            """
        )
    )


def distinct_lines(docs: DataFrame, exact_chars: int = LEAST_CHARS) -> DataFrame:
    """id, digest, line, n (code points), first occurrence and copies of every distinct line."""
    grouped = (
        occurrences(docs, exact_chars)
        .groupBy("digest")
        .agg(
            F.first("line").alias("line"),
            F.min(F.struct("doc_id", "line_no")).alias("first"),
            F.count(F.lit(1)).alias("copies"),
        )
    )
    numbered = grouped.select(
        F.monotonically_increasing_id().alias("id"), "*", F.length("line").alias("n")
    )
    return staged(numbered, "lines")


def edit_links(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """a and b, the ids of all pairs of distinct lines within ``edits`` edits.

    ``lines`` has id, line and n, its code points, which must be more than ``edits``. First the probes
    that meet any segment of another line are found, then the segments that they meet; only then do
    lines meet in pairs, and only where their letter counts are alike.
    """
    index = lines.select("id", "n", F.explode(_index(edits)).alias("key"))
    probes = lines.select("id", "n", F.explode(_probes(edits)).alias("key"))
    i, p = index.alias("i"), probes.alias("p")
    meet = (F.col("i.key") == F.col("p.key")) & _longer("p", "i", edits)
    probes = staged(p.join(i, meet, "left_semi"), "line-probes")
    index = staged(index.join(probes.select("key").distinct(), "key", "left_semi"), "line-index")
    met = staged(index.select("id").unionByName(probes.select("id")).distinct(), "line-ids")
    whole_texts = lines.join(bounded(met), "id").select("id", "line", *_profile())
    whole_texts = staged(whole_texts, "line-texts")
    letters = whole_texts.drop("line")
    i, p = index.join(letters, "id").alias("i"), probes.join(letters, "id").alias("p")
    pairs = i.join(p, meet & _alike("i", "p", edits))
    pairs = pairs.select(F.col("i.id").alias("a"), F.col("p.id").alias("b")).distinct()
    texts = whole_texts.select("id", "line")
    pairs = pairs.join(texts.toDF("a", "of_a"), "a").join(texts.toDF("b", "of_b"), "b")
    links = staged(verified(pairs, edits).select("a", "b"), "line-links")
    discard(probes, index, met, whole_texts)
    return links


def _longer(p: str, i: str, edits: int) -> Column:
    """Another line, as long as ``i`` or longer by ``edits`` at most; equal lengths meet once."""
    more = F.col(f"{p}.n") - F.col(f"{i}.n")
    once = (more > 0) | (F.col(f"{p}.id") > F.col(f"{i}.id"))
    return more.between(0, edits) & once


def repeated_lines(
    docs: DataFrame, edits: int = EDITS, least_chars: int = LEAST_CHARS, exact_chars: int | None = None
) -> DataFrame:
    """Per distinct line whose class occurs more than once: digest, class, first, copies, links.

    A class joins lines over links; ``first`` is the class's occurrence with the smallest doc_id and
    line number, ``copies`` counts all its occurrences and ``links`` the line's links to other texts.
    """
    if least_chars <= edits:
        raise ValueError(f"lines of {edits} code points or fewer cannot be cut into segments")
    lines = distinct_lines(docs, least_chars if exact_chars is None else exact_chars)
    links = edit_links(lines.filter(F.col("n") >= least_chars), edits)
    labels = components(links)
    ends = links.select(F.explode(F.array("a", "b")).alias("id"))
    counts = ends.groupBy("id").agg(F.count(F.lit(1)).alias("links"))
    classed = (
        lines.select("id", "digest", "first", "copies")
        .join(labels, "id", "left")
        .join(counts, "id", "left")
        .select(
            "digest",
            F.coalesce("component", "id").alias("class"),
            F.coalesce("links", F.lit(0)).alias("links"),
            "first",
            "copies",
        )
    )
    classed = staged(classed.filter("copies > 1 OR links > 0"), "repeated")
    discard(lines, links, labels)
    whole = classed.groupBy("class").agg(F.min("first").alias("first"), F.sum("copies").alias("copies"))
    return classed.select("digest", "class", "links").join(whole, "class")


def repeated_occurrences(
    docs: DataFrame, edits: int = EDITS, least_chars: int = LEAST_CHARS, exact_chars: int | None = None
) -> DataFrame:
    """doc_id, line_no, class, first (doc_id and line_no), copies and links of lines that repeat."""
    repeated = staged(repeated_lines(docs, edits, least_chars, exact_chars), "repeated")
    places = occurrences(docs, least_chars if exact_chars is None else exact_chars).drop("line")
    return places.join(repeated, "digest").drop("digest")


def _is_first() -> Column:
    here = F.struct("doc_id", "line_no")
    return F.col("first").eqNullSafe(here)


def line_report(
    docs: DataFrame, edits: int = EDITS, least_chars: int = LEAST_CHARS, exact_chars: int | None = None
) -> DataFrame:
    """One row per doc_id: n_lines, n_repeated, n_removed, n_links, first_doc_id.

    ``n_lines`` counts eligible lines (``exact_chars`` code points or more, with a word), ``n_repeated``
    those whose class occurs elsewhere too, ``n_removed`` those that are not their class's first
    occurrence, ``n_links`` sums links to other texts, and ``first_doc_id`` is the smallest document
    that holds a line of the same classes (null without one). Rows that share an id count as one
    document; null texts have no lines; an empty table gives an empty result.
    """
    found = repeated_occurrences(docs, edits, least_chars, exact_chars)
    per_doc = found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_repeated"),
        F.sum(F.when(_is_first(), 0).otherwise(1)).alias("n_removed"),
        F.sum("links").alias("n_links"),
        F.min("first.doc_id").alias("first_doc_id"),
    )
    least = least_chars if exact_chars is None else exact_chars
    lines = F.size(F.filter(_lines(text_of()), lambda line: _eligible(line, least)))
    every = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    every = every.agg(F.sum(lines).cast("long").alias("n_lines"))
    joined = every.alias("e").join(per_doc.alias("p"), F.col("e.doc_id").eqNullSafe(F.col("p.doc_id")), "left")
    counts = [F.coalesce(f"p.{c}", F.lit(0)).alias(c) for c in ("n_repeated", "n_removed", "n_links")]
    return joined.select("e.doc_id", "e.n_lines", *counts, "p.first_doc_id")


def without_repeats(
    docs: DataFrame,
    edits: int = EDITS,
    least_chars: int = LEAST_CHARS,
    least_words: int = LEAST_WORDS,
    exact_chars: int | None = None,
) -> DataFrame:
    """The documents without lines that occurred before, in the columns they came with.

    A line goes if it is not the first occurrence of its class. A document that loses lines goes as a
    whole when neither a line of ``least_chars`` nor ``least_words`` words are left; documents without
    repeated lines stay as they are, without words too. Rows without an id are left alone, and rows
    that share an id lose the same line numbers.
    """
    found = repeated_occurrences(docs, edits, least_chars, exact_chars).filter(~_is_first() & F.col("doc_id").isNotNull())
    removed = found.groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("line_no").alias("removed"))
    removed = bounded(staged(removed, "removed"), size=1 + F.size("removed"))
    rows = docs.select(F.struct("*").alias("doc"))
    joined = rows.join(removed, F.col("doc.doc_id").cast("long") == F.col("id"), "left")
    left = F.filter(_lines(F.col("doc.text")), lambda line, i: ~F.array_contains(F.col("removed"), i))
    text = F.when(F.col("removed").isNull(), F.col("doc.text")).otherwise(F.array_join(left, "\n"))
    cut = joined.select("doc", "removed", text.alias("text"))
    words = F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+", -1), ""))
    line_left = F.exists(_lines(F.col("text")), lambda line: _eligible(line, least_chars))
    stays = F.col("removed").isNull() | line_left | (words >= least_words)
    columns = [F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns]
    return cut.filter(stays).select(*columns)
