"""Language of a text by cross-parsing it with labelled text of each language.

A text is read as symbols: lower-cased letters, and one symbol for each run of anything else. For each
language a suffix automaton of sampled labelled text gives the longest match at a place; a parse takes
that match as its next phrase (one symbol where nothing matches) and goes on behind it. A phrase costs
the logarithm of the length of the language's sample, so the phrases of languages with little text
compare with those of others; the language with the fewest bits per symbol wins.

Texts are parsed in blocks of ``BLOCK`` code points, each from its first symbol, so a step is the same
table lookup for all blocks of a batch and memory does not depend on the length of a text.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import as_batch, slices

BLOCK = 512
PIECE = 256
CHUNK = 4096 * BLOCK
OWN, SHARED = 80, 16
UNKNOWN = "und"

_FOUND = "doc_id long, lang_pred string, score double, n_symbols long, bits array<double>"
_FOLDED: list[np.ndarray] = []
_PARSERS: dict[str, Parser] = {}


class Model(NamedTuple):
    """Languages in order, the sampled text of each, and the letters with a symbol of their own."""

    languages: list[str]
    samples: list[str]
    letters: list[int]


def train(
    labelled: DataFrame, per_language: int = 32_768, all_languages: int = 524_288
) -> Model:
    """A model from rows of ``text`` and ``lang``; rows without either teach nothing.

    It keeps at most ``per_language`` code points of each language and ``all_languages`` in total:
    distinct pieces of ``PIECE`` code points from anywhere in the texts, chosen by hash. Only these
    come to the driver; how much text a language has is counted over all rows.
    """
    known = labelled.filter("text is not null and lang is not null").select(
        "text", F.col("lang").cast("string").alias("lang")
    )
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}
    sizes = {lang: n for lang, n in sizes.items() if n}
    if not sizes:
        return Model([], [], [])
    most = min(per_language, all_languages // len(sizes))
    share = labelled.sparkSession.createDataFrame(
        [(lang, min(1.0, 1.5 * most / n)) for lang, n in sizes.items()], "lang string, share double"
    )
    places = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int"))
    chosen = F.filter(
        places, lambda i: F.pmod(F.xxhash64("digest", i), F.lit(1 << 20)) < F.col("share") * (1 << 20)
    )
    pieces = (
        known.filter("text != ''")
        .join(F.broadcast(share), "lang")
        .withColumn("digest", F.xxhash64("text"))
        .select("lang", F.transform(chosen, lambda i: F.substring("text", i * PIECE + 1, F.lit(PIECE))).alias("p"))
        .select("lang", F.explode("p").alias("piece"))
        .distinct()
        .select("lang", "piece", F.xxhash64("piece").alias("place"))
    )
    by_language: dict[str, list[str]] = {lang: [] for lang in sizes}
    for row in sorted(pieces.collect(), key=lambda r: (r.lang, r.place, r.piece)):
        by_language[row.lang].append(row.piece)
    languages = sorted(lang for lang, found in by_language.items() if any(map(_has_letter, found)))
    samples = [" ".join(by_language[lang])[:most] for lang in languages]
    return Model(languages, samples, _letters(samples))


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _letters(samples: list[str]) -> list[int]:
    """The most frequent lower-cased letters, ties by code point."""
    alpha, lower = _folded()
    points = _code_points("".join(samples))
    counted = Counter(lower[points[alpha[points]]].tolist())
    return sorted(sorted(counted, key=lambda c: (-counted[c], c))[:OWN])


def _folded() -> tuple[np.ndarray, np.ndarray]:
    """For every code point whether it is a letter, and its lower case where that is one letter."""
    if not _FOLDED:
        points = range(0x110000)
        alpha = np.fromiter((chr(c).isalpha() for c in points), bool, 0x110000)
        lower = np.arange(0x110000, dtype=np.uint32)
        for c in np.flatnonzero(alpha).tolist():
            small = chr(c).lower()
            if len(small) == 1:
                lower[c] = ord(small)
        _FOLDED.extend((alpha, lower))
    return _FOLDED[0], _FOLDED[1]


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def symbol_table(letters: list[int]) -> np.ndarray:
    """The symbol of every code point: 0 for no letter, own ones, then some shared by script."""
    alpha, lower = _folded()
    own = np.array(letters, np.uint32)
    symbols = 1 + len(own) + (lower >> 8) % SHARED
    place = np.searchsorted(own, lower)
    mine = (place < len(own)) & (own[np.minimum(place, len(own) - 1)] == lower)
    return np.where(alpha, np.where(mine, 1 + place, symbols), 0).astype(np.uint8)


def squeezed(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols with one 0 for each run of 0 within a block, and where the blocks now start."""
    keep = symbols != 0
    keep[1:] |= symbols[:-1] != 0
    keep[starts] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    return symbols[keep], before[starts]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of each state; state 0 has read nothing. Every path spells a part of ``symbols``."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        state = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in edges[at]:
            edges[at][symbol] = state
            at = link[at]
        if at >= 0:
            there = edges[at][symbol]
            if length[there] == length[at] + 1:
                link[state] = there
            else:
                copy = len(edges)
                edges.append(dict(edges[there]))
                length.append(length[at] + 1)
                link.append(link[there])
                link[there] = link[state] = copy
                while at >= 0 and edges[at].get(symbol) == there:
                    edges[at][symbol] = copy
                    at = link[at]
        last = state
    return edges


def _steps(edges: list[dict[int, int]], width: int) -> np.ndarray:
    """For state and symbol at state * width + symbol: twice the next row's start, plus 1 where a phrase begins."""
    first = np.zeros(width, np.int32)
    for symbol, state in edges[0].items():
        first[symbol] = 2 * width * state
    table = np.tile(first + 1, len(edges))
    sizes = [len(e) for e in edges]
    froms = np.repeat(np.arange(len(edges)), sizes)
    symbols = np.fromiter((s for e in edges for s in e), np.int64, sum(sizes))
    states = np.fromiter((t for e in edges for t in e.values()), np.int64, sum(sizes))
    later = froms > 0
    table[froms[later] * width + symbols[later]] = 2 * width * states[later]
    return table


class Parser:
    """The tables of a model in a worker process."""

    def __init__(self, model: Model):
        self.languages = model.languages
        self.symbols = symbol_table(model.letters) if model.letters else None
        self.width = 1 + len(model.letters) + SHARED
        self.tables, self.costs = [], []
        for sample in model.samples:
            read, _ = squeezed(self.symbols[_code_points(sample)], np.zeros(1, np.int64))
            self.tables.append(_steps(suffix_automaton(read.tolist()), self.width))
            self.costs.append(math.log2(len(read) + 1))

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each text, and its phrases by language (row) and text."""
        sizes = np.zeros(len(texts), np.int64)
        phrases = np.zeros((len(self.tables), len(texts)), np.int64)
        for owners, joined, lengths in _chunks(texts):
            blocks = -(-lengths // BLOCK)
            begin = np.repeat(np.cumsum(lengths) - lengths, blocks)
            nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            text_of = np.repeat(owners, blocks)
            symbols, starts = squeezed(self.symbols[_code_points(joined)], begin + nth * BLOCK)
            size = np.diff(np.append(starts, len(symbols)))
            np.add.at(sizes, text_of, size)
            order = np.argsort(-size, kind="stable")
            for row, found in enumerate(self._parsed(symbols, starts[order], size[order])):
                np.add.at(phrases[row], text_of[order], found)
        return sizes, phrases

    def _parsed(self, symbols: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Phrases by language and block; blocks come longest first."""
        found = np.zeros((len(self.tables), len(starts)), np.int32)
        running = np.searchsorted(-size, -np.arange(size[0]), "left")
        columns = [symbols[starts[:k] + t].astype(np.int64) for t, k in enumerate(running.tolist())]
        for row, table in enumerate(self.tables):
            state, count = np.zeros(len(starts), np.int64), found[row]
            for column in columns:
                k = len(column)
                step = table.take(state[:k] + column)
                count[:k] += step & 1
                np.right_shift(step, 1, out=state[:k], casting="same_kind")
        return found

    def answers(self, texts: list[str | None]) -> tuple[list[str], list[float], np.ndarray, np.ndarray]:
        """Language, score, symbols and bits per symbol of each text."""
        if not self.tables:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), np.zeros(len(texts), np.int64), np.zeros((len(texts), 0))
        sizes, phrases = self.phrases([t or "" for t in texts])
        total = phrases.T * np.array(self.costs)
        best = total.argmin(axis=1)
        score = 1 / np.exp2(total.min(axis=1, keepdims=True) - total).sum(axis=1)
        named = [bool(t) and _has_letter(t) for t in texts]
        return (
            [self.languages[k] if has else UNKNOWN for k, has in zip(best.tolist(), named)],
            [s if has else 0.0 for s, has in zip(score.tolist(), named)],
            sizes,
            total / np.maximum(sizes, 1)[:, None],
        )


def _chunks(texts: list[str]) -> Iterator[tuple[np.ndarray, str, np.ndarray]]:
    """Texts joined to about ``CHUNK`` code points; longer ones are cut between blocks."""
    owners, parts, room = [], [], CHUNK
    for k, text in enumerate(texts):
        for start in range(0, len(text), CHUNK):
            part = text[start : start + CHUNK]
            if len(part) > room and parts:
                yield np.array(owners), "".join(parts), np.array([len(p) for p in parts])
                owners, parts, room = [], [], CHUNK
            owners.append(k)
            parts.append(part)
            room -= len(part)
    if parts:
        yield np.array(owners), "".join(parts), np.array([len(p) for p in parts])


def _parser(version: str, shared) -> Parser:
    """The worker process's parser for one broadcast model; it outlives tasks."""
    if version not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[version] = Parser(shared.value)
    return _PARSERS[version]


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, n_symbols and bits per symbol by the model's languages, for every row.

    Texts that are null, empty or without a letter are ``und`` with score 0, and so is everything
    under a model that was taught nothing. Ties go to the language that sorts first. The score is the
    winner's share where each language weighs 2 to the minus its bits. Repeated rows are answered one
    by one; other columns are ignored. An empty table gives no rows.
    """
    shared, version = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(version, shared)
        for batch in slices(batches, 1024):
            langs, scores, sizes, bits = parser.answers(batch.column(1).to_pylist())
            flat = pa.array(bits.reshape(-1))
            ends = pa.array(np.arange(len(langs) + 1, dtype=np.int32) * bits.shape[1])
            yield as_batch(
                ["doc_id", "lang_pred", "score", "n_symbols", "bits"],
                [
                    batch.column(0),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(ends, flat),
                ],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(parsed, _FOUND)
