"""Token ids of whole texts, one tokenizer call per distinct word.

Both public vocabularies split a text before any merge, and no piece crosses the space between two
words. So the ids of a text are the ids of its words in a row. Texts are cut into words and the words
numbered by Arrow, a batch at a time; a bounded cache per worker process answers most distinct words,
task after task. Words that are not cached go through the tokenizers library, and texts whose white
space makes words depend on each other go through it whole.
"""

from __future__ import annotations

import functools
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


# The unit of what a cache generation holds in each worker process, and the longest word in it.
CACHED, LONGEST = 100_000, 64


class NotSplittable(Exception):
    """The text has to be encoded whole."""


class _Cache:
    """Values by word, in two generations: when the young one is full it replaces the old one.

    Words in use are taken over from the old generation, so memory is bounded and common words stay.
    """

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def put(self, word: str, value) -> None:
        if len(word) <= LONGEST:
            if len(self.young) >= self.limit:
                self.old, self.young = self.young, {}
            self.young[word] = value

    def values(self, words: list[str], compute) -> list:
        """The value of each word, from the cache or else from ``compute``."""
        found = list(map(self.young.get, words))
        for k, value in enumerate(found):
            if value is None:
                word = words[k]
                value = self.old.get(word)
                if value is None:
                    value = compute(word)
                self.put(word, value)
                found[k] = value
        return found


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _special_strings(tokenizer) -> list[str]:
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


class SpacedWords:
    """Byte-level vocabularies: a word takes the one space before it with it.

    ``units`` cuts texts into words; a word that follows a line break carries the break instead, and
    a text is given a break in front, whose token the caller takes off again. A double space, other
    white space or a special string in a word means that the text has to be encoded whole.
    """

    def __init__(self, tokenizer):
        self.special = _special_strings(tokenizer)

    def units(self, texts: pa.Array) -> pa.ListArray:
        led = pc.binary_join_element_wise("\n", texts, "")
        return pc.split_pattern(pc.replace_substring(led, "\n", " \n"), " ")

    def plain(self, unit: str) -> str:
        body = unit[1:] if unit[:1] == "\n" else unit
        if not body or len(body.split()) != 1 or body.strip() != body:
            raise NotSplittable
        if any(s in body for s in self.special):
            raise NotSplittable
        return unit if unit[:1] == "\n" else " " + unit


class BareWords:
    """Vocabularies that drop white space: words never depend on what is between them."""

    def __init__(self, tokenizer):
        pass

    def units(self, texts: pa.Array) -> pa.ListArray:
        return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")


# A word of Latin letters (without the one whose lower case is two characters) and the marks after
# it. Both vocabularies cut it into these two pieces.
_SIMPLE = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-&(-/:-@\[-`{-~]*)")
_SIMPLE_ARROW = (
    r"^(?P<word>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"
)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies, for str.translate."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder:
    """Packed ids of texts. ``width`` bytes per id, little-endian: 2 where the vocabulary fits."""

    def __init__(self, path: str, cached_words: int = CACHED):
        self.tokenizer = load_tokenizer(path)
        self.model = self.tokenizer.model
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        self.dtype = np.dtype("<u2" if self.width == 2 else "<u4")
        self.spaced = _keeps_spaces(self.tokenizer)
        self.splitter = (SpacedWords if self.spaced else BareWords)(self.tokenizer)
        # Bare words are only cached whole where they are not a simple word and its marks.
        words, pieces = (1, 5) if self.spaced else (0.5, 3.25)
        self.words, self.pieces = _Cache(int(words * cached_words)), _Cache(int(pieces * cached_words))
        self.letters = _byte_letters()
        self.code = "H" if self.width == 2 else "I"
        self.line_break = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, unit: str) -> bytes | bool:
        """Ids of a byte-level word; False where the text has to be encoded whole."""
        after_break = unit[:1] == "\n"
        simple = _SIMPLE.fullmatch(unit, 1 if after_break else 0)
        if simple is None:
            try:
                return self.whole(self.splitter.plain(unit)) if unit else b""
            except NotSplittable:
                return False
        word, marks = simple.groups()
        if after_break:
            ids = self.line_break + self._piece(word)
        else:
            ids = self._piece(" " + word)
        return ids + self._piece(marks) if marks else ids

    def _piece(self, piece: str) -> bytes:
        pieces = self.pieces
        found = pieces.young.get(piece)
        if found is None:
            found = pieces.old.get(piece)
            if found is None:
                found = self._merged(piece)
            pieces.put(piece, found)
        return found

    def _merged(self, piece: str) -> bytes:
        shown = piece.encode("utf-8").decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def packed(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text; null counts as empty."""
        for part in _parts(pc.fill_null(texts, "")):
            yield from self._packed(part)

    def _packed(self, texts: pa.Array) -> Iterator[bytes]:
        units = self.splitter.units(texts)
        codes = units.flatten().dictionary_encode()
        code = codes.indices.to_numpy()
        edges = units.offsets.to_numpy() - units.offsets[0].as_py()
        if self.spaced:
            words = codes.dictionary.to_pylist()
            values = self.words.values(words, self.word)
            whole = self._not_splittable(words, values, code, edges)
            cells, sizes = self._cells([v or b"" for v in values])
        else:
            whole = np.zeros(len(texts), bool)
            cells, sizes = self._bare(codes.dictionary)
        width, lead = self.width, self.width if self.spaced else 0
        ids = _joined(cells, sizes, code).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes[code])])[edges] * width
        for k, (begin, end) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            if whole[k]:
                yield self.whole(texts[k].as_py())
            else:
                yield ids[begin + lead : end]

    def _cells(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each value has."""
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // self.width
        return np.frombuffer(b"".join(values), self.dtype), sizes

    def _bare(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words in a row, and how many each has.

        Arrow cuts simple words from their marks, so that only distinct pieces are looked up.
        """
        cut = pc.extract_regex(words, _SIMPLE_ARROW)
        simple = cut.is_valid()
        word, marks = cut.filter(simple).flatten()
        word, marks = pc.utf8_lower(word).dictionary_encode(), marks.dictionary_encode()
        others = words.filter(pc.invert(simple)).to_pylist()
        values = self.pieces.values(word.dictionary.to_pylist(), self._merged)
        values += self.pieces.values(marks.dictionary.to_pylist(), self._merged)
        values += self.words.values(others, self.whole)
        # Every word is two values in a row, the second of the others is empty.
        values.append(b"")
        pairs = np.full((len(words), 2), len(values) - 1, np.int64)
        is_simple = simple.to_numpy(zero_copy_only=False)
        pairs[is_simple, 0] = word.indices.to_numpy()
        pairs[is_simple, 1] = marks.indices.to_numpy() + np.int64(len(word.dictionary))
        pairs[~is_simple, 0] = np.arange(len(others)) + len(word.dictionary) + len(marks.dictionary)
        cells, sizes = self._cells(values)
        return _joined(cells, sizes, pairs.ravel()), sizes[pairs].sum(axis=1)

    def _not_splittable(self, words, values, code, edges) -> np.ndarray:
        """Texts with a word that has no ids of its own, or with empty words beyond the first."""
        bad = np.array([v is False for v in values], bool)
        count = np.concatenate([[0], np.cumsum(bad[code])])
        found = count[edges[1:]] > count[edges[:-1]]
        if self.spaced and "" in words:
            empty = np.concatenate([[0], np.cumsum(code == words.index(""))])
            found |= empty[edges[1:]] - empty[edges[:-1]] > 1
        return found

    def wide(self, packed: bytes) -> np.ndarray:
        """The ids as little-endian unsigned 32-bit integers."""
        return np.frombuffer(packed, self.dtype).astype("<u4")


def _joined(cells: np.ndarray, sizes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The cells of each value in ``code``, one value after the other."""
    starts, length = np.cumsum(sizes) - sizes, sizes[code]
    source = np.repeat(starts[code] - (np.cumsum(length) - length), length)
    return cells[source + np.arange(len(source))]


class Counter:
    """Numbers of tokens. ``frequent`` holds the lengths of common words for good."""

    def __init__(self, path: str, frequent: dict[str, int], cached_words: int = CACHED):
        self.encoder = Encoder(path, cached_words)
        if not self.encoder.spaced:
            raise ValueError("a byte-level vocabulary is needed")
        self.frequent, self.rare = frequent, _Cache(cached_words)

    def length(self, unit: str) -> int:
        """Tokens of a word, -1 where the text has to be encoded whole."""
        ids = self.encoder.word(unit)
        return -1 if ids is False else len(ids) // self.encoder.width

    def lengths(self, words: list[str]) -> list[int]:
        found = list(map(self.frequent.get, words))
        missed = [k for k, n in enumerate(found) if n is None]
        for k, n in zip(missed, self.rare.values([words[k] for k in missed], self.length)):
            found[k] = n
        return found

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; null counts as empty."""
        found = [self._counts(part) for part in _parts(pc.fill_null(texts, ""))]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def _counts(self, texts: pa.Array) -> np.ndarray:
        encoder = self.encoder
        units = encoder.splitter.units(texts)
        codes = units.flatten().dictionary_encode()
        words = codes.dictionary.to_pylist()
        sizes = np.array(self.lengths(words), np.int64)
        code = codes.indices.to_numpy()
        edges = units.offsets.to_numpy() - units.offsets[0].as_py()
        values = [n >= 0 for n in sizes.tolist()]
        whole = encoder._not_splittable(words, values, code, edges)
        total = np.concatenate([[0], np.cumsum(sizes[code])])
        found = total[edges[1:]] - total[edges[:-1]] - 1
        for k in np.flatnonzero(whole).tolist():
            found[k] = len(encoder.whole(texts[k].as_py())) // encoder.width
        return found


def _parts(texts: pa.Array, most: int = 16 << 20) -> Iterator[pa.Array]:
    """Runs of texts of at most ``most`` bytes together, or a single longer one."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    upto, begin = np.cumsum(sizes), 0
    while begin < len(texts):
        before = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, before + most, "right")))
        yield texts.slice(begin, end - begin)
        begin = end


@functools.cache
def process_encoder(path: str, cached_words: int = CACHED) -> Encoder:
    """One encoder per worker process, whose cache outlives its tasks."""
    return Encoder(path, cached_words)


def _keeps_spaces(tokenizer) -> bool:
    """Whether white space makes tokens of its own; one line break must then be one token."""
    found = len(tokenizer.encode("\n", add_special_tokens=False))
    if found > 1:
        raise ValueError("a line break must be one token")
    return found == 1
