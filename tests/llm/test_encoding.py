"""Encoding by words against the tokenizers library on whole texts."""

import random

import pyarrow as pa
import public_tokenizers
import pytest

from tidegauge.llm.encoding import Counter, Encoder, load_tokenizer

PARTS = (
    ["foo", "Bar", "été", "ÀÉ", "don't", "'s", "a.b", ".", "!!", "###", "$1,000", "1234", "_x_", "x²"]
    + [" ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "　", "\x1c", "​", "́"]
    + ["日本語", "Ω", "ﬁ", "é", "İstanbul", "ǅ", "ŉ", "🙂", "<|endoftext|>", "<|startoftext|>"]
)


def texts():
    deal = random.Random(4)
    made = ["".join(deal.choice(PARTS) + deal.choice(["", " ", "\n"]) for _ in range(deal.randrange(9))) for _ in range(4000)]
    return made + [t for c in map(chr, range(1, 0x600)) for t in (c, f"a{c}", f"b {c}{c} c")]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(name):
    path, made = public_tokenizers.path(name), texts()
    encoder = Encoder(path, cached_words=50)
    want = [e.ids for e in load_tokenizer(path).encode_batch(made, add_special_tokens=False)]
    got = [encoder.wide(p).tolist() for p in encoder.packed(pa.array(["cut", *made]).slice(1))]
    assert got == want


def test_counts_equal_the_library():
    path, made = public_tokenizers.path("byte_bpe_50k.json"), texts()
    counter = Counter(path, {"foo": 1}, cached_words=50)
    want = [len(e.ids) for e in load_tokenizer(path).encode_batch(made, add_special_tokens=False)]
    assert counter.counts(pa.array(made)).tolist() == want
    assert counter.counts(pa.array([None, ""], pa.string())).tolist() == [0, 0]


def test_vocabulary_without_white_space_cannot_count():
    with pytest.raises(ValueError):
        Counter(public_tokenizers.path("word_bpe_49k.json"), {})


def test_bare_words_are_cut_and_merged_once_per_piece():
    """Words that differ in case and marks only share one look-up, however small the cache is."""
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, tokenizer = Encoder(path, cached_words=1), load_tokenizer(path)
    merged = []
    encoder._merged = lambda piece, real=encoder._merged: merged.append(piece) or real(piece)
    forms = [w + m for m in ("", ",", ".") for w in ("tide", "Tide", "TIDE", "gauge", "Gauge", "wharf", "Wharf", "quay")]
    texts = [" ".join(forms), " ".join(reversed(forms)), "", None]
    got = [encoder.wide(ids).tolist() for ids in encoder.packed(pa.array(texts))]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sorted(merged) == sorted(["tide", "gauge", "wharf", "quay", "", ",", "."])


def test_every_letter_of_a_simple_bare_word():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, tokenizer = Encoder(path), load_tokenizer(path)
    texts = [form for c in range(0x21, 0x260) for form in (chr(c), f"a{chr(c)}", f"{chr(c)}b{chr(c)},", f"x{chr(c)}-y")]
    got = [encoder.wide(ids).tolist() for ids in encoder.packed(pa.array(texts))]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [encoder.wide(ids).tolist() for ids in encoder.packed(pa.array(["", None], pa.string()))] == [[], []]
