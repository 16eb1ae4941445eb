"""Token counts against the tokenizers library."""

import public_tokenizers

from tidegauge.llm import token_counts
from tidegauge.llm.encoding import load_tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_counts(awkward):
    tokenizer = load_tokenizer(PATH)
    frequent = token_counts.frequent_lengths(awkward, PATH, size=20, per_task=10)
    assert 0 < len(frequent) <= 20
    for table in (frequent, {}):
        found = token_counts.token_counts(awkward, PATH, table).collect()
        got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in found)
        want = sorted(
            (
                r.doc_id or -1,
                len((r.text or "").encode()),
                len(tokenizer.encode(r.text or "", add_special_tokens=False).ids),
            )
            for r in awkward.collect()
        )
        assert got == want


def test_empty_table(empty):
    assert token_counts.frequent_lengths(empty, PATH) == {}
    assert token_counts.token_counts(empty, PATH, {}).count() == 0
