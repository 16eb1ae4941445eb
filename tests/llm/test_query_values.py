"""The values that registered queries return, against plain Python over the same table."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidegauge.llm.queries import register

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs():
    table = pd.read_parquet(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).sort_values("doc_id")
    return [(int(k), t or "") for k, t in table.itertuples(index=False)]


def answers(spark, name):
    rows = register.queries[name](spark, SF_DIR).collect()
    return {r.doc_id: r for r in rows} if name != "op5_packing" else rows


def ids_of(name, docs, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return {k: tokenizer.encode(t, add_special_tokens=False).ids + end for k, t in docs}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_records(spark, docs):
    found, start = answers(spark, "op1_token_records"), 0
    for doc_id, ids in ids_of("byte_bpe_50k.json", docs, [0]).items():
        row = found[doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_token_counts(spark, docs):
    found = answers(spark, "op7_token_counts")
    for (doc_id, text), ids in zip(docs, ids_of("byte_bpe_50k.json", docs, []).values()):
        row = found[doc_id]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), len(ids), len(ids) > 1024)


def test_packed_pieces(spark, docs):
    ids = ids_of("word_bpe_49k.json", docs, [1])
    pieces = sorted(answers(spark, "op5_packing"), key=lambda p: (p.doc_id, p.start))
    upto = Counter()
    for p in pieces:
        assert p.start == upto[p.doc_id] and p.doc_tokens == len(ids[p.doc_id]) and p.length > 0
        assert p.ids_crc32 == crc(ids[p.doc_id][p.start : p.start + p.length])
        upto[p.doc_id] += p.length
    assert upto == {k: len(v) for k, v in ids.items()}
    filled = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.get(p.sequence_id, 0)
        filled[p.sequence_id] = p.offset + p.length
    assert max(filled.values()) <= 2048
    assert sum(filled.values()) > 2048 * (len(filled) - 1)


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain_spans(text):
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    return {
        kind: [(m.start(), m.end()) for m in re.finditer(pattern, text) if good(m.group())]
        for kind, (pattern, good) in kinds.items()
    }


def test_personal_data(spark, docs):
    found = answers(spark, "op6_personal_data")
    for doc_id, text in docs:
        spans, row = plain_spans(text), found[doc_id]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [len(s) for s in spans.values()]
        joined = ",".join(f"{kind}:{a}:{b}" for kind, places in spans.items() for a, b in places)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(row.spans.split(","))


def test_base_scores_of_the_language_model(spark, docs):
    found = answers(spark, "op4_language_model")

    def tokens(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        return WORD.findall(lowered) + [None]

    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in docs}
    counts = Counter(t for k, text in docs if not held[k] for t in tokens(text))
    total, size = counts.total(), len(counts)
    for doc_id, text in docs:
        mine, row = tokens(text), found[doc_id]
        score = sum(math.log10((counts[t] + 1) / (total + size + 1)) for t in mine)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held[doc_id], len(mine), total)
        assert row.n_known == sum(counts[t] > 0 for t in mine)
        assert math.isclose(row.base_score, score, rel_tol=1e-9)


def test_languages(spark, docs):
    found = answers(spark, "op13_language_id")
    assert {k: r.held_out for k, r in found.items()} == {k: zlib.crc32(str(k).encode()) % 3 == 1 for k, _ in docs}
    assert all((r.lang_pred == "und") == (not any(map(str.isalpha, dict(docs)[k]))) for k, r in found.items())
    assert all(0 <= r.score <= 1 for r in found.values())
