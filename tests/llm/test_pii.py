"""Personal data: base spans against the plain patterns, the trees, and what they add."""

import random
import re

import numpy as np

from tests.llm.conftest import PROSE, row
from tidegauge.llm import boosting, pii


def plain(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_base_spans():
    deal = random.Random(5)
    for _ in range(20_000):
        text = "".join(deal.choice("a.@1 9-+()0.%b@4é") for _ in range(deal.randrange(40)))
        assert pii.base_spans(text) == plain(text)
    for text in ("4111 1111 1111 1111", "4111-1111-1111-1112", "a@b.c@d.e", "x@y", "000.0.0.00255 1.2.3.4.5.6.7.8"):
        assert pii.base_spans(text) == plain(text)


def test_long_runs_take_no_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000, "@" * 100_000, "a.b@" * 50_000):
        pii.base_spans(text)
        pii.candidates(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_trees_learn_a_rule_of_two_features():
    deal = np.random.default_rng(1)
    x = deal.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    model = boosting.fit(x[:1500], y[:1500])
    assert ((model.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    assert boosting.fit(x[:0], y[:0]).probability(x[:3]).tolist() == [0.5] * 3


def corpus():
    deal, rows = random.Random(3), []
    number = lambda n: "".join(deal.choice("0123456789") for _ in range(n))
    for k in range(300):
        digits = number(15)
        card = next(digits + c for c in "0123456789" if pii.luhn(digits + c))
        items = [
            f"joe.{number(2)}@mail{number(1)}.example.com",
            f"+1 ({number(3)}) 555-{number(4)}",
            ".".join(str(deal.randrange(256)) for _ in range(4)),
            card,
            number(16),
        ]
        words = PROSE.split()
        words.insert(deal.randrange(len(words)), deal.choice(items))
        rows.append(row(k, " ".join(words)))
    return rows


def test_adds_other_spellings_and_leaves_clean_texts_alone(make):
    docs = make(corpus())
    detector = pii.train(docs)
    added = {
        "call (017) 555-7713 now": [("phone", 5, 19)],
        "joe.12 [at] mail7.example.com": [("email", 0, 29)],
    }
    for text, spans in added.items():
        assert detector.spans(text) == ([], spans)
    for text in ("on 2024-01-02 12:30:45 it", "price 1,234,567.89 dollars", PROSE, "we met at noon. Then dot com"):
        assert detector.spans(text) == ([], [])
    found = pii.detected(docs, detector).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in found:
        base = [tuple(s) for s in r.base]
        assert base == plain(texts[r.doc_id]) and set(base) <= {tuple(s) for s in r.spans}


def test_awkward_and_empty_tables(awkward, empty):
    detector = pii.train(awkward)
    found = pii.detected(awkward, detector).collect()
    assert len(found) == awkward.count()
    spans = {r.doc_id: [s.kind for s in r.base] for r in found}
    assert spans[11] == ["email", "ip", "card", "phone"] and spans[3] == spans[4] == []
    nothing = pii.train(empty)
    assert nothing.thresholds == {k: 2.0 for k in pii.KINDS}
    assert pii.detected(empty, nothing).count() == 0
    assert nothing.spans("call (017) 555-7713 now") == ([], [])


def test_redaction():
    text = "a joe@x.org b 10.0.0.1"
    assert pii.redacted(text, pii.base_spans(text)) == "a <email> b <ip>"


def test_numbers_side_by_side():
    def parts(text):
        return {(k, text[a:b]) for k, a, b in pii.candidates(text, pii.base_spans(text))}

    cards = "7536784127813050 4845168114407329"
    assert {("card", c) for c in cards.split()} <= parts(cards)
    assert ("phone", "+1 (826) 555-4081") in parts("+1 (826) 555-4081 190.137.223.204")
    phones = ", ".join(f"212-555-01{k}" for k in range(10, 30))
    assert {("phone", p) for p in phones.split(", ")} <= parts(phones)
    assert ("email", "joe AT example DOT com") in parts("joe AT example DOT com")
    assert ("email", "joe at example.com") in parts("joe at example.com")


def test_finds_numbers_side_by_side(make):
    detector = pii.train(make(corpus()))
    for text in ("pay 7536784127813050 4845168114407329 now", "call 212-555-0143, 212-555-0199 now"):
        pieces = text.replace(",", "").split()[1:3]
        assert [text[a:b] for _, a, b in detector.spans(text)[1]] == pieces
    text = "+1 (826) 555-4081 190.137.223.204"
    assert detector.spans(text) == ([("ip", 18, 33)], [("ip", 18, 33), ("phone", 0, 17)])


def test_parts_of_addresses_may_have_any_number_of_zeros():
    text = "0" * 5000 + ".1.2.3 x " + "9" * 5000 + ".1.2.3 " + "0" * 4400 + "7.0.0.1"
    found = [text[a:b].lstrip("0") for kind, a, b in pii.base_spans(text) if kind == "ip"]
    assert found == [".1.2.3", "7.0.0.1"]
