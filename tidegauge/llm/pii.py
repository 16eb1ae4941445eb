"""Personal data: base patterns, and boosted trees over candidates that the patterns leave out.

Generators with high recall propose overlapping spans between the base ones: of each run of digits
and separators, every part from one group of digits to another that has a kind's number of digits,
and addresses with the at sign or dots spelled out. Boosted trees judge each candidate by its format
and its surroundings, and thresholds calibrated per kind pick the spans that are added.

Nothing here is labelled by hand. Positive examples are spans of the base patterns and copies of them
written another way (without a plus, with other separators, with the signs spelled out) or beside
another number; negative ones are candidates that overlap these without being the same, the
candidates of the same texts between the base spans, and dates, times, prices and plain numbers put
in the place of a base span. The sample is bounded: at most SAMPLE texts that may hold a candidate,
those with the smallest hashes, and of each text at most EXAMPLES negative and a third as many
positive examples, drawn by chance with the text as seed.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched
from random import Random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import boosting
from tidegauge.llm.common import as_batch, slices, text_of

# The kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")

SAMPLE = 5_000
EXAMPLES = 24
PRECISION = 0.98

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_GROUP = re.compile(r"[0-9]+")
_RUN = re.compile(r"[0-9](?:[0-9\x20().,/:_-]*[0-9])?")
_BETWEEN = frozenset(" ().,/:_-")
_SPELLED = re.compile(
    r"(?:[ ]?(?:@|\[at\]|\(at\))[ ]?|[ ]at[ ])[a-z0-9-]{1,63}"
    r"(?:(?:\.|[ ]?(?:\[dot\]|\(dot\))[ ]?|[ ]dot[ ])[a-z0-9-]{1,63})+",
    re.ASCII | re.IGNORECASE,
)
MOST_DIGITS = 20
_CUES = ("mail", "contact", "tel", "phone", "call", "fax", "card", "visa", "ip", "host", "server")

FEATURES = 33
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> list[Span]:
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        domain = _AT.match(text, at)
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if domain and start < at:
            found.append(("email", start, domain.end()))
            end = domain.end()
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns by kind, then start."""
    found = _emails(text)
    if _DIGIT.search(text) is None:
        return found
    for m in _IP.finditer(text):
        # Leading zeros go first: a part may be longer than Python lets a number's text be.
        parts = [part.lstrip("0") or "0" for part in m.group().split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def _parts(text: str, low: int, high: int) -> Iterator[Span]:
    """Parts of the runs of digits in ``text[low:high]``, from one group of digits to another."""
    for run in _RUN.finditer(text, low, high):
        groups = [m.span() for m in _GROUP.finditer(text, *run.span())]
        for k, (first, _) in enumerate(groups):
            digits = 0
            for start, end in groups[k:]:
                digits += end - start
                if digits > MOST_DIGITS:
                    break
                if digits < 4:
                    continue
                begin = _opened(text, first, end, low)
                if digits <= 12 and sum(c in ".,:_" for c in text[first:end]) >= 3:
                    yield ("ip", begin, end)
                if digits >= 12:
                    yield ("card", begin, end)
                if 7 <= digits <= 16:
                    yield ("phone", begin, end)


def _opened(text: str, first: int, end: int, low: int) -> int:
    """Where a part begins with the plus and the parenthesis, if closed in it, that stand before it."""
    for mark in "+(+" if text.find(")", first, end) > first else "+":
        if first > low and text[first - 1] == mark:
            first -= 1
    return first


def _proposed(text: str, base: list[Span]) -> Iterator[Span]:
    low, has_digit = 0, _DIGIT.search(text) is not None
    for start, end in [*sorted(s[1:] for s in base), (len(text), len(text))]:
        for m in _SPELLED.finditer(text, low, start):
            first = m.start()
            while first > max(low, m.start() - 64) and text[first - 1] in _LOCAL:
                first -= 1
            if first < m.start():
                yield ("email", first, m.end())
        if has_digit:
            yield from _parts(text, low, start)
        low = max(low, end)


def candidates(text: str, base: list[Span] = ()) -> list[Span]:
    """Overlapping spans between ``base`` that could be personal data, for every kind that they could be."""
    return list(_proposed(text, base))


def _joined(text: str, place: int, step: int) -> str:
    """At most three separators from ``place`` on, where a digit follows them; else nothing."""
    at = place
    while abs(at - place) < 3 and 0 <= at < len(text) and text[at] in _BETWEEN:
        at += step
    if not 0 <= at < len(text) or _DIGIT.match(text[at]) is None:
        return ""
    return text[min(at, place) : max(at, place) + 1].strip("0123456789")


def features(text: str, span: Span) -> list[float]:
    """Numbers about the format of a span and about what stands around it."""
    kind, start, end = span
    piece, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 1]
    digits = _digits(piece)
    groups = [len(g) for g in _GROUP.findall(piece)] or [0]
    marks = [c for c in piece if not c.isalnum()]
    octets = [int(g[:9]) for g in _GROUP.findall(piece)][:8] or [999]
    cue = before.lower()
    gaps = _GROUP.split(piece)[1:-1] or [""]
    joins = _joined(text, start - 1, -1), _joined(text, end, 1)
    return [
        *(float(kind == k) for k in KINDS),
        len(piece),
        len(digits),
        sum(c.isalpha() for c in piece),
        len(marks),
        len(set(marks)),
        len(groups),
        max(groups),
        min(groups),
        groups[-1],
        float(piece.startswith("+")),
        float("(" in piece),
        float("@" in piece),
        piece.count("."),
        float(luhn(digits)) if digits else 0.0,
        float(len(octets) == 4 and max(octets) <= 255),
        float(before[-1:].isalnum()),
        float(after.isalnum()),
        float(before[-1:] in "#$%&*" and before != ""),
        float(after in "#$%&*" and after != ""),
        float(sum(word in cue for word in _CUES)),
        *(len(join) for join in joins),
        *(float(join != "" and join in gaps) for join in joins),
        max(map(len, gaps)),
        piece.count(","),
        piece.count(" "),
        len(set(groups)),
        piece.count("(") - piece.count(")"),
    ]


def _rewritten(text: str, span: Span) -> list[tuple[str, Span]]:
    """The span written in other ways, within its surroundings."""
    kind, start, end = span
    piece = text[start:end]
    digits = _digits(piece)
    if kind == "email":
        local, _, domain = piece.partition("@")
        ways = [
            f"{local} at {domain.replace('.', ' dot ')}",
            f"{local} [at] {domain}",
            f"{local}(at){domain.replace('.', '(dot)')}",
            f"{local} @ {domain}",
            f"{local} AT {domain.replace('.', ' DOT ')}",
            f"{local}[At]{domain.replace('.', ' [Dot] ')}",
        ]
    elif kind == "phone":
        tail = digits[-10:]
        ways = [f"({tail[:3]}) {tail[3:6]}-{tail[6:]}", f"{tail[:3]}-{tail[3:6]}-{tail[6:]}", f"00{digits[:2]} {digits[2:]}"]
    elif kind == "card":
        ways = [sep.join(digits[i : i + 4] for i in range(0, len(digits), 4)) for sep in ".-/_ "]
    else:
        ways = [piece.replace(".", sep) for sep in (":", "_")]
    left, right = text[max(0, start - 24) : start], text[end : end + 8]
    return [(left + way + right, (kind, len(left), len(left) + len(way))) for way in ways]


def _decoys(text: str, span: Span) -> list[tuple[str, Span]]:
    """Numbers of everyday kinds, made of the span's digits, in the same surroundings."""
    _, start, end = span
    d = (_digits(text[start:end]) + "3141592653589793")[:16]
    month, day = f"{int(d[0:2]) % 12 + 1:02d}", f"{int(d[2:4]) % 28 + 1:02d}"
    clock = f"{int(d[4:6]) % 24:02d}:{int(d[6:8]) % 60:02d}"
    ways = [
        f"20{d[8:10]}-{month}-{day}",
        f"20{d[8:10]}-{month}-{day} {clock}:{int(d[10:12]) % 60:02d}",
        f"{day}.{month}.20{d[8:10]} {clock}",
        f"{day}/{month}/19{d[8:10]} - {month}/{day}/20{d[8:10]}",
        f"{d[0]},{d[1:4]},{d[4:7]}.{d[7:9]}",
        f"{d[0:2]} {d[2:5]} {d[5:8]}",
        f"{d[0]}.{d[1:3]}, {d[3:5]}.{d[5:7]}, {d[7:9]}.{d[9]}",
        f"19{d[0:2]}-20{d[2:4]}",
        f"{d[0:4]} {d[4:8]}",
        f"{d[0:3]}:{d[3:6]}, {d[6:9]}:{d[9:12]}",
        f"3.{d[:12]}",
        f"{d[0:5]}.{d[5:8]}.{d[8:11]}.{d[11]}",
        d[:8],
        d[:11],
    ]
    left, right = text[max(0, start - 24) : start], text[end : end + 8]
    return [(left + way + right, ("", len(left), len(left) + len(way))) for way in ways]


def _touches(span: Span, others: list[Span]) -> bool:
    return any(span[1] < o[2] and o[1] < span[2] for o in others)


_OTHER = str.maketrans("0123456789", "7418529630")


def _beside(text: str, span: Span) -> list[tuple[str, Span]]:
    """The span behind and before another number of its format."""
    kind, start, end = span
    if kind == "email":
        return []
    piece, left, right = text[start:end], text[max(0, start - 24) : start], text[end : end + 8]
    other = piece.translate(_OTHER)
    found = []
    for sep in (" ", ", ", " / "):
        found.append((left + other + sep + piece + right, (kind, len(left + other + sep), len(left + other + sep + piece))))
        found.append((left + piece + sep + other + right, (kind, len(left), len(left + piece))))
    return found


def _window(text: str, span: Span) -> tuple[str, Span]:
    """The span with a little text around it."""
    kind, start, end = span
    first = max(0, start - 24)
    return text[first : end + 24], (kind, start - first, end - first)


def _alone(text: str, span: Span) -> bool:
    """Whether the span would be one of the base patterns if nothing stood around it."""
    kind, start, end = span
    return (kind, 0, end - start) in base_spans(text[start:end])


def _wrong(text: str, span: Span) -> list[Span]:
    """Candidates that overlap the span and are something else, and cards that fail the check."""

    def fails(c: Span) -> bool:
        return c[0] == "card" and not luhn(_digits(text[c[1] : c[2]]))

    return [c for c in candidates(text) if c != span and (_touches(c, [span]) or fails(c))]


def examples(text: str) -> list[tuple[int, list[float]]]:
    """Labelled feature rows of a text."""
    base = base_spans(text)
    good: list[tuple[str, Span]] = []
    bad = [(text, c) for c in candidates(text, base) if not _alone(text, c)]
    for span in base:
        written = _rewritten(text, span)
        beside = [x for k, w in enumerate(written) for x in _beside(*w)[k % 3 * 2 :][:2]]
        mine = [(text, span), *written, *_beside(text, span), *beside]
        good += mine
        near = [(_window(text, span) if t is text else (t, s)) for t, s in mine]
        bad += [(t, c) for t, s in near for c in _wrong(t, s) if not _alone(t, c)]
        for decoy, place in _decoys(text, span):
            taken = [c for c in candidates(decoy) if _touches(c, [place])]
            bad += [(decoy, c) for c in taken if not luhn(_digits(decoy[c[1] : c[2]]))]
    deal = Random(zlib.crc32(text.encode("utf-8", "replace")))
    rows = []
    for label, found, most in ((1, good, EXAMPLES // 3), (0, bad, EXAMPLES)):
        chosen = found if len(found) <= most else deal.sample(found, most)
        rows += [(label, features(t, s)) for t, s in chosen]
    return rows


@dataclass
class Detector:
    """Trees, and by kind the probability from which a candidate is taken."""

    trees: boosting.BoostedTrees
    thresholds: dict[str, float]

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans: the base ones and the candidates that were taken."""
        base = base_spans(text)
        likely: list[tuple[float, Span]] = []
        for part in batched(_proposed(text, base), 4096):
            chance = self.trees.probability(np.array([features(text, c) for c in part]))
            likely += [(p, c) for p, c in zip(chance.tolist(), part) if p >= self.thresholds[c[0]]]
        if not likely:
            return base, base
        added, taken = [], bytearray(len(text))
        for _, span in sorted(likely, key=lambda x: (-x[0], x[1][1] - x[1][2])):
            _, start, end = span
            if taken.find(1, start, end) < 0:
                taken[start:end] = b"\1" * (end - start)
                added.append(span)
        order = {kind: n for n, kind in enumerate(KINDS)}
        return base, sorted(base + added, key=lambda s: (order[s[0]], s[1], s[2]))


def fit(x: np.ndarray, y: np.ndarray, precision: float = PRECISION) -> Detector:
    """Trees on four fifths of the examples; thresholds on the rest, by the precision they reach.

    A kind whose examples never reach the precision, or that has none, adds no spans.
    """
    if not len(y):
        return Detector(boosting.BoostedTrees(), {k: 2.0 for k in KINDS})
    held = np.arange(len(y)) % 5 == 0
    trees = boosting.fit(x[~held], y[~held], rounds=60, depth=4)
    chance = trees.probability(x[held])
    thresholds = {}
    for number, kind in enumerate(KINDS):
        mine = x[held][:, number] == 1
        p, label = chance[mine], y[held][mine]
        order = np.argsort(-p, kind="stable")
        hits = label[order].cumsum()
        good = hits >= precision * np.arange(1, len(hits) + 1)
        tied = np.append(p[order][1:] < p[order][:-1], True)
        reached = np.flatnonzero(good & tied)
        thresholds[kind] = max(float(p[order][reached[-1]]), 0.5) if len(reached) else 2.0
    return Detector(trees, thresholds)


def train(docs: DataFrame, sample: int = SAMPLE) -> Detector:
    """Fit on at most ``sample`` different texts that may hold a candidate or a base span.

    Hashes are chosen first, so that only texts of the sample are described and sent on.
    """
    hashed = docs.select(F.xxhash64("text").alias("h"), "text")
    may_hold = F.col("text").rlike(
        "[0-9]{2}|[0-9][.][0-9]|@|(?i:[ (\\[]dot[ )\\]]|[(\\[]at[)\\]]| at [a-z0-9-]+[.][a-z0-9])"
    )
    hashes = hashed.filter(may_hold).select("h").distinct().orderBy("h").limit(sample)
    highest = hashes.agg(F.max("h")).first()[0]
    if highest is None:
        return fit(np.zeros((0, FEATURES)), np.zeros(0))
    wanted = hashed.filter(F.col("h") <= highest).filter(may_hold).dropDuplicates(["h"])

    def labelled(batches):
        for batch in slices(batches, 256):
            rows = [examples(t) for t in batch.column(1).to_pylist()]
            flat = [np.array([v for _, v in r], np.float32).reshape(-1) for r in rows]
            yield as_batch(
                ["h", "labels", "x"],
                [
                    batch.column(0),
                    pa.array([[label for label, _ in r] for r in rows], pa.list_(pa.int8())),
                    pa.array(flat, pa.list_(pa.float32())),
                ],
            )

    found = wanted.mapInArrow(labelled, "h long, labels array<byte>, x array<float>").toArrow()
    found = found.sort_by("h")
    labels, values = (pc.list_flatten(found[n]).to_numpy() for n in ("labels", "x"))
    return fit(values.reshape(-1, FEATURES), labels.astype(np.float64))


_SPANS = "array<struct<kind:string,first:int,last:int>>"
_FOUND = f"doc_id long, base {_SPANS}, spans {_SPANS}"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))


def _structs(spans: list[Span]) -> list[dict]:
    return [{"kind": k, "first": a, "last": b} for k, a, b in spans]


def detected(docs: DataFrame, detector: Detector) -> DataFrame:
    """doc_id, base spans and all spans (kind, first, last) in code points, the end exclusive.

    Null texts are empty; repeated rows are answered one by one; other columns are ignored.
    """

    def detect(batches):
        for batch in slices(batches):
            pairs = [detector.spans(t) for t in batch.column(1).to_pylist()]
            base = pa.array([_structs(b) for b, _ in pairs], _SPAN)
            spans = pa.array([_structs(s) for _, s in pairs], _SPAN)
            yield as_batch(["doc_id", "base", "spans"], [batch.column(0), base, spans])

    wanted = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return wanted.mapInArrow(detect, _FOUND)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of spans that overlap, the first one counts."""
    out, at = [], 0
    for kind, first, last in sorted(spans, key=lambda s: (s[1], -s[2])):
        if first >= at:
            out += (text[at:first], f"<{kind}>")
            at = last
    return "".join([*out, text[at:]])
