"""Document quality from lines: a linear-chain conditional random field over good and bad lines.

A line is described by numbers about itself and about the lines before and after it. The field gives
every line its marginal probability of being good by forward and backward passes over the document's
lines; a document's quality is the mean of these, weighted by the lines' lengths and calibrated.

Only documents carry labels, so in training every line takes the label of its document. The sample
is bounded: at most SAMPLE labelled documents, those with the smallest hashes of their ids.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import as_batch, slices, text_of

SAMPLE = 6_000
EPOCHS = 60

_OWN = 13
FEATURES = 3 * _OWN
_SYMBOLS = b"#*$%&|<>"
_SAMPLED = "label int, lines array<int>, x array<float>"

# Classes of bytes: 0 others, 1 lower case, 2 upper case, 3 digit, 4 space, 5 symbol, 6 beyond ASCII.
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 6
_CLASS[list(b" \t\n\x0b\x0c\r")] = 4
_CLASS[list(_SYMBOLS)] = 5


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines per text, characters per line (bytes) and the features of all lines, text by text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    counts = np.array([r.count(b"\n") + 1 for r in raw], np.int64)
    blob = b"\n".join([*raw, b""])
    data = np.frombuffer(blob, np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = ends - starts
    kind = _CLASS[data]

    def per_line(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags, starts, dtype=np.int64)

    gap = kind == 4
    begins = ~gap
    begins[1:] &= gap[:-1]
    n_words = per_line(begins)
    lower, upper, digit = per_line(kind == 1), per_line(kind == 2), per_line(kind == 3)
    symbol, beyond, other = per_line(kind == 5), per_line(kind == 6), per_line(kind == 0)
    pipe = per_line(data == 124)
    words = blob.split()
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    line_of = np.repeat(np.arange(len(starts)), n_words)
    text_of_line = np.repeat(np.arange(len(texts)), counts)
    first = np.zeros(len(ids), bool)
    if len(ids):
        owner = text_of_line[line_of]
        first[np.unique(owner * len(numbers) + ids, return_index=True)[1]] = True
    stays = np.zeros(len(ids), bool)
    stays[1:] = (ids[1:] == ids[:-1]) & (line_of[1:] == line_of[:-1])
    known = np.bincount(line_of[~first], minlength=len(starts)) if len(ids) else np.zeros(len(starts))
    same = np.bincount(line_of[stays], minlength=len(starts)) if len(ids) else np.zeros(len(starts))
    seen: set = set()
    again = np.zeros(len(starts))
    at = 0
    for number, one in enumerate(raw):
        for line in one.split(b"\n"):
            if line:
                key = (number, line)
                again[at] = key in seen
                seen.add(key)
            at += 1
    last = data[np.maximum(ends - 1, 0)]
    n = np.maximum(n_words, 1)
    letters = np.maximum(lower + upper, 1)
    own = np.stack(
        [
            np.ones(len(starts)),
            upper / letters,
            digit / np.maximum(length, 1),
            np.minimum(symbol / n, 4),
            np.minimum(other / n, 4),
            np.minimum((length - n_words + 1) / n, 40) / 10,
            np.log1p(n_words) / 5,
            same / n,
            known / n,
            again,
            beyond / np.maximum(length, 1),
            np.minimum(pipe / n, 4),
            ((last == 46) | (last == 33) | (last == 63)) & (length > 0),
        ],
        axis=1,
    ).astype(np.float32)
    before, after = np.zeros_like(own), np.zeros_like(own)
    inner = text_of_line[1:] == text_of_line[:-1]
    before[1:][inner] = own[:-1][inner]
    after[:-1][inner] = own[1:][inner]
    return counts, length, np.concatenate([own, before, after], axis=1)


@dataclass
class LineField:
    """Weights of the log-odds that a line is good, of staying good or bad, and the calibration."""

    weights: np.ndarray
    stay: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    slope: float = 1.0
    intercept: float = 0.0

    def marginals(self, counts: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of every line, and P(both good), P(both bad) of every line and the one before."""
        odds = np.clip(((x - self.mean) / self.scale) @ self.weights, -30, 30)
        good = 1 / (1 + np.exp(-odds))
        emit = np.stack([1 - good, good], axis=1)
        chain = np.exp(np.array([[self.stay[0], 0.0], [0.0, self.stay[1]]]))
        order = np.argsort(-counts, kind="stable")
        begin = (np.cumsum(counts) - counts)[order]
        sizes = counts[order]
        forward, backward = np.empty_like(emit), np.ones_like(emit)
        for step in range(int(sizes.max(initial=0))):
            rows = begin[: np.searchsorted(-sizes, -step, "left")] + step
            value = emit[rows] if step == 0 else (forward[rows - 1] @ chain) * emit[rows]
            forward[rows] = value / value.sum(axis=1, keepdims=True)
        for step in range(int(sizes.max(initial=0)) - 2, -1, -1):
            rows = begin[: np.searchsorted(-sizes, -(step + 1), "left")] + step
            value = (backward[rows + 1] * emit[rows + 1]) @ chain.T
            backward[rows] = value / value.sum(axis=1, keepdims=True)
        both = forward * backward
        both /= both.sum(axis=1, keepdims=True)
        pair = np.zeros((len(emit), 2))
        inner = np.ones(len(emit), bool)
        inner[np.cumsum(counts)[:-1][np.cumsum(counts)[:-1] < len(emit)]] = False
        inner[:1] = False
        at = np.flatnonzero(inner)
        joint = forward[at - 1][:, :, None] * chain * (emit[at] * backward[at])[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        pair[at, 0], pair[at, 1] = joint[:, 0, 0], joint[:, 1, 1]
        return both[:, 1], pair

    def quality(self, counts: np.ndarray, length: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Mean P(good) of each text's lines, weighted by their lengths plus one."""
        good, _ = self.marginals(counts, x)
        starts = np.cumsum(counts) - counts
        weight = (length + 1).astype(np.float64)
        return np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)

    def scores(self, texts: list[str]) -> np.ndarray:
        value = np.clip(self.quality(*line_features(texts)), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(value / (1 - value)) + self.intercept)))


def fit(labels: np.ndarray, counts: np.ndarray, length: np.ndarray, x: np.ndarray, epochs: int = EPOCHS) -> LineField:
    """Maximum likelihood with a small penalty, by Adam over all lines; then Platt's calibration."""
    scale = x.std(axis=0)
    still = scale < 1e-6
    field = LineField(
        np.zeros(x.shape[1]), np.zeros(2), np.where(still, 0, x.mean(axis=0)), np.where(still, 1, scale)
    )
    target = np.repeat(labels, counts).astype(np.float64)
    inner = np.ones(len(target), bool)
    inner[np.cumsum(counts) - counts] = False
    # Each document weighs the same, whatever its number of lines, and so do both labels together.
    share = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    weight = np.repeat(share / counts, counts)
    scaled = (x - field.mean) / field.scale
    moment, square = np.zeros(x.shape[1] + 2), np.zeros(x.shape[1] + 2)
    for step in range(1, epochs + 1):
        good, pair = field.marginals(counts, x)
        gradient = np.concatenate(
            [
                scaled.T @ (weight * (target - good)) - 1e-4 * field.weights,
                [
                    (weight * (1 - target - pair[:, 0]))[inner].sum(),
                    (weight * (target - pair[:, 1]))[inner].sum(),
                ]
                - 1e-2 * field.stay,
            ]
        )
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        move = 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        field.weights = field.weights + move[:-2]
        field.stay = np.clip(field.stay + move[-2:], -4, 4)
    value = np.clip(field.quality(counts, length, x), 1e-6, 1 - 1e-6)
    field.slope, field.intercept = _platt(np.log(value / (1 - value)), labels)
    return field


def _platt(logit: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    design = np.stack([logit, np.ones_like(logit)], axis=1)
    solution = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ solution, -30, 30)))
        curve = (design * (p * (1 - p) + 1e-6)[:, None]).T @ design + 1e-3 * np.eye(2)
        solution = solution + np.linalg.solve(curve, design.T @ (labels - p) - 1e-3 * (solution - [1, 0]))
    return max(float(solution[0]), 1e-3), float(solution[1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> LineField:
    """Fit on at most ``sample`` rows of ``labels`` (doc_id, label) and their texts.

    Without labelled documents the field knows nothing and every score is one half.
    """
    known = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").dropDuplicates(["doc_id"])
    chosen = known.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(sample)

    def described(batches):
        for batch in slices(batches):
            counts, length, x = line_features(batch.column(1).to_pylist())
            ends = np.cumsum(counts)
            cut = [slice(b, e) for b, e in zip(ends - counts, ends)]
            yield as_batch(
                ["label", "lines", "x"],
                [
                    batch.column(0),
                    pa.array([length[c].astype(np.int32) for c in cut], pa.list_(pa.int32())),
                    pa.array([x[c].reshape(-1) for c in cut], pa.list_(pa.float32())),
                ],
            )

    picked = docs.select(F.col("doc_id"), text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    picked = picked.select(F.col("label").cast("int"), "text")
    rows = picked.mapInArrow(described, _SAMPLED).toArrow().sort_by([("label", "ascending")])
    if rows.num_rows == 0:
        return LineField(np.zeros(FEATURES), np.zeros(2), np.zeros(FEATURES), np.ones(FEATURES))
    lines = rows["lines"].combine_chunks()
    counts = np.diff(lines.offsets.to_numpy()).astype(np.int64)
    length = lines.values.to_numpy().astype(np.int64)
    x = rows["x"].combine_chunks().values.to_numpy().reshape(-1, FEATURES).astype(np.float64)
    return fit(rows["label"].to_numpy().astype(np.float64), counts, length, x, epochs)


def scored(docs: DataFrame, field: LineField) -> DataFrame:
    """doc_id and score (0 to 1) of every row; null and empty texts are one empty line."""

    def score(batches):
        for batch in slices(batches):
            values = field.scores(batch.column(1).to_pylist())
            yield as_batch(["doc_id", "score"], [batch.column(0), pa.array(values, pa.float64())])

    wanted = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return wanted.mapInArrow(score, "doc_id long, score double")
