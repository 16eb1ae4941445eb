"""Packing of documents into fixed windows whose token mixture follows targets per source.

Every source is a queue of documents, one stream of tokens. Service goes round by round, one window's
worth of tokens a round: in each round a source's deficit grows by its share of the window, it is
served as many grains of GRAIN tokens as the deficit holds, and the rest is carried on. The order of
service is cut into windows of exactly the window's size, so only the last window has padding.

The deficit after any number of rounds has a closed form, so a task knows the state of every queue at
the rounds its documents fall into: documents are placed where they are read, deficits carry over
windows and partitions, and only token totals per partition and queue meet in one place.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import as_batch, slices, staged, text_of
from tidegauge.llm.encoding import CACHED, Encoder, process_encoder

WINDOW = 2048
GRAIN = 64
QUEUES = 1024
#: Entries of a table of rounds and queues that are held at once.
CELLS = 1 << 18

_ENCODED = "part int, queue int, doc_id long, before long, n long, ids binary"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "`offset` long, queue int, ids binary"
)


class Schedule:
    """When each queue is served. ``totals`` are tokens per queue, ``shares`` their target weights.

    A queue that runs dry leaves its share to the others in proportion to theirs, so the rates are
    constant between the moments at which queues run dry (``times``, in rounds).
    """

    def __init__(self, totals, shares=None, window: int = WINDOW, grain: int = GRAIN):
        self.totals = np.array(totals, np.int64)
        weights = np.array(self.totals if shares is None else shares, np.float64)
        if (weights[self.totals > 0] <= 0).any():
            raise ValueError("every queue that has tokens needs a share above 0")
        self.window, self.grain = window, grain
        self.phase = grain * (np.arange(len(self.totals)) + 0.5) / max(len(self.totals), 1)
        left, now = self.totals.astype(np.float64), 0.0
        times, served, rates = [0.0], [np.zeros(len(left))], []
        active = left > 0
        while active.any():
            rate = np.where(active, window * weights / weights[active].sum(), 0.0)
            until = (left[active] / rate[active]).min()
            done = active & (left <= rate * until * (1 + 1e-12))
            left = np.where(done, 0.0, left - rate * until)
            now += until
            active = active & ~done
            rates.append(rate)
            times.append(now)
            served.append(self.totals - left)
        self.times, self.served, self.rates = np.array(times), np.array(served), np.array(rates)
        self.rounds = int(np.ceil(now)) + 1

    def given(self, rounds: np.ndarray, queue: int | None = None) -> np.ndarray:
        """Tokens served to each queue (columns) before each round (rows); never falls.

        With ``queue`` the column of that one only.
        """
        rounds = np.asarray(rounds, np.int64)
        pick = slice(None) if queue is None else slice(queue, queue + 1)
        totals = self.totals[pick]
        if not len(self.rates):
            whole = np.zeros((len(rounds), len(totals)), np.int64)
        else:
            served, rates = self.served[:, pick], self.rates[:, pick]
            epoch = np.clip(np.searchsorted(self.times, rounds, "right") - 1, 0, len(rates) - 1)
            exact = served[epoch] + rates[epoch] * (rounds - self.times[epoch])[:, None]
            exact = np.minimum(exact, served[epoch + 1])
            whole = np.floor((exact + self.phase[pick]) / self.grain).astype(np.int64) * self.grain
            whole = np.minimum(whole, totals)
            whole[rounds <= 0] = 0
            whole[rounds >= self.rounds] = totals
        return whole if queue is None else whole[:, 0]

    def rounds_of(self, queue: int, tokens: np.ndarray) -> np.ndarray:
        """The rounds in which these tokens of the queue are served, all by one search in halves."""
        low = np.zeros(len(tokens), np.int64)
        high = np.full(len(tokens), self.rounds, np.int64)
        while (high - low > 1).any():
            middle = (low + high) // 2
            before = self.given(middle, queue) <= tokens
            low, high = np.where(before, middle, low), np.where(before, high, middle)
        return low

    def _ahead(self, queue: int, rounds: np.ndarray) -> np.ndarray:
        """Tokens of all queues that come before the queue's own in each round, a few rounds at a time."""
        ahead = np.zeros(len(rounds), np.int64)
        step = max(1, CELLS // max(len(self.totals), 1))
        for start in range(0, len(rounds), step):
            here = rounds[start : start + step]
            now, then = self.given(here), self.given(here + 1)[:, :queue]
            ahead[start : start + step] = now[:, queue:].sum(axis=1) + then.sum(axis=1)
        return ahead

    def pieces(self, queue: int, first: int, n: int) -> np.ndarray:
        """Rows (start, length, position) that place tokens first..first+n of a queue, in order.

        Only rounds in which the queue is served are looked at, one for each grain at most, so the
        work does not depend on how seldom that is.
        """
        if n == 0:
            return np.zeros((0, 3), np.int64)
        grains = np.arange(first // self.grain * self.grain, first + n, self.grain)
        rounds = np.unique(self.rounds_of(queue, np.maximum(grains, first)))
        mine, after = self.given(rounds, queue), self.given(rounds + 1, queue)
        low, high = np.maximum(mine, first), np.minimum(after, first + n)
        base = self._ahead(queue, rounds) - mine
        # Cut where a window ends.
        position = base + low
        cuts = (position + high - low - 1) // self.window - position // self.window
        owner = np.repeat(np.arange(len(low)), cuts + 1)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(cuts + 1) - cuts - 1, cuts + 1)
        edge = (position[owner] // self.window + step) * self.window
        begin_at = np.maximum(position[owner], edge)
        end_at = np.minimum(position[owner] + high[owner] - low[owner], edge + self.window)
        start = low[owner] + begin_at - position[owner] - first
        return np.stack([start, end_at - begin_at, begin_at], axis=1)

    def documents(self, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Rows (document, start, length, position) for documents at ``first`` in their queues.

        Documents that follow each other in a queue are placed at once and then cut apart.
        """
        order = np.lexsort((first, queue))
        follows = (queue[order][1:] == queue[order][:-1]) & (
            first[order][1:] == first[order][:-1] + n[order][:-1]
        )
        runs = np.split(order, np.flatnonzero(~follows) + 1) if len(order) else []
        placed = [np.zeros((0, 4), np.int64)]
        for run in runs:
            at = np.cumsum(n[run]) - n[run]
            whole = self.pieces(int(queue[run[0]]), int(first[run[0]]), int(n[run].sum()))
            begins = np.unique(np.concatenate([whole[:, 0], at[n[run] > 0]]))
            ends = np.append(begins[1:], n[run].sum())
            piece = np.searchsorted(whole[:, 0], begins, "right") - 1
            doc = np.searchsorted(at, begins, "right") - 1
            position = whole[piece, 2] + begins - whole[piece, 0]
            placed.append(np.stack([run[doc], begins - at[doc], ends - begins, position], axis=1))
        rows = np.concatenate(placed)
        return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def _queues(docs: DataFrame, source: str, limit: int, targets=()) -> dict[str | None, int]:
    """Queue numbers: sources that ``targets`` names, then those with most documents.

    There are ``limit`` queues, or one more than ``targets`` has names; all others share queue 0.
    """
    sizes = docs.groupBy(F.col(source).cast("string").alias("source")).count()
    leading = sizes.orderBy(F.desc("count"), "source").limit(limit - 1 + len(targets)).collect()
    named = [name for name in targets]
    others = [row.source for row in leading if row.source not in targets]
    names = named + others[: max(0, limit - 1 - len(named))]
    return {name: k for k, name in enumerate(names, 1)}


def encoded(
    docs: DataFrame,
    tokenizer_path: str,
    queues: dict[str | None, int],
    end_id: int,
    source: str,
    cached_words: int = CACHED,
) -> DataFrame:
    """Token ids per document, with its queue, part and the queue's tokens before it in the part."""

    def encode(batches):
        encoder, part = process_encoder(tokenizer_path, cached_words), TaskContext.get().partitionId()
        before: dict[int, int] = {}
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in slices(batches, 4096):
            lines = []
            for name, tokens in zip(batch.column(1).to_pylist(), encoder.packed(batch.column(2))):
                ids, queue = tokens + end, queues.get(name, 0)
                n = len(ids) // encoder.width
                lines.append((part, queue, before.get(queue, 0), n, ids))
                before[queue] = before.get(queue, 0) + n
            parts, numbers, starts, counts, packed = zip(*lines)
            yield as_batch(
                ["part", "queue", "doc_id", "before", "n", "ids"],
                [
                    pa.array(parts, pa.int32()),
                    pa.array(numbers, pa.int32()),
                    batch.column(0),
                    pa.array(starts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
            )

    wanted = docs.select(
        F.col("doc_id").cast("long"), F.col(source).cast("string").alias("source"), text_of().alias("text")
    )
    return wanted.mapInArrow(encode, _ENCODED)


def packed(
    docs: DataFrame,
    tokenizer_path: str,
    targets: dict[str | None, float] | None = None,
    end_id: int = 1,
    window: int = WINDOW,
    grain: int = GRAIN,
    queues: int = QUEUES,
    source: str = "source",
    power: float = 1.0,
    cached_words: int = CACHED,
) -> DataFrame:
    """One row per piece: where a stretch of a document's tokens lies in which window.

    ``targets`` are weights per source. Sources that they do not name weigh their tokens to the
    ``power``: 1 gives each its share of all tokens, less lifts small sources as long as they last.
    About ``queues`` queues exist: sources with a target have one each, then those with most documents,
    and the rest share one. Null texts are empty and still carry ``end_id``; a null source
    is a source; repeated rows are packed once each; an empty table gives no pieces. Queues hold
    documents in the order they were read. Each worker process keeps the ids of a few times
    ``cached_words`` words until it ends.
    """
    numbers = _queues(docs, source, queues, targets or {})
    table = staged(encoded(docs, tokenizer_path, numbers, end_id, source, cached_words), "encoded")
    width = Encoder(tokenizer_path, 1).width
    totals = table.groupBy("queue", "part").agg(F.sum("n").alias("tokens"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "queue", "part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")
    )
    size = len(numbers) + 1
    per_queue = {r.queue: r.tokens for r in totals.groupBy("queue").agg(F.sum("tokens").alias("tokens")).collect()}
    tokens = [per_queue.get(k, 0) for k in range(size)]
    schedule = Schedule(tokens, _weights(tokens, numbers, targets, power), window, grain)

    def place(batches):
        for batch in slices(batches, 1024):
            queue, before, n, base = (batch.column(i).to_numpy() for i in (0, 2, 3, 5))
            rows = schedule.documents(queue.astype(np.int64), base + before, n)
            doc, start, length, position = rows.T
            # Documents are stored whole and in order, so their pieces in order are the same bytes.
            raw = b"".join(batch.column(4).to_pylist())
            wide = memoryview(np.frombuffer(raw, "<u2" if width == 2 else "<u4").astype("<u4")).cast("B")
            edges = np.concatenate([[0], np.cumsum(length)])
            spans = zip((4 * edges[:-1]).tolist(), (4 * edges[1:]).tolist())
            checks = [zlib.crc32(wide[a:b]) for a, b in spans]
            offsets = pa.py_buffer((edges * width).astype(np.int64).tobytes())
            ids = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, offsets, pa.py_buffer(raw)])
            take = pa.array(doc)
            yield as_batch(
                [part.split()[0].strip("`") for part in _PIECES.split(", ")],
                [
                    batch.column(1).take(take),
                    pa.array(start),
                    pa.array(length),
                    pa.array(checks, pa.int64()),
                    batch.column(3).take(take),
                    pa.array(position // window),
                    pa.array(position % window),
                    batch.column(0).take(take),
                    ids.cast(pa.binary()),
                ],
            )

    located = table.join(bases, ["queue", "part"]).select("queue", "doc_id", "before", "n", "ids", "base")
    return located.mapInArrow(place, _PIECES)


def _weights(tokens, numbers, targets, power: float = 1.0) -> list[float]:
    raised = [float(t) ** power if t else 0.0 for t in tokens]
    whole = sum(raised) or 1.0
    weights = [r / whole for r in raised]
    given = float(sum((targets or {}).values()))
    for name, weight in (targets or {}).items():
        weights[numbers[name]] = weight / given
    return weights
