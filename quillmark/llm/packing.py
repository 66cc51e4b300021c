"""Operator 8, packing: deficit round-robin over source queues fills sequences to target token proportions.

Each source is a queue of its documents' ids. In a round every queue earns its share of one sequence's tokens as
deficit, sends as many whole bursts of ``BURST`` tokens as it has earned, and carries the rest on. Rounds follow one
another without a gap and are cut into sequences, so each sequence holds the target proportions to within two bursts a
source; a source that earns less than a burst a round sends once in several rounds, so thousands of sources do not cut
documents to crumbs. When a queue runs empty the others share its part from then on.

What a queue has earned by a round follows from one number for all queues, the virtual time: tokens earned by a unit of
weight. Virtual time is linear between the times at which queues run empty, so the round of a burst is a closed form of
its place in its queue, and deficits carry across sequences and partitions exactly. Bursts are sorted by (round,
source, place) in ranges of rounds, which are even as a round is a sequence's worth of tokens, however many rows one
source has; what all queues sent before a range is again a closed form. So the plan is one row a source, and no task
waits for another. Ids are shuffled once, two bytes each where the vocabulary allows.

The remainder after the last full sequence is cut into powers of two, so that no padding is needed at all. A null or
empty text has the end id alone. A null source is a queue of its own. Sources of no weight follow after all others, in
the proportions of their tokens. Extra columns are not read. Repeated rows are packed once each.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .tokens import encoder

#: Tokens that a queue sends at once.
BURST = 64
#: Sources planned with, one row each on the driver and in every task; more are refused.
MOST_SOURCES = 1_000_000


@dataclass(frozen=True)
class Plan:
    """``tokens`` and ``weight`` of each source in order of the names; the lines between which virtual time is linear."""

    names: tuple[str | None, ...]
    tokens: np.ndarray
    weight: np.ndarray
    size: int
    burst: int
    times: np.ndarray  # virtual times at which queues run empty, from 0
    spent: np.ndarray  # tokens of all queues earned by then

    def round_of(self, end: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The round by whose end a queue of ``weight`` has earned ``end`` tokens."""
        earned = np.interp(end / weight, self.times, self.spent)
        return np.clip(np.ceil(earned / self.size).astype(np.int64) - 1, 0, max(0, self.rounds - 1))

    @property
    def rounds(self) -> int:
        return -(-int(self.tokens.sum()) // self.size)

    def sent(self, before: int) -> np.ndarray:
        """Tokens that each queue has sent before a round."""
        most = -(-self.tokens // self.burst)
        end = lambda k: np.minimum(k * self.burst, self.tokens)
        time = np.interp(float(before * self.size), self.spent, self.times)
        k = np.minimum((time * self.weight // self.burst).astype(np.int64), most)
        while True:  # a burst more or less where rounding says so
            up = (k < most) & (self.round_of(end(k + 1), self.weight) < before)
            down = (k > 0) & (self.round_of(end(k), self.weight) >= before)
            if not (up | down).any():
                return end(k)
            k += up.astype(np.int64) - down.astype(np.int64)


def plan(tokens: dict[str | None, int], weights: dict[str | None, float] | None, size: int, burst: int = BURST) -> Plan:
    """``weights``: target proportions by source, all positive; those of the corpus itself if not given."""
    names = tuple(sorted(tokens, key=lambda s: (s is not None, s or "")))
    total = np.array([tokens[s] for s in names], np.int64)
    weight = np.array([float((weights or tokens)[s]) for s in names])
    empty = total / weight
    order = np.argsort(empty, kind="stable")
    open_ = np.cumsum(weight[order][::-1])[::-1]  # of the queues not yet empty
    spent = np.cumsum(np.diff(empty[order], prepend=0.0) * open_)
    return Plan(names, total, weight, size, burst, np.concatenate([[0.0], empty[order]]), np.concatenate([[0.0], spent]))


def tails(rest: int) -> list[int]:
    """The powers of two that a remainder is cut into, largest first."""
    return [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def _ranges(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``count[i]`` items from ``first[i]``: i and the item."""
    which = np.repeat(np.arange(len(count)), count)
    return which, first[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)


def bursts(p: Plan, weight: np.ndarray, total: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of ``n[i]`` tokens from ``start[i]`` of a queue by rounds. Of each piece: its run, start within the run, length, round."""
    first = start // p.burst
    run, k = _ranges(first, (start + n - 1) // p.burst - first + 1)
    r = p.round_of(np.minimum((k + 1) * p.burst, total[run]), weight[run])
    lo, hi = np.maximum(k * p.burst, start[run]), np.minimum((k + 1) * p.burst, (start + n)[run])
    new = np.ones(len(run), bool)  # bursts of one run and round are one piece
    new[1:] = (run[1:] != run[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(run)) - 1
    return run[at], lo[at] - start[run[at]], hi[last] - lo[at], r[at]


def place(at: np.ndarray, length: np.ndarray, total: int, size: int) -> tuple[np.ndarray, ...]:
    """Pieces from ``at`` of the stream cut at sequence bounds: which piece, start within it, length, sequence, offset."""
    full = total // size
    bounds = full * size + np.cumsum([0, *tails(total - full * size)])
    number = lambda x: np.where(x < full * size, x // size, full + np.searchsorted(bounds, x, "right") - 1)
    first = number(at)
    which, seq = _ranges(first, number(at + length - 1) - first + 1)
    begin = np.where(seq < full, seq * size, bounds[np.clip(seq - full, 0, len(bounds) - 1)])
    end = np.where(seq < full, begin + size, bounds[np.clip(seq - full + 1, 0, len(bounds) - 1)])
    a, b = np.maximum(at[which], begin), np.minimum((at + length)[which], end)
    return which, a - at[which], b - a, seq, a - begin


def encode(docs: DataFrame, tokenizer: str, end_id: int, kind: str, special_as_text: bool = False) -> DataFrame:
    """(doc_id, source, part, before, n, ids): ids of each document and the tokens of its source before it in its task."""

    def run(batches):
        from pyspark import TaskContext

        part, seen, enc = TaskContext.get().partitionId(), {}, encoder(tokenizer, special_as_text)
        for batch in batches:
            body, offsets = common.text_column(batch.column("text"))
            for a, b in common.pieces(offsets):
                ids, bounds = enc.encode(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], end_id)
                cut, n = batch.slice(a, b - a), np.diff(bounds)
                before = []
                for s, k in zip(cut.column("source").to_pylist(), n.tolist(), strict=True):
                    before.append(seen.get(s, 0))
                    seen[s] = before[-1] + k
                yield pa.RecordBatch.from_arrays(
                    [cut.column("doc_id"), cut.column("source"), pa.array([part] * len(n), pa.int32()), pa.array(before, pa.int64()), pa.array(n), _binary(ids.astype(kind), bounds)],
                    ["doc_id", "source", "part", "before", "n", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    return rows.mapInArrow(run, "doc_id long, source string, part int, before long, n long, ids binary")


def _binary(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds * ids.itemsize, np.int64)), pa.py_buffer(ids.tobytes())]).cast(pa.binary())


def _joined(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows in a row, and the bounds of each."""
    whole = column.cast(pa.large_binary())
    _, offsets, body = whole.buffers()
    at = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    return np.frombuffer(body, np.uint8)[at[0] : at[-1]].view(kind), (at - at[0]) // np.dtype(kind).itemsize


def pack(
    spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 4096, weights: dict[str | None, float] | None = None, burst: int = BURST, special_as_text: bool = False
) -> DataFrame:
    """One row per piece: doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    folder = common.scratch(spark, "packing")
    kind = "<u2" if max(encoder(tokenizer, special_as_text).tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else "<u4"
    coded = common.written(encode(docs, tokenizer, end_id, kind, special_as_text), f"{folder}/ids")
    sums = common.written(coded.groupBy("part", "source").agg(F.sum("n").alias("n")), f"{folder}/sums")
    totals = sums.groupBy("source").agg(F.sum("n").alias("n"))
    if not common.fits(totals, MOST_SOURCES):
        raise ValueError(f"more than {MOST_SOURCES} sources: give a coarser source column")
    tokens = {r["source"]: r["n"] for r in totals.collect()}
    want = {s: float(n) if weights is None else weights.get(s, 0.0) for s, n in tokens.items()}
    if min(want.values(), default=0) < 0:
        raise ValueError("a target weight is negative")
    first = plan({s: n for s, n in tokens.items() if want[s]}, want, size, burst)
    after = plan({s: n for s, n in tokens.items() if not want[s]}, None, size, burst)  # a second round-robin, once the first is over
    total, lead = sum(tokens.values()), int(first.tokens.sum())
    rounds = first.rounds + after.rounds + 1
    ranges = max(1, min(common.shuffle_partitions(spark), rounds))

    def spent(r: int) -> int:
        """Tokens sent before round ``r``."""
        return int(first.sent(r).sum()) if r < first.rounds else lead + int(after.sent(r - first.rounds).sum())

    begins_at = [spent(-(-k * rounds // ranges)) for k in range(ranges)]
    # a row for each task and source: where the task's part of the queue begins
    of_source = Window.partitionBy("source")
    ahead = of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select(F.col("part").alias("_p"), F.col("source").alias("_s"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("begin"), F.sum("n").over(of_source).alias("total"))
    given = spark.createDataFrame([(s, float(w)) for s, w in (weights or {}).items()], "_w string, weight double")
    if weights is None:
        begins = begins.withColumn("weight", F.col("total").cast("double"))
    else:
        begins = begins.join(given, F.col("_s").eqNullSafe(F.col("_w")), "left").drop("_w").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    begins = common.written(begins, f"{folder}/begins")

    def cut(batches):
        for batch in batches:
            if not len(batch):
                continue
            n, begin, own_total, weight = (np.asarray(batch.column(c)) for c in ("n", "at", "total", "weight"))
            parts = []
            for p, rows, w, shift in ((first, np.flatnonzero(weight > 0), weight, 0), (after, np.flatnonzero(weight == 0), own_total.astype(float), first.rounds)):
                if len(rows):
                    run, start, length, r = bursts(p, w[rows], own_total[rows], begin[rows], n[rows])
                    parts.append((rows[run], start, length, r + shift))
            run, start, length, r = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((start, run))
            run, start, length, r = run[order], start[order], length[order], r[order]
            (ids, _), row = _joined(batch.column("ids"), kind), pa.array(run)
            yield pa.RecordBatch.from_arrays(
                [pa.array(r), batch.column("source").take(row), pa.array(begin[run] + start), batch.column("doc_id").take(row), pa.array(start), pa.array(n[run]),
                 _binary(ids, np.concatenate([[0], np.cumsum(length)]))],
                ["round", "source", "queue_at", "doc_id", "start", "doc_tokens", "ids"],
            )

    joined = coded.join(begins, (F.col("part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s")))
    rows = joined.select("doc_id", "source", "n", "ids", (F.col("begin") + F.col("before")).alias("at"), "total", "weight")
    pieces = rows.mapInArrow(cut, "round long, source string, queue_at long, doc_id long, start long, doc_tokens long, ids binary")
    number = F.floor(F.col("round") * ranges / F.lit(rounds)).cast("int")
    dealt = pieces.repartitionById(ranges, number).sortWithinPartitions("round", "source", "queue_at")

    def run(batches):
        at = None
        for batch in batches:
            if not len(batch):
                continue
            if at is None:
                at = begins_at[batch.column("round")[0].as_py() * ranges // rounds]
            ids, bounds = _joined(batch.column("ids"), kind)
            which, begin, n, seq, offset = place(at + bounds[:-1], np.diff(bounds), total, size)
            at += int(bounds[-1])
            data, lo = memoryview(ids.astype("<u4").view(np.uint8)), bounds[which] + begin
            crcs = [crc32(data[a:b]) for a, b in zip((4 * lo).tolist(), (4 * (lo + n)).tolist(), strict=True)]
            row = pa.array(which)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(row), batch.column("source").take(row), pa.array(np.asarray(batch.column("start"))[which] + begin), pa.array(n), pa.array(crcs, pa.int64()),
                 batch.column("doc_tokens").take(row), pa.array(seq), pa.array(offset)],
                ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    out = dealt.mapInArrow(run, "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    out = common.held(out)
    common.drop(spark, folder)
    return out
