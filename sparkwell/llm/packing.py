"""Mixture-controlled packing: deficit round-robin over source queues, in closed form.

Every source is a queue of its documents' tokens. In round j each queue is credited its target
share of one sequence; it serves whole quanta as long as its credit covers them and
carries the rest, its deficit, into the next round. So after j rounds a queue has served
min(floor(share * length * j / quantum), all) quanta, whatever happened elsewhere: a task can place
any quantum from the queues' totals alone, and deficits carry across windows and
partitions without any state passing between tasks. The served tokens form one stream,
cut into windows of ``length`` tokens; every window has the target proportions within one
quantum for each source. What remains at the end is cut into powers of two, so nothing is padded.

Queues are ordered by input partition and row; a first pass stores the ids and counts, and a
running sum over (partition, source) gives each document its place in its queue.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkwell.llm.common import local_table, small_side, stored
from sparkwell.llm.text import slices
from sparkwell.llm.tokens import CACHED_CHUNKS, END_ID, encoder, groups

LENGTH = 2048
QUANTUM = 256
#: The sources with most tokens and those named in the targets have a queue each; the others share ``SHARED`` more queues by hash.
OWN_QUEUES, SHARED = 1024, 256
#: Quanta placed at a time: with the queues, bounds the memory of a task.
PLACED = 4096

ROWS = "part int, source string, doc_id bigint, before bigint, n bigint, ids binary"
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def _tokenise(path: str, cached: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, served = TaskContext.get().partitionId(), {}
        end = END_ID.to_bytes(4, "little")
        for batch in slices(batches):
            ids, texts, sources = (c.to_pylist() for c in batch.columns)
            for begin, stop in groups(texts):
                found = [x + end for x in encoder(path, cached).encode(texts[begin:stop])]
                before = []
                for source, x in zip(sources[begin:stop], found):
                    before.append(served.get(source, 0))
                    served[source] = before[-1] + len(x) // 4
                n = [len(x) // 4 for x in found]
                # 16 bits an id where the vocabulary allows it; the reader sees the width by the length
                small = encoder(path, cached).tokenizer.get_vocab_size() <= 1 << 16
                short = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in found] if small else found
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(n), pa.int32()), pa.array(sources[begin:stop], pa.string()), pa.array(ids[begin:stop], pa.int64()),
                     pa.array(before, pa.int64()), pa.array(n, pa.int64()), pa.array(short, pa.binary())],
                    names=["part", "source", "doc_id", "before", "n", "ids"],
                )

    return run


class Schedule:
    """Where each quantum of each queue stands in the stream of served tokens."""

    def __init__(self, totals: list[int], shares: list[float], length: int = LENGTH, quantum: int = QUANTUM):
        self.totals, self.length, self.quantum = np.array(totals, np.int64), length, quantum
        self.quanta = -(-self.totals // quantum)
        self.rate = np.array(shares, float) * length / quantum  # quanta a round
        self.total = int(self.totals.sum())
        self.full = self.total // length
        rest, tail = self.total % length, [self.full * length]
        for bit in range(length.bit_length() - 1, -1, -1):
            if rest >> bit & 1:
                tail.append(tail[-1] + (1 << bit))
        self.tail = np.array(tail)

    def served(self, queue, rounds) -> np.ndarray:
        """Quanta that a queue has served before a round."""
        return np.minimum(np.floor(self.rate[queue] * rounds + 1e-9).astype(np.int64), self.quanta[queue])

    def place(self, queue: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Stream position of the given quanta."""
        out = [self._place(queue[i : i + PLACED], number[i : i + PLACED]) for i in range(0, len(queue), PLACED)]
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def _place(self, queue, number):
        rounds = np.maximum(np.ceil((number + 1) / self.rate[queue]).astype(np.int64) - 1, 0)
        while (late := self.served(queue, rounds) > number).any():
            rounds -= late
        while (early := self.served(queue, rounds + 1) <= number).any():
            rounds += early
        every = np.arange(len(self.totals))
        # queues before this one have served this round as well
        now = rounds[:, None] + (every < queue[:, None])
        tokens = np.minimum(self.served(every[None, :], now) * self.quantum, self.totals)
        return tokens.sum(axis=1) + (number - self.served(queue, rounds)) * self.quantum

    def sequence(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sequence, offset in it, where it ends) of stream positions."""
        number = at // self.length
        begin, end = number * self.length, (number + 1) * self.length
        late = np.flatnonzero(at >= self.full * self.length)
        step = np.searchsorted(self.tail, at[late], side="right") - 1
        number[late], begin[late], end[late] = self.full + step, self.tail[step], self.tail[np.minimum(step + 1, len(self.tail) - 1)]
        return number, at - begin, end


def _spread(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for each count, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def cut(schedule: Schedule, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pieces of documents that stand at ``first`` in their queues: (document, start, length, sequence, offset)."""
    q = schedule.quantum
    quanta = (first + n - 1) // q - first // q + 1
    doc = np.repeat(np.arange(len(n)), quanta)
    number = (first // q)[doc] + _spread(quanta)
    begin = np.maximum(number * q, first[doc])
    stop = np.minimum((number + 1) * q, (first + n)[doc])
    at = schedule.place(queue[doc], number) + begin - number * q
    start, size = begin - first[doc], stop - begin
    # quanta served one after the other are one run
    opens = np.ones(len(at), bool)
    opens[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + size[:-1])
    heads = np.flatnonzero(opens)
    doc, start, at = doc[heads], start[heads], at[heads]
    size = np.add.reduceat(size, heads) if len(heads) else size
    out = []
    while len(doc):
        number, offset, end = schedule.sequence(at)
        take = np.minimum(size, end - at)
        out.append((doc, start, take, number, offset))
        more = np.flatnonzero(take < size)
        doc, start, at, size = doc[more], start[more] + take[more], at[more] + take[more], size[more] - take[more]
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 5


def _pieces(schedule: Schedule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            queue, first, n, doc_ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            ids, names = batch.column(4).to_pylist(), batch.column(3).to_pylist()
            doc, start, size, sequence, offset = cut(schedule, queue.astype(np.int64), first, n)
            order = np.lexsort((start, doc))
            doc, start, size, sequence, offset = (x[order] for x in (doc, start, size, sequence, offset))
            crc = np.zeros(len(doc), np.int64)
            edges = np.searchsorted(doc, np.arange(len(n) + 1))
            for d in range(len(n)):
                whole = memoryview(np.frombuffer(ids[d], f"<u{len(ids[d]) // n[d]}").astype("<u4")).cast("B")
                for i in range(edges[d], edges[d + 1]):
                    crc[i] = zlib.crc32(whole[4 * start[i] : 4 * (start[i] + size[i])])
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[d] for d in doc], pa.int64()), *(pa.array(x, pa.int64()) for x in (start, size, crc, n[doc], sequence, offset))],
                names=[f.split()[0] for f in PIECES.split(", ")],
            )

    return run


def pack(docs: DataFrame, tokenizer: str, targets: dict[str | None, float] | None = None, quantum: int = QUANTUM, cached: int = CACHED_CHUNKS) -> DataFrame:
    """Pieces of all texts of ``docs`` (doc_id, text, source) in sequences of at most 2048 ids.

    ``targets`` are weights of sources; without them sources are mixed as they stand in the
    input, and without a weight a source has its share of the input. Every source named has a queue
    of its own; a name that is not in the input is refused. When a queue is empty the others
    go on in their proportions. Null text is empty and has the end id only; a null source is a
    source of its own; repeated rows are packed each. An empty table gives no piece. ``cached`` chunks
    of text and at most as many older ones stay in a worker's memory; fewer take more time.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("source").cast("string"))
    ids = stored(rows.mapInArrow(_tokenise(tokenizer, cached), ROWS), "ids", "zstd")
    held = stored(ids.groupBy("part", "source").agg(F.sum("n").alias("n")), "held")
    by_source = held.groupBy("source").agg(F.sum("n").alias("n"))
    largest = by_source.orderBy(F.desc("n"), "source").limit(OWN_QUEUES).select("source").collect()
    names = {r["source"]: i for i, r in enumerate(largest)}  # at most OWN_QUEUES names, and the targets
    named = [s for s in targets or {} if s not in names]
    if named:
        wanted = F.broadcast(local_table(spark, name=pa.array(named, pa.string())))
        found = {r["name"] for r in by_source.join(wanted, F.col("source").eqNullSafe(F.col("name"))).select("name").collect()}
        if unknown := [s for s in named if s not in found]:
            raise ValueError(f"targets of sources that are not in the input: {unknown}")
        names |= {s: OWN_QUEUES + SHARED + i for i, s in enumerate(named)}
    own = local_table(spark, name=pa.array(names, pa.string()), own=pa.array(names.values(), pa.int32()))
    shared = F.lit(OWN_QUEUES) + (F.crc32(F.coalesce("source", F.lit(""))) % SHARED).cast("int")
    held = held.join(F.broadcast(own), F.col("source").eqNullSafe(F.col("name")), "left").select("part", "source", "n", F.coalesce("own", shared).alias("queue"))
    start = F.sum("n").over(Window.partitionBy("queue").orderBy("part", "source")) - F.col("n")
    starts = stored(held.withColumn("start", start), "queues")
    sums = {r["queue"]: r["n"] for r in starts.groupBy("queue").agg(F.sum("n").alias("n")).collect()}  # at most OWN_QUEUES + SHARED, and the targets
    order = sorted(sums)
    total = sum(sums.values())
    weight = {names[s]: w for s, w in (targets or {}).items()}
    shares = [weight.get(q, sums[q] / total) for q in order]
    schedule = Schedule([sums[q] for q in order], [s / sum(shares) for s in shares], quantum=quantum)
    dense = F.element_at(F.create_map(*[F.lit(x) for i, q in enumerate(order) for x in (q, i)]), F.col("queue")) if order else F.lit(0)
    starts = starts.select(F.col("part").alias("p"), F.col("source").alias("s"), "start", dense.alias("queue"))
    both = ids.join(small_side(starts), (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
    placed = both.select("queue", (F.col("start") + F.col("before")).alias("first"), "n", "doc_id", "ids")
    return placed.mapInArrow(_pieces(schedule), PIECES)
