"""Token ids in files: frequency-ranked, byte-aligned variable-length codes with separate control bytes.

The table is dealt by doc_id ranges and sorted, so files follow each other in ascending
doc_id. A file is a sequence of segments, one row each in a Parquet container on the shared
folder. A segment is complete in itself:

    shard, segment   place in the order of all segments
    ranks            the segment's distinct ids, most frequent first, little-endian uint32
    control          two bits for each id, four ids a byte from the low bits: bytes of its rank, less one
    data             the ranks, little-endian, without their high zero bytes
    doc_ids, sizes   the documents and how many ids each has

Frequent ids take one byte. Decoding looks the four lengths of a control byte up in a
table, so a segment is decoded by whole-array steps.
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

from sparkwell.llm.common import small_side, stored
from sparkwell.llm.text import slices
from sparkwell.llm.tokens import END_ID, encoder, groups

#: Ids of a segment; the document that passes this number is still in it.
SEGMENT_IDS = 1 << 20
#: Words a Python worker keeps; at most twice as many for a while.
CACHED_WORDS = 500_000
#: Bytes of the four codes of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
SEGMENT = "shard int, segment int, n_ids bigint, ranks binary, control binary, data binary, doc_ids array<bigint>, sizes binary"


def encode_ids(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(ranks, control, data) of a sequence of ids."""
    counts = np.bincount(ids)  # ids are bounded by the vocabulary
    values = np.flatnonzero(counts)
    order = np.lexsort((values, -counts[values]))  # ties by id
    place = np.zeros(len(counts), "<u4")
    place[values[order]] = np.arange(len(order))
    codes = place[ids]
    extra = (codes > 0xFF).astype(np.uint8) + (codes > 0xFFFF) + (codes > 0xFFFFFF)
    padded = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    padded[: len(codes)] = extra
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = codes.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return values[order].astype("<u4").tobytes(), control.tobytes(), data.tobytes()


def decode_ids(ranks: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    begin = np.cumsum(lengths, dtype=np.int64) - lengths
    bytes_ = np.frombuffer(data + bytes(3), np.uint8).astype(np.uint32)
    codes = bytes_[begin]
    for k in range(1, int(lengths.max(initial=1))):
        codes |= np.where(lengths > k, bytes_[begin + k] << np.uint32(8 * k), np.uint32(0))
    return np.frombuffer(ranks, "<u4")[codes] if n else np.zeros(0, "<u4")


def _write(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment = TaskContext.get().partitionId(), 0
        held, ids, size = [], [], 0
        end = END_ID.to_bytes(4, "little")

        def row():
            ranks, control, data = encode_ids(np.frombuffer(b"".join(held), "<u4"))
            sizes = np.array([len(x) // 4 for x in held], "<i8").tobytes()
            values = [shard, segment, size // 4, ranks, control, data, ids, sizes]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, TYPES)], names=[f.split()[0] for f in SEGMENT.split(", ")])

        for batch in slices(batches):
            texts, doc_ids = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for begin, stop in groups(texts):
                for doc_id, found in zip(doc_ids[begin:stop], encoder(path, CACHED_WORDS).encode(texts[begin:stop])):
                    held.append(found + end)
                    ids.append(doc_id)
                    size += len(held[-1])
                    if size >= 4 * SEGMENT_IDS:
                        yield row()
                        held, ids, size, segment = [], [], 0, segment + 1
        if held:
            yield row()

    return run


TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary())


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for row in batch.to_pylist():
            ids = decode_ids(row["ranks"], row["control"], row["data"], row["n_ids"])
            sizes = np.frombuffer(row["sizes"], "<i8")
            start = np.concatenate([[0], np.cumsum(sizes)])
            view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(start, start[1:])]
            place = [pa.array(np.full(len(sizes), row[c], np.int32)) for c in ("shard", "segment")]
            yield pa.RecordBatch.from_arrays(
                [*place, pa.array(row["doc_ids"], pa.int64()), pa.array(start[:-1]), pa.array(sizes), pa.array(crc, pa.int64())],
                names=["shard", "segment", "doc_id", "place", "n_tokens", "ids_crc32"],
            )


def write_token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The segments of all texts of ``docs`` (doc_id, text), on the shared folder.

    Null counts as empty text and has the end id only. Null ids come first; rows that
    repeat an id follow each other by a hash of their text. An empty table gives no segment.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(dealt.mapInArrow(_write(tokenizer), SEGMENT), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) for each document of the files; start counts the ids of all before it."""
    place = files.select("shard", "segment", "n_ids")
    shards = place.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row for each file
    base = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    inside = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("segment")) - F.col("n_ids")
    starts = stored(place.withColumn("inside", inside).join(base, "shard").select("shard", "segment", (F.col("base") + F.col("inside")).alias("base")), "starts")
    rows = files.mapInArrow(_read, "shard int, segment int, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint")
    found = rows.join(small_side(starts), ["shard", "segment"])
    return found.select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
