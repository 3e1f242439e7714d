"""LM scoring by deleted interpolation.

p(w | u) = a2(b) c(u, w) / c(u) + a1(b) c(w) / N + a0(b) / (V + 1), where b is the frequency bucket of
the context word u. The weights of each bucket come from expectation-maximisation on the deleted
part of the training documents, with counts from the rest. Then all training counts are used.

All counts grow with the corpus and none is dropped; only fixed-size tables are sent to all tasks:

* every word is counted (one row for each word of a part of the input, then summed);
* the ``KNOWN`` most frequent words travel with their counts; this only chooses where a count is looked up;
* pairs of the ``DENSE`` most frequent words are counted in the map tasks into one matrix;
* all other words and pairs are dealt out, packed by (bucket, chunk of documents). A rare word goes
  to the bucket of its hash with its neighbours, which are its context and the word it is context of; a
  pair of two known words goes by pair. A word or pair dealt out holds at most a share of 1 / DENSE of
  all words, so no bucket is hot. A bucket knows the exact counts of its words and pairs, and returns
  sums for each document of a chunk;
* a pair of two rare words is counted in the bucket of its word and sent, with both counts, to the
  bucket of its context, which knows the context's count.

A context has no bigram term only if it does not occur in the counted texts.

Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwell.llm.common import stored
from sparkwell.llm.text import Words, as_bytes, blocks, mix, slices

KNOWN, DENSE = 1 << 16, 1 << 11
#: Text bytes of a chunk: what a map task packs together.
CHUNK_BYTES = 8 << 20
#: Words for each bucket, which bounds the memory of its task.
BUCKET_WORDS = 2_500_000
#: Steps of the ratios' binary logarithm in the held-out statistics, and rounds of EM over them.
STEPS, EM_ROUNDS = 8, 60
#: Ranges into which matrix cells are dealt to be summed, and parts of the input summed in one group.
RANGES, PARTS = 64, 256
END = np.uint64(0x0E0D0E0D0E0D0E0D)

HEAD = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int8()), *((x, pa.binary()) for x in "abcde")])
HEAD_SQL = "bucket int, chunk bigint, kind tinyint, a binary, b binary, c binary, d binary, e binary"
#: What the buckets find before the weights are known. Kind 0: a pair of two rare words, for the bucket of its context: the hash of
#: the context, the pair's place, and the counts of its word and of the pair; kind 1: ``mark`` pairs of the deleted part by bucket
#: of the context, level of the pair and level of the word; kind 2: a context of such a pair of the deleted part, and its kept count.
FOUND = "kind tinyint, bucket int, context bigint, chunk bigint, mark bigint, word bigint, word_gone bigint, pair bigint, pair_gone bigint"
CELL = "b bigint, two bigint, one bigint, n bigint"
_ZSTD = pa.Codec("zstd", compression_level=1)


def _zip(x: np.ndarray) -> bytes:
    """Bytes of an array by planes, compressed, after their length."""
    plain = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()
    return len(plain).to_bytes(8, "little") + _ZSTD.compress(plain, asbytes=True)


def _unzip(data: bytes, kind) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    size = np.dtype(kind).itemsize
    plain = np.frombuffer(_ZSTD.decompress(data[8:], n, asbytes=True), np.uint8)
    return np.ascontiguousarray(plain.reshape(size, -1).T).reshape(-1).view(kind)


def _tokens(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of documents, an end after each; the document of each token; tokens by document."""
    words = Words(docs)
    count = words.count + 1
    ends = np.cumsum(count) - 1
    tokens = np.empty(count.sum(), np.uint64)
    at = np.ones(len(tokens), bool)
    at[ends] = False
    tokens[at], tokens[ends] = words.hashes(), END
    return tokens, np.repeat(np.arange(len(docs)), count), count


def _chunks(batches: Iterator[pa.RecordBatch]):
    """(chunk, ids, texts, flags) of about CHUNK_BYTES each; a chunk's number is fixed by the partition and its order."""
    part, number = TaskContext.get().partitionId(), 0
    ids, docs, flags, size = [], [], [], 0
    for batch in slices(batches):
        for i, text, flag in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist()):
            ids.append(i), docs.append(text), flags.append(flag)
            size += len(text) + 1
            if size >= CHUNK_BYTES:
                yield (part << 24) + number, ids, docs, np.array(flags, np.int64)
                ids, docs, flags, size, number = [], [], [], 0, number + 1
    if docs:
        yield (part << 24) + number, ids, docs, np.array(flags, np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, n, deleted) of each chunk; flag 1: training, 3: training and of the deleted part."""
    for _, _, docs, flags in _chunks(batches):
        use = [d for d, f in zip(docs, flags) if f & 1]
        gone = flags[(flags & 1) == 1] >> 1
        found, parts = [], []
        for begin, stop in blocks(use):
            tokens, doc, _ = _tokens(use[begin:stop])
            found.append(tokens), parts.append(gone[begin:stop][doc])
        if found:
            values, inverse = np.unique(np.concatenate(found), return_inverse=True)
            n, deleted = np.bincount(inverse), np.bincount(inverse, weights=np.concatenate(parts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n), pa.array(deleted)], names=["token", "n", "deleted"])


class Table:
    """The known words: sorted hashes with their rank, and counts by rank; the start of a document is the last row.

    ``start`` is the number of the start of a document as a context, ``rare`` that of a context or word which is not known.
    """

    def __init__(self, tokens: np.ndarray, n: np.ndarray, deleted: np.ndarray, docs: tuple[int, int], total: tuple[int, int], types: int, known: int, dense: int):
        self.known, self.dense, self.start, self.rare = known, dense, known, known + 1
        order = np.argsort(tokens)
        self.tokens, self.rank = tokens[order], order.astype(np.int64)
        pad = known - len(n)
        self.n = np.concatenate([n, np.zeros(pad, np.int64), [docs[0]]])
        self.kept = self.n - np.concatenate([deleted, np.zeros(pad, np.int64), [docs[1]]])
        self.total, self.total_kept, self.types = total[0], total[0] - total[1], types

    def ranks(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.full(len(tokens), self.rare)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.rank[at], self.rare)

    def pairs(self, docs: list[bytes]):
        """Tokens, their ranks, ranks of their contexts, and documents."""
        tokens, doc, count = _tokens(docs)
        w = self.ranks(tokens)
        u = np.empty_like(w)
        u[1:] = w[:-1]
        u[np.cumsum(count) - count] = self.start
        return tokens, w, u, doc, count

    def in_matrix(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        return ((u < self.dense) | (u == self.start)) & (w < self.dense)

    def cell(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        return np.where(u == self.start, self.dense, u) * self.dense + w

    @property
    def cells(self) -> int:
        return (self.dense + 1) * self.dense


def _row(bucket, chunk, kind, a=b"", b=b"", c=b"", d=b"", e=b""):
    return {"bucket": bucket, "chunk": chunk, "kind": kind, "a": a, "b": b, "c": c, "d": d, "e": e}


def _deal(table: Table, buckets: int):
    """Kind 0: rare words with their neighbours, kind 1: pairs of known words, of a bucket and chunk; kinds 2 and 3: matrix cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((2, table.cells), np.uint32)
        part = -1
        for chunk, _, docs, flags in _chunks(batches):
            part = chunk >> 24
            rows: list[list[np.ndarray]] = [[], [], [], [], []]
            pair_rows: list[list[np.ndarray]] = [[], []]
            for begin, stop in blocks(docs):
                tokens, w, u, doc, count = table.pairs(docs[begin:stop])
                flag = flags[begin:stop][doc]
                dense = table.in_matrix(u, w)
                for i, bit in enumerate((1, 2)):
                    use = dense & ((flag & bit) > 0)
                    cells[i] += np.bincount(table.cell(u[use], w[use]), minlength=table.cells).astype(np.uint32)
                mark = ((doc + begin) << 2) | flag
                by_word = np.flatnonzero(w == table.rare)
                after = np.append(w[1:], table.start)
                after[np.cumsum(count) - 1] = table.start  # nothing follows the end of a document
                for x, y in zip(rows, (tokens[by_word], u[by_word], mark[by_word], after[by_word], tokens[by_word - 1])):
                    x.append(y)
                by_pair = (w != table.rare) & (u != table.rare) & ~dense
                for x, y in zip(pair_rows, ((u[by_pair].astype(np.uint64) << np.uint64(32)) | w[by_pair].astype(np.uint64), mark[by_pair])):
                    x.append(y)
            out = []
            for kind, group in ((0, rows), (1, pair_rows)):
                joined = [np.concatenate(x) for x in group]
                bucket = (mix(joined[0]) % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((joined[0], bucket))
                joined, bucket = [x[order] for x in joined], bucket[order]
                edges = np.searchsorted(bucket, np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(edges)):
                    one = [x[edges[b] : edges[b + 1]] for x in joined]
                    key = _zip(np.diff(one[0], prepend=np.uint64(0)))
                    more = [_zip(x.astype(np.uint32)) for x in one[1:4]]
                    if kind == 0 and (one[1] == table.rare).any():
                        more.append(_zip(one[4][one[1] == table.rare]))
                    out.append(_row(int(b), chunk, kind, key, *more))
            yield from pa.Table.from_pylist(out, HEAD).to_batches()
        if part >= 0:
            out = []
            for kind, values in ((2, cells[0]), (3, cells[1])):
                at = np.flatnonzero(values)
                edges = np.searchsorted(at, np.arange(RANGES + 1) * -(-len(values) // RANGES))
                for i in np.flatnonzero(np.diff(edges)):
                    own = at[edges[i] : edges[i + 1]]
                    out.append(_row(-1 - int(i), part, kind, _zip(np.diff(own, prepend=0).astype(np.uint32)), _zip(values[own].astype(np.int64))))
            yield from pa.Table.from_pylist(out, HEAD).to_batches()

    return run


def _sums(new: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Of each row, the sums over its run; ``new`` marks the first row of each run."""
    heads, run = np.flatnonzero(new), np.cumsum(new) - 1
    return [np.add.reduceat(x, heads)[run] for x in values]


def _new(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    return np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]


def _flags(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return mark & 1, mark >> 1 & 1


def _key(r: dict) -> np.ndarray:
    return np.cumsum(_unzip(r["a"], np.uint64), dtype=np.uint64)


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _load(rows: pa.Table, table: Table) -> list[dict[str, np.ndarray] | None]:
    """A bucket's rare words, by hash and context, with their counts, and its pairs of known words; None where there are none."""
    by_kind: tuple[list, list] = ([], [])
    for r in rows.to_pylist():
        key = _key(r)
        own = {"key": key, "chunk": np.full(len(key), r["chunk"])}
        own |= {name: _unzip(r[x], np.uint32).astype(np.int64) for name, x in ((("u", "b"), ("mark", "c"), ("after", "d")) if r["kind"] == 0 else (("mark", "b"),))}
        if r["kind"] == 0 and "e" in r:
            own["context"] = np.zeros(len(key), np.uint64)
            if r["e"]:
                own["context"][own["u"] == table.rare] = _unzip(r["e"], np.uint64)
        by_kind[r["kind"]].append(own)
    out = []
    for parts in by_kind:
        if not parts:
            out.append(None)
            continue
        x = {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}
        order = np.lexsort((x["u"], x["key"])) if "u" in x else np.argsort(x["key"], kind="stable")
        out.append({name: v[order] for name, v in x.items()})
    if out[0]:
        out[0]["n"], out[0]["gone"] = _sums(_new(out[0]["key"]), *_flags(out[0]["mark"]))
    return out


def _parts(rare: dict | None, pairs: dict | None, table: Table):
    """The pairs of a bucket but those of two rare words, in parts: chunk, mark, and the counts of context, pair and word, each with its
    deleted count; whether the rows also stand for a rare word's places. Context and pair are None where the rows do only that."""

    def of_rank(rank):
        return table.n[rank], table.n[rank] - table.kept[rank]

    if pairs:
        u, w = (pairs["key"] >> np.uint64(32)).astype(np.int64), (pairs["key"] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        yield pairs["chunk"], pairs["mark"], of_rank(u), _sums(_new(pairs["key"]), *_flags(pairs["mark"])), of_rank(w), False
    if not rare:
        return
    key, chunk, u, mark, after, n, gone = (rare[x] for x in ("key", "chunk", "u", "mark", "after", "n", "gone"))
    pair = _sums(_new(key, u), *_flags(mark))
    known = u != table.rare
    yield chunk[known], mark[known], of_rank(u[known]), [x[known] for x in pair], (n[known], gone[known]), True
    yield chunk[~known], mark[~known], None, None, (n[~known], gone[~known]), True
    use = np.flatnonzero(after < table.known)  # the rare words as contexts
    if len(use):
        use = use[np.lexsort((after[use], key[use]))]
        pair = _sums(_new(key[use], after[use]), *_flags(mark[use]))
        yield chunk[use], mark[use], (n[use], gone[use]), pair, of_rank(after[use]), False


def _bucket_of(count: np.ndarray) -> np.ndarray:
    """Frequency bucket of contexts; 0: those that do not occur."""
    return np.where(count > 0, np.log2(np.maximum(count, 1)).astype(np.int64) + 1, 0)


def _level(ratio: np.ndarray) -> np.ndarray:
    """A ratio in steps of its binary logarithm; 0 for zero."""
    return np.where(ratio > 0, np.round(-np.log2(np.maximum(ratio, 1e-18)) * STEPS).astype(np.int64) + 1, 0)


def _ratios(pair, context, word, total):
    return np.where(context > 0, pair / np.maximum(context, 1), 0.0), word / max(total, 1)


def _cells(context, two, one) -> tuple[np.ndarray, ...]:
    """b, level of the pair's ratio, level of the word's ratio, and how many."""
    values, n = np.unique(np.stack([_bucket_of(context), _level(two), _level(one)], axis=1), axis=0, return_counts=True)
    return *values.T, n


def _held_out(table: Table, buckets: int):
    """FOUND rows of a bucket."""

    def rows_of(kind, **columns):
        n = len(next(iter(columns.values())))
        given = {"kind": np.full(n, kind, np.int8), **columns}
        columns = [given.get(name, np.zeros(n, np.int64)) for name in _names(FOUND)]
        return pa.table([pa.array(x.astype(np.int32) if name == "bucket" else x) for name, x in zip(_names(FOUND), columns)], names=_names(FOUND))

    def run(rows: pa.Table) -> pa.Table:
        rare, pairs = _load(rows, table)
        cells = [[np.zeros(0, np.int64)] * 3]
        for _, mark, context, pair, word, _ in _parts(rare, pairs, table):
            if pair is None:
                continue
            pick = (mark & 2) > 0
            context, pair, word = ((n - gone)[pick] for n, gone in (context, pair, word))
            cells.append([context, *_ratios(pair, context, word, table.total_kept)])
        b, two, one, n = _cells(*(np.concatenate(x) for x in zip(*cells)))
        out = [rows_of(1, context=b, pair=two, word=one, mark=n)]
        if rare:
            pick = np.flatnonzero(rare["u"] == table.rare)
            if len(pick):
                pick = pick[np.lexsort((rare["context"][pick], rare["key"][pick]))]
                key, context, chunk, mark, n, gone = (rare[x][pick] for x in ("key", "context", "chunk", "mark", "n", "gone"))
                pair, pair_gone = _sums(_new(key, context), *_flags(mark))
                to = (mix(context) % np.uint64(buckets)).astype(np.int64)
                out.append(rows_of(0, bucket=to, context=context.view(np.int64), chunk=chunk, mark=mark, word=n, word_gone=gone, pair=pair, pair_gone=pair_gone))
            pick = np.flatnonzero((rare["after"] == table.rare) & ((rare["mark"] & 2) > 0))
            key, first = np.unique(rare["key"][pick], return_index=True)
            out.append(rows_of(2, context=key.view(np.int64), word=(rare["n"] - rare["gone"])[pick][first]))
        return pa.concat_tables(out)

    return run


def _rare_cells(total_kept: int):
    """CELL rows of the deleted part's pairs of two rare words (context, pair, word: kept counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, pair, word = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
            found = _cells(context, *_ratios(pair, context, word, total_kept))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=_names(CELL))

    return run


def fit_weights(cells: np.ndarray, types: int) -> np.ndarray:
    """Weights (pair, word, uniform) of each frequency bucket from rows (b, pair ratio, word ratio, n)."""
    weights = np.tile([0.4, 0.5, 0.1], (66, 1))
    weights[0] = [0, 0.9, 0.1]
    for b in np.unique(cells[:, 0]).astype(int):
        part = cells[cells[:, 0] == b]
        like = np.stack([part[:, 1], part[:, 2], np.full(len(part), 1 / (types + 1))], axis=1)
        w = weights[b].copy()
        for _ in range(EM_ROUNDS):
            share = like * w
            share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
            w = (share * part[:, 3:]).sum(axis=0) + np.array([0 if b == 0 else 1e-3, 1e-3, 1e-3])
            w /= w.sum()
        weights[b] = w
    return weights


def _log_p(weights, table, pair, context, word):
    two, one = _ratios(pair, context, word, table.total)
    w = weights[_bucket_of(context)]
    return np.log10(w[:, 0] * two + w[:, 1] * one + w[:, 2] / (table.types + 1))


def _bucket_scores(table: Table, weights: np.ndarray):
    """Kind 1: sums by document of a chunk, from one bucket."""

    def run(rows: pa.Table, rare_pairs: pa.Table) -> pa.Table:
        rare, pairs = _load(rows, table)
        found = list(_parts(rare, pairs, table))
        if rare_pairs.num_rows:
            heads = np.flatnonzero(_new(rare["key"]))
            chunk, mark, context, word, pair = (rare_pairs.column(x).to_numpy() for x in ("chunk", "mark", "context", "word", "pair"))
            at = heads[np.searchsorted(rare["key"][heads], context.view(np.uint64))]
            found.append((chunk, mark, (rare["n"][at],), (pair,), (word,), False))
        parts = []
        for chunk, mark, context, pair, word, own in found:
            none = np.zeros(len(mark))
            score = none if pair is None else _log_p(weights, table, pair[0], context[0], word[0])
            base, known = (np.log10(word[0] + 1.0), (word[0] > 0).astype(float)) if own else (none, none)
            parts.append((chunk, mark >> 2, score, base, known))
        chunk, doc, score, base, known = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((doc, chunk))
        chunk, doc = chunk[order], doc[order]
        heads = np.flatnonzero(np.r_[True, (chunk[1:] != chunk[:-1]) | (doc[1:] != doc[:-1])])
        sums = np.stack([np.add.reduceat(x[order], heads) for x in (score, base, known)], axis=1)
        chunk, doc = chunk[heads], doc[heads]
        edges = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1], True])
        out = [_row(0, int(chunk[a]), 1, _zip(doc[a:b].astype(np.uint32)), _zip(np.ascontiguousarray(sums[a:b]).reshape(-1))) for a, b in zip(edges, edges[1:])]
        return pa.Table.from_pylist(out, HEAD)

    return run


def _map_scores(table: Table, weights: np.ndarray, matrix: np.ndarray):
    """Kind 0: ids, flags, tokens and the sums that need no bucket, of a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, ids, docs, flags in _chunks(batches):
            parts, counts = [], []
            for begin, stop in blocks(docs):
                _, w, u, doc, count = table.pairs(docs[begin:stop])
                own = w != table.rare
                base = np.where(own, np.log10(table.n[np.minimum(w, table.known)] + 1.0), 0.0)
                score = np.zeros(len(w))
                pick = table.in_matrix(u, w)
                score[pick] = _log_p(weights, table, matrix[table.cell(u[pick], w[pick])], table.n[u[pick]], table.n[w[pick]])
                heads = np.cumsum(count) - count
                parts.append(np.stack([np.add.reduceat(x, heads) for x in (score, base, own.astype(float))], axis=1))
                counts.append(count)
            sums, count = np.concatenate(parts), np.concatenate(counts)
            # ids may be null
            names = pa.array(ids, pa.int64())
            info = np.stack([names.fill_null(0).to_numpy(), names.is_null().to_numpy(zero_copy_only=False).astype(np.int64), flags, count], axis=1)
            row = _row(0, chunk, 0, _zip(np.ascontiguousarray(info).reshape(-1)), _zip(sums.reshape(-1)))
            yield from pa.Table.from_pylist([row], HEAD).to_batches()

    return run


RESULT = "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _merge(total: int, types: int):
    def run(rows: pa.Table) -> pa.Table:
        found = rows.to_pylist()
        heads = [r for r in found if r["kind"] == 0]
        if len(heads) != 1:
            raise RuntimeError("the input's partitions changed between two reads; store it first")
        info = _unzip(heads[0]["a"], np.int64).reshape(-1, 4)
        sums = _unzip(heads[0]["b"], np.float64).reshape(-1, 3).copy()
        for r in found:
            if r["kind"] == 1:
                sums[_unzip(r["a"], np.uint32)] += _unzip(r["b"], np.float64).reshape(-1, 3)
        n = info[:, 3]
        base = sums[:, 1] - n * math.log10(total + types + 1)
        columns = [
            pa.array(info[:, 0], pa.int64(), mask=info[:, 1] > 0), pa.array((info[:, 2] & 1) > 0), pa.array(n), pa.array(np.round(sums[:, 2]).astype(np.int64)),
            pa.array(np.full(len(n), total, np.int64)), pa.array(base), pa.array(sums[:, 0]),
        ]
        return pa.table(columns, names=[f.split()[0] for f in RESULT.split(", ")])

    return run


def score_texts(docs: DataFrame, train: Column, deleted: Column, known: int = KNOWN, dense: int = DENSE) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs`` (doc_id, text).

    ``train`` marks the rows to learn from, ``deleted`` those of them whose tokens fit the weights.
    Null counts as empty text, which is one end token. Repeated rows count as often as they stand; an
    empty table gives an empty result. Without training rows every word is unknown. The input must read the
    same in the same partitions each time, as stored tables do. ``known`` and ``dense`` (at most ``known``) choose
    where counts are looked up; the results are the same.
    """
    spark = docs.sparkSession
    flag = F.when(train & deleted, 3).when(train, 1).otherwise(0)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), flag.cast("bigint").alias("flag"))
    counted = rows.mapInArrow(_count, "token bigint, n bigint, deleted bigint")
    words = stored(counted.groupBy("token").agg(F.sum("n").alias("n"), F.sum("deleted").alias("deleted")), "words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("deleted"), F.lit(0)), F.count(F.lit(1))).first()
    n_docs = rows.agg(F.coalesce(F.sum(F.col("flag").bitwiseAND(1)), F.lit(0)), F.count(F.when(F.col("flag") == 3, 1))).first()
    top = words.orderBy(F.desc("n"), "token").limit(known).toPandas()
    table = Table(top["token"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64), top["deleted"].to_numpy(np.int64), tuple(n_docs), (total[0], total[1]), total[2], known, dense)
    shared = spark.sparkContext.broadcast(table)  # two megabytes at most
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total[0] // BUCKET_WORDS + 1)

    def with_table(make, *args):
        return lambda x: make(shared.value, *args)(x)

    dealt = stored(rows.mapInArrow(with_table(_deal, buckets), HEAD_SQL), "pairs")
    by_bucket = dealt.filter("bucket >= 0").groupBy("bucket")
    found = stored(by_bucket.applyInArrow(with_table(_held_out, buckets), FOUND), "found")
    rare = found.filter("kind = 0")
    kept = [(F.col(x) - F.col(f"{x}_gone")).alias(x) for x in ("pair", "word")]
    rare_cells = rare.filter(F.col("mark").bitwiseAND(2) > 0).select("context", *kept)
    rare_cells = rare_cells.join(found.filter("kind = 2").select("context", F.col("word").alias("kept")), "context").select("kept", "pair", "word")
    cells = found.filter("kind = 1").select(F.col("context").alias("b"), F.col("pair").alias("two"), F.col("word").alias("one"), F.col("mark").alias("n"))
    cells = cells.unionByName(rare_cells.mapInArrow(_rare_cells(table.total_kept), CELL))
    cells = cells.groupBy("b", "two", "one").agg(F.sum("n").alias("n")).toPandas().to_numpy(np.int64).astype(float)  # a fixed grid

    # the matrix: each range is summed over groups of parts, then over the groups; the driver sees one matrix
    sums = dealt.filter("bucket < 0").withColumn("chunk", F.floor(F.col("chunk") / PARTS))
    sums = sums.groupBy("bucket", "kind", "chunk").applyInArrow(_sum_cells, HEAD_SQL).groupBy("bucket", "kind").applyInArrow(_sum_cells, HEAD_SQL)
    totals = {kind: np.zeros(table.cells, np.int64) for kind in (2, 3)}
    for r in sums.toLocalIterator():
        totals[r["kind"]][np.cumsum(_unzip(bytes(r["a"]), np.uint32), dtype=np.int64)] += _unzip(bytes(r["b"]), np.int64)
    cells[:, 1:3] = np.where(cells[:, 1:3] > 0, 2.0 ** (-(cells[:, 1:3] - 1) / STEPS), 0)
    at = np.flatnonzero(totals[3])
    u, w = at // dense, at % dense
    context = table.kept[np.where(u == dense, table.start, u)]
    two, one = _ratios((totals[2] - totals[3])[at], context, table.kept[w], table.total_kept)
    in_matrix = np.stack([_bucket_of(context), two, one, totals[3][at]], axis=1)
    weights = fit_weights(np.concatenate([cells, in_matrix]), table.types)

    matrix = spark.sparkContext.broadcast(totals[2].astype(np.uint32 if total[0] < 2**32 else np.int64))
    here = rows.mapInArrow(lambda x: _map_scores(shared.value, weights, matrix.value)(x), HEAD_SQL)
    with_rare = dealt.filter("bucket >= 0").drop("e").groupBy("bucket").cogroup(rare.select("bucket", "chunk", "mark", "context", "word", "pair").groupBy("bucket"))
    there = with_rare.applyInArrow(lambda rows, pairs: _bucket_scores(shared.value, weights)(rows, pairs), HEAD_SQL)
    return here.unionByName(there).groupBy("chunk").applyInArrow(_merge(total[0], total[2]), RESULT)


def _sum_cells(rows: pa.Table) -> pa.Table:
    """One row for a group of rows of matrix cells of one range and kind."""
    cell = np.concatenate([np.cumsum(_unzip(a, np.uint32), dtype=np.int64) for a in rows["a"].to_pylist()])
    at, inverse = np.unique(cell, return_inverse=True)
    n = np.zeros(len(at), np.int64)
    np.add.at(n, inverse, np.concatenate([_unzip(b, np.int64) for b in rows["b"].to_pylist()]))
    first = {c: rows[c][0].as_py() for c in ("bucket", "chunk", "kind")}
    return pa.Table.from_pylist([_row(first["bucket"], first["chunk"], first["kind"], _zip(np.diff(at, prepend=0).astype(np.uint32)), _zip(n))], HEAD)
