"""Vector similarity. Base rows stay partitioned; only the short query list travels."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwell.operators.ordered import top_per_group
from sparkwell.session import cut_lineage

MAX_QUERIES = 1000
Queries = Sequence[tuple[int, Sequence[float]]]


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Dot product over norms; NULL where a norm is zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return dot(a, b) / F.nullif(norms, F.lit(0.0))


def query_list(df: DataFrame, key: str, vector: str) -> list[tuple[int, list[float]]]:
    """Collect query vectors; refuses lists that are not short."""
    rows = df.select(key, vector).limit(MAX_QUERIES + 1).collect()
    if len(rows) > MAX_QUERIES:
        raise ValueError(f"more than {MAX_QUERIES} query vectors")
    return sorted((int(r[0]), [float(x) for x in r[1]]) for r in rows)


def _matrix(queries: Queries) -> tuple[np.ndarray, np.ndarray]:
    ids = np.array([q for q, _ in queries])
    m = np.array([v for _, v in queries], dtype="float64")
    return ids, m / np.linalg.norm(m, axis=1, keepdims=True)


def _best(dist: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` smallest values of each row, with all that equal the last."""
    cut = np.partition(dist, k - 1, axis=1)[:, k - 1 : k] if dist.shape[1] > k else np.inf
    return np.nonzero(dist <= cut)


def nearest(base: DataFrame, key: str, vector: str, queries: Queries, k: int) -> DataFrame:
    """(query_id, key, distance, place): the k smallest cosine distances per query.

    Each Arrow batch is one matrix product and hands on its own k best (ties
    included), so the shuffle carries candidates, not distances of all rows.
    """
    ids, m = _matrix(queries)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf[vector].to_numpy()).astype("float64")
            norm = np.linalg.norm(x, axis=1)
            keys, x, norm = pdf[key].to_numpy()[norm > 0], x[norm > 0], norm[norm > 0]
            dist = np.round(1.0 - (x @ m.T) / norm[:, None], 9)
            q, row = _best(dist.T, k)
            yield pd.DataFrame({"query_id": ids[q], key: keys[row], "distance": dist[row, q]})

    scored = base.select(key, vector).mapInPandas(score, f"query_id BIGINT, {key} BIGINT, distance DOUBLE")
    return top_per_group(scored, ["query_id"], [("distance", "asc"), (key, "asc")], k, "place")


@dataclass(frozen=True)
class Cells:
    """Centres of an index, and how many cells nearest to a query are probed."""

    centres: np.ndarray
    probes: int

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        """(rows, n) cells by similarity, nearest first."""
        if len(self.centres) == 1:
            return np.zeros((len(x), 1), int)
        near = x @ self.centres.T
        return np.argmax(near, axis=1)[:, None] if n == 1 else np.argsort(-near, axis=1, kind="stable")[:, :n]


#: One cell of all rows, of whatever length: its index answers exactly.
ONE_CELL = Cells(np.zeros((1, 1)), 1)
#: Rows of a table whose centres the driver fits, and rounds of k-means.
FIT_ROWS, FIT_ROUNDS = 4096, 8
#: Rows of such a table for each cell; and cells that are tried at the most on larger ones.
ROWS_PER_CELL, MOST_CELLS = 64, 1024
#: Sums of unit vectors are in steps of one by this many, so that they are exact in doubles and don't depend on how rows are dealt out.
SUM_STEPS = 1 << 24
#: Rows of one part of a cell: a cell of copies is many parts; and queries of one part, and of one matrix product.
PART_ROWS, PART_QUERIES, BLOCK_QUERIES = 50_000, 20_000, 128
#: Rows that could be compared in the time it takes to send a query to one more cell.
PROBE_ROWS = 64


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, without those of length zero."""
    norm = np.linalg.norm(x, axis=1)
    return x[norm > 0] / norm[norm > 0, None]


def _centres(x: np.ndarray, n: int) -> np.ndarray:
    """``n`` centres by k-means."""
    centres = x[:n].copy()
    for _ in range(FIT_ROUNDS):
        cell = np.argmax(x @ centres.T, axis=1) if len(x) else np.zeros(0, int)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, x)
        norm = np.linalg.norm(sums, axis=1)
        centres[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
    return centres


def _units(batches: Iterator[pd.DataFrame], vector: str) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches and their unit vectors, without the rows that have no direction."""
    for pdf in batches:
        if not pdf.empty:
            x = np.stack(pdf[vector].to_numpy()).astype("float64")
            norm = np.linalg.norm(x, axis=1)
            if (norm > 0).any():
                yield pdf[norm > 0], x[norm > 0] / norm[norm > 0, None]


def _centres_of_all(given: DataFrame, vector: str, x: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Centres by k-means over every row of a table, for each number of cells, from the first of ``x``; a round is one pass for all of them."""
    fits = [x[:n].copy() for n in sizes]
    begin, dims = np.cumsum([0, *sizes]), x.shape[1]

    for _ in range(FIT_ROUNDS):

        def partial(batches: Iterator[pd.DataFrame], fits=fits) -> Iterator[pd.DataFrame]:
            sums = np.zeros((begin[-1], dims))
            met = np.zeros(begin[-1], bool)
            for _, unit in _units(batches, vector):
                steps = np.rint(unit * SUM_STEPS)
                for at, centres in zip(begin, fits):
                    cell = at + np.argmax(unit @ centres.T, axis=1)
                    order = np.argsort(cell, kind="stable")
                    some, first = np.unique(cell[order], return_index=True)
                    sums[some] += np.add.reduceat(steps[order], first)
                    met[some] = True
            if met.any():
                yield pd.DataFrame({"cell": np.flatnonzero(met).astype("int32"), "s": list(sums[met])})

        def whole(part: pa.Table) -> pa.Table:
            return pa.table({"cell": part["cell"][:1], "s": pa.array([_stack(part["s"]).sum(0)], pa.list_(pa.float64()))})

        parts = given.select(vector).mapInPandas(partial, "cell INT, s ARRAY<DOUBLE>")
        found = parts.groupBy("cell").applyInArrow(whole, "cell INT, s ARRAY<DOUBLE>").collect()  # one row for each centre
        fits = [centres.copy() for centres in fits]
        for cell, total in found:
            i = int(np.searchsorted(begin, cell, "right")) - 1
            norm = np.linalg.norm(total)
            if norm > 0:
                fits[i][cell - begin[i]] = np.array(total) / norm
    return fits


def _places(pairs: DataFrame, given: DataFrame, asked: DataFrame, key: str, vector: str, fits: list[np.ndarray]) -> list[np.ndarray]:
    """For each fit, how many of the pairs (query_id, key) have the row's cell at each place of the query's order of cells."""

    def homes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, unit in _units(batches, vector):
            yield pd.DataFrame({key: pdf[key], "homes": list(np.stack([np.argmax(unit @ c.T, axis=1) for c in fits], axis=1).astype("int32"))})

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = [np.zeros(len(c), int) for c in fits]
        for pdf, unit in _units(batches, "q"):
            home = np.stack(pdf["homes"].to_numpy())
            for at in range(0, len(unit), BLOCK_QUERIES):
                some = slice(at, at + BLOCK_QUERIES)
                for i, c in enumerate(fits):
                    near, own = unit[some] @ c.T, home[some, i, None]
                    similar = np.take_along_axis(near, own, axis=1)
                    place = ((near > similar) | ((near == similar) & (np.arange(len(c)) < own))).sum(axis=1)
                    counts[i] += np.bincount(place, minlength=len(c))
        for i, n in enumerate(counts):
            at = np.flatnonzero(n)
            yield pd.DataFrame({"fit": np.full(len(at), i, "int32"), "place": at.astype("int32"), "n": n[at]})

    rows = given.select(key, vector).mapInPandas(homes, f"{key} BIGINT, homes ARRAY<INT>")
    queries = asked.filter(F.col(vector).isNotNull()).select(F.col(key).alias("query_id"), F.col(vector).alias("q"))
    met = pairs.select("query_id", key).join(rows.hint("merge"), key).join(queries.hint("merge"), "query_id").select("q", "homes")
    found = met.mapInPandas(placed, "fit INT, place INT, n BIGINT").groupBy("fit", "place").agg(F.sum("n").alias("n")).collect()  # at most one row for each centre
    out = [np.zeros(len(c), int) for c in fits]
    for r in found:
        out[r["fit"]][r["place"]] = r["n"]
    return out


def fit_cells(
    base: DataFrame, key: str, vector: str, k: int, recall: float = 0.95, queries: DataFrame | None = None, exact: DataFrame | None = None
) -> Cells:
    """Centres by k-means over every row, and the least probes that reach ``recall`` over all ``queries`` (every row asks if none are given).

    ``exact`` has the k + 1 nearest of every query, as ``exact_nearest`` gives them; the first is the query itself.
    Of a table of more than FIT_ROWS rows, the number of cells is doubled up to the square root of the counted rows; that which leaves a query
    the fewest rows to meet is taken. k-means begins at rows picked by hash of the key.
    """
    given = base.filter(F.col(vector).isNotNull())
    count = given.count()
    directed = given.filter(F.exists(vector, lambda v: v != 0) & ~F.exists(vector, lambda v: v.isNull() | F.isnan(v)))
    picked = directed.select(key, vector).orderBy(F.xxhash64(key), key).limit(FIT_ROWS).collect()
    x = _unit(np.array([r[1] for r in picked], dtype="float64").reshape(len(picked), -1)) if picked else np.zeros((0, 1))
    if not len(x):
        return ONE_CELL
    sizes = [max(1, len(x) // ROWS_PER_CELL)]
    while count > FIT_ROWS and 2 * sizes[-1] <= min(MOST_CELLS, len(x), round(count**0.5)):
        sizes.append(2 * sizes[-1])
    fits = _centres_of_all(given, vector, x, sizes) if count > FIT_ROWS else [_centres(x, sizes[0])]  # else ``x`` is the whole table
    asked = given if queries is None else queries
    near = exact_nearest(base, asked, key, vector, k + 1) if exact is None else exact
    best, least = None, np.inf
    for centres, places in zip(fits, _places(near.filter("place > 1"), given, asked, key, vector, fits)):
        n, met = len(centres), places.sum()
        reached = np.cumsum(places) / met if met else np.ones(n)
        probes = 1 + int(np.argmax(reached >= recall))
        cost = probes * (count / n + PROBE_ROWS) + n
        if cost < least:
            best, least = Cells(centres, probes), cost
    return best


def _with_cells(rows: DataFrame, key: str, vector: str, cells: Cells, n: int) -> DataFrame:
    """(key, v, cells): unit vectors and their ``n`` nearest cells; rows without a direction are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, unit in _units(batches, vector):
            yield pd.DataFrame({key: pdf[key], "v": list(unit), "cells": list(cells.nearest(unit, n))})

    return rows.filter(F.col(vector).isNotNull()).select(key, vector).mapInPandas(run, f"{key} BIGINT, v ARRAY<DOUBLE>, cells ARRAY<INT>")


class CellIndex:
    """Every row of a table under its nearest centre, on shared files; cells of many rows are dealt over parts."""

    def __init__(self, base: DataFrame, key: str, vector: str, cells: Cells):
        self.key, self.cells = key, cells
        rows = _with_cells(base, key, vector, cells, 1).select(key, "v", F.col("cells")[0].alias("cell"))
        rows = cut_lineage(rows, "cells")
        parts = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("parts"))
        self.parts = cut_lineage(parts, "cell-parts")  # one row for each centre
        part = F.pmod(F.xxhash64(key), F.col("parts")).cast("int").alias("part")
        self.rows = rows.join(F.broadcast(self.parts), "cell").select("cell", part, F.col(key), "v")

    def search(self, queries: DataFrame, key: str, vector: str, k: int) -> DataFrame:
        """(query_id, key, distance, place): the k nearest rows of the probed cells, for each row of a table of queries.

        The queries of a cell meet a part of its rows as matrix products, and each hands on the k best of the part (ties included).
        Cells of very many queries are dealt over tasks by query too.
        """
        asked = _with_cells(queries, key, vector, self.cells, self.cells.probes).select(F.col(key).alias("query_id"), F.col("v").alias("q"), F.explode("cells").alias("cell"))
        asked = cut_lineage(asked, "probes")
        blocks = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PART_QUERIES).cast("int").alias("blocks"))
        dealt = F.broadcast(cut_lineage(self.parts.join(blocks, "cell"), "cell-blocks"))  # one row for each centre
        block = F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int").alias("block")
        probes = asked.join(dealt, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), block, "query_id", "q")
        rows = self.rows.join(dealt.select("cell", "blocks"), "cell").select("cell", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), self.key, "v")
        name = self.key
        schema = f"query_id BIGINT, {name} BIGINT, distance DOUBLE"

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            out = [pa.table({"query_id": pa.array([], pa.int64()), name: pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})]
            if left.num_rows and right.num_rows:
                m, x = _stack(left["q"]), _stack(right["v"])
                keys = right[name].fill_null(np.iinfo("int64").min).to_numpy()  # before all others, as in top_per_group
                for at in range(0, len(m), BLOCK_QUERIES):
                    dist = np.round(1.0 - m[at : at + BLOCK_QUERIES] @ x.T, 9)
                    q, row = _first(dist, keys, k)
                    out.append(pa.table({"query_id": left["query_id"].take(at + q), name: right[name].take(row), "distance": dist[q, row]}))
            return pa.concat_tables(out)

        by = ["cell", "part", "block"]
        met = probes.groupBy(*by).cogroup(rows.groupBy(*by)).applyInArrow(meet, schema)
        return top_per_group(met, ["query_id"], [("distance", "asc"), (name, "asc")], k, "place")


def _stack(vectors: pa.ChunkedArray) -> np.ndarray:
    """(rows, dims) of a column of vectors of one length."""
    flat = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1)


def _first(dist: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` smallest values of each row, of equal ones those of least key."""
    q, at = _best(dist, k)
    order = np.lexsort((keys[at], dist[q, at], q))
    q, at = q[order], at[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], at[place < k]


def exact_nearest(base: DataFrame, queries: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(query_id, key, distance, place): the k nearest of all rows, for each row of a table of queries."""
    return CellIndex(base, key, vector, ONE_CELL).search(queries, key, vector, k)


def recall_of(found: DataFrame, base: DataFrame, queries: DataFrame, key: str, vector: str, k: int, exact: DataFrame | None = None) -> DataFrame:
    """One row (recall, asked): the share of the exact k nearest that ``found`` has, over every query. ``exact`` may have more than k for each."""
    known = exact_nearest(base, queries, key, vector, k) if exact is None else exact.filter(F.col("place") <= k)
    hit = found.select("query_id", key, F.lit(1).alias("hit"))
    met = known.select("query_id", key).join(hit.hint("merge"), ["query_id", key], "left")
    return met.agg((F.count("hit") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("recall"), F.countDistinct("query_id").alias("asked"))


def fill_vectors(rows: DataFrame, key: str, text: str, embed: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """(key, embedding) for pending rows, in Arrow batches, by a given local embedder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not pdf.empty:
                yield pd.DataFrame({key: pdf[key], "embedding": list(embed(pdf[text].tolist()))})

    return rows.select(key, text).mapInPandas(run, f"{key} BIGINT, embedding ARRAY<FLOAT>")


def letter_embedder(dims: int) -> Callable[[list[str]], np.ndarray]:
    """A stand-in embedder: normalised counts of byte values modulo ``dims`` over the whole text."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dims), dtype="float32")
        for i, s in enumerate(texts):
            counts = np.bincount(np.frombuffer(s.encode(), dtype="uint8") % dims, minlength=dims)
            out[i] = counts / max(np.linalg.norm(counts), 1.0)
        return out

    return embed
