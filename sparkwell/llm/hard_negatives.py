"""Hard-negative mining over an STR-packed R-tree.

Rows are sorted by the coordinate of largest variance into slabs (a range exchange, ties broken by row, so that copies
of one vector do not pile up), and each slab is packed by sort-tile-recursion over the next
coordinates: strips, strips of strips, and leaves of ``LEAF`` rows. ``FAN`` leaves make a node, ``NODES`` nodes a
tile, and a tile with its boxes is one row of the stored index.

For an anchor q and a box [lo, hi], each coordinate's product lies between q*lo and q*hi, so the sums of the lesser and of
the greater ones bound every inner product in the box. Best-first search pops the node of largest
upper bound; a box goes if it lies outside the score window, if its upper bound is strictly below the kth best so far, or if it
equals that and all its ids are larger. The kth best starts from the anchor's own tile, which is searched first.

Anchors go in blocks to every tile: the query set is stated, and no two rows are compared otherwise.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwell.llm.common import stored

LEAF, FAN, NODES = 64, 8, 8
TILE_ROWS = LEAF * FAN * NODES
SLAB_ROWS = 8 * TILE_ROWS
#: Coordinates by which a slab is packed, after the one that makes the slabs.
PACKED_BY = 3
#: Neighbouring tiles whose anchors make one block.
BLOCK_TILES = 16
#: Leaves whose rows are scored at once.
GULP = 4

POSITIVES, NEGATIVES = 5, 3
LEAST_PERCENT, MOST_PERCENT = 50, 95

_NEVER = np.iinfo(np.int64).max
TILE_SCHEMA = "tile int, dim int, n int, ids binary, rows binary, labels binary, vectors binary"
HIT_SCHEMA = "anchor bigint, wanted bigint, score bigint, vec_id bigint, row bigint"


def quantised(rows: DataFrame) -> DataFrame:
    """(row, vec_id, label, v): the rows that take part, components as floor(256 * x), ids divisible by 7 with the next label."""
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.select("vec_id", "embedding", "label").filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label").cast("bigint"))
    v = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    return kept.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), v.alias("v"))


def _matrix(column, dim: int) -> np.ndarray:
    """Vectors as integers; shorter ones end in zeros."""
    sizes = np.asarray(column.value_lengths())
    out = np.zeros((len(column), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = np.asarray(column.flatten())
    return out


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(0)
        if not len(column):
            continue
        dim = int(np.max(np.asarray(column.value_lengths())))
        v = _matrix(column, dim).astype(float)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dim, dtype=np.int32)), pa.array(v.sum(0)), pa.array((v * v).sum(0)), pa.array(np.abs(v).max(0, initial=0))], names=["c", "s", "s2", "most"]
        )


@dataclass
class Shape:
    n: int
    order: list[int]  # coordinates by variance, largest first
    exact: bool  # whether inner products are exact in doubles
    kind: str  # the shortest integers that hold every component

    @property
    def dim(self) -> int:
        return len(self.order)


def shape_of(vectors: DataFrame) -> Shape:
    """Rows, coordinates by variance over all rows, and the range of inner products: one row for each coordinate."""
    n = vectors.count()
    by = vectors.select("v").mapInArrow(_moments, "c int, s double, s2 double, most double").groupBy("c")
    found = by.agg(F.sum("s").alias("s"), F.sum("s2").alias("s2"), F.max("most").alias("most")).orderBy("c").collect()
    if sum(r["most"] ** 2 for r in found) >= 2**55:
        raise ArithmeticError("inner products of these vectors and their hundredfold may not fit a long")
    variance = {r["c"]: r["s2"] / n - (r["s"] / n) ** 2 for r in found}
    most = max((r["most"] for r in found), default=0)
    kind = "i2" if most < 2**15 else "i4"  # larger ones were refused
    return Shape(n, sorted(variance, key=lambda c: (-variance[c], c)), sum(r["most"] ** 2 for r in found) < 2**52, kind)


def _components(raw: bytes, rows: int, dim: int) -> np.ndarray:
    """(rows, dim) of stored vectors; their length tells how long an integer is."""
    return np.frombuffer(raw, f"i{len(raw) // (rows * dim)}").reshape(rows, dim) if raw else np.zeros((rows, dim), np.int64)


def _packed(v: np.ndarray, ids: np.ndarray, order: list[int]) -> np.ndarray:
    """The rows in the order of their leaves: strips by one coordinate, each packed by the next ones."""

    def pack(at: np.ndarray, by: list[int]) -> list[np.ndarray]:
        if len(at) <= LEAF or not by:
            return [at[np.argsort(ids[at], kind="stable")]]
        at = at[np.lexsort((ids[at], v[at, by[0]]))]
        strips = int(np.ceil(np.ceil(len(at) / LEAF) ** (1 / len(by))))
        size = int(np.ceil(len(at) / strips / LEAF)) * LEAF
        return [part for begin in range(0, len(at), size) for part in pack(at[begin : begin + size], by[1:])]

    return np.concatenate(pack(np.arange(len(ids)), order))


def _tiles(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # a slab: SLAB_ROWS rows, as the range exchange estimates it
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        column = lambda name: rows.column(name).chunk(0)
        v = _matrix(column("v"), shape.dim)
        ids = column("vec_id").fill_null(_NEVER).to_numpy(zero_copy_only=False)
        order = _packed(v, ids, shape.order[1 : 1 + PACKED_BY] or shape.order[:1])
        first = TaskContext.get().partitionId()
        keys, labels = column("row").to_numpy(), column("label").to_numpy()
        for i, begin in enumerate(range(0, len(order), TILE_ROWS)):
            at = order[begin : begin + TILE_ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.array([first], pa.int32()), pa.array([i], pa.int32()), pa.array([shape.dim], pa.int32()), pa.array([len(at)], pa.int32())]
                + [pa.array([x[at].tobytes()], pa.binary()) for x in (ids, keys, labels, v.astype(shape.kind))],
                names=["slab", "part", "dim", "n", "ids", "rows", "labels", "vectors"],
            )

    return run


def index(vectors: DataFrame, shape: Shape) -> DataFrame:
    """The stored tiles, numbered by slab and by place in the slab; slabs of less than a tile share tiles with their neighbours."""
    slabs = max(1, -(-shape.n // SLAB_ROWS))
    widest = F.coalesce(F.get("v", F.lit(shape.order[0] if shape.order else 0)), F.lit(0))
    dealt = vectors.withColumn("widest", widest).repartitionByRange(slabs, "widest", "row").drop("widest")
    found = stored(dealt.mapInArrow(_tiles(shape), "slab int, part int, " + TILE_SCHEMA.removeprefix("tile int, ")), "rtree-slabs")
    # a row for each slab
    sizes = found.groupBy("slab").agg(F.sum("n").alias("size"), F.max("part").alias("most"))
    sizes = sizes.withColumn("small", F.col("size") < TILE_ROWS)
    before = Window.partitionBy("small").orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.coalesce(F.sum(F.when(F.col("small"), F.col("size")).otherwise(F.col("most") + 1)).over(before), F.lit(0))
    placed = stored(sizes.select("slab", "small", F.when(F.col("small"), F.floor(begun / TILE_ROWS)).otherwise(begun).cast("int").alias("first")), "rtree-sizes")
    shared = placed.filter("small").agg(F.coalesce(F.max("first") + 1, F.lit(0))).head()[0]
    numbered = found.join(F.broadcast(placed), "slab").withColumn("tile", F.when(F.col("small"), F.col("first")).otherwise(F.col("first") + F.col("part") + shared))
    columns = [c.split()[0] for c in TILE_SCHEMA.split(", ")]
    alone = numbered.filter(~F.col("small")).select(columns)
    joined = lambda name: F.expr(f"aggregate(parts, X'', (a, p) -> concat(a, p.{name}))").alias(name)
    parts = F.sort_array(F.collect_list(F.struct("slab", "ids", "rows", "labels", "vectors"))).alias("parts")  # less than two tiles of rows
    together = numbered.filter("small").groupBy("tile", "dim").agg(F.sum("n").cast("int").alias("n"), parts)
    return alone.unionByName(together.select("tile", "dim", "n", *map(joined, ("ids", "rows", "labels", "vectors"))))


class Tile:
    """The rows of a tile and the boxes of its leaves, nodes and itself."""

    def __init__(self, row: dict, exact: bool):
        one = lambda name: np.frombuffer(row[name], np.int64)
        self.ids, self.rows, self.labels = one("ids"), one("rows"), one("labels")
        v = _components(row["vectors"], row["n"], row["dim"])
        self.v = v.astype(np.float64 if exact else np.int64)
        leaf = np.arange(0, len(self.v), LEAF)
        self.leaves = self._boxes(self.v, self.v, self.ids, leaf)
        self.nodes = self._boxes(*self.leaves, np.arange(0, len(leaf), FAN))

    @staticmethod
    def _boxes(lo, hi, least, begin):
        return np.minimum.reduceat(lo, begin), np.maximum.reduceat(hi, begin), np.minimum.reduceat(least, begin)


@dataclass
class Wanted:
    """One wanted list of an anchor: the k best rows with a score in [least, most]."""

    wanted: int
    least: int
    most: int
    k: int
    found: list[tuple]  # (score, -id, -row), a heap of at most k

    def floor(self) -> tuple:
        """What a row must beat: (score, -id)."""
        return self.found[0][:2] if len(self.found) == self.k else (self.least, -_NEVER)


def search(tile: Tile, q: np.ndarray, windows: list[Wanted], allowed: np.ndarray) -> None:
    """Best-first through the tile; rows outside ``allowed`` take no part. Adds what it finds to the windows."""
    positive, negative = np.maximum(q, 0), np.minimum(q, 0)

    def bounds(boxes, at):
        lo, hi = boxes[0][at], boxes[1][at]
        return hi @ positive + lo @ negative, lo @ positive + hi @ negative

    def open_(upper, lower, least_id) -> bool:
        for w in windows:
            if lower <= w.most:
                top = min(upper, w.most)
                score, against = w.floor()
                if top > score or (top == score and -least_id >= against):
                    return True
        return False

    queue = []

    def push(boxes, at, leaf: bool) -> None:
        upper, lower = bounds(boxes, at)
        for u, low, i in zip(upper.tolist(), lower.tolist(), range(at.start, at.stop)):
            if open_(u, low, int(boxes[2][i])):
                heapq.heappush(queue, (-u, leaf, i, low))

    push(tile.nodes, slice(0, len(tile.nodes[2])), False)
    while queue:
        gulp = []
        while queue and len(gulp) < GULP:
            upper, leaf, i, lower = heapq.heappop(queue)
            if not open_(-upper, lower, int((tile.leaves if leaf else tile.nodes)[2][i])):
                continue
            if leaf:
                gulp.append(i)
            else:
                push(tile.leaves, slice(i * FAN, min((i + 1) * FAN, len(tile.leaves[2]))), True)
        if not gulp:
            continue
        at = np.concatenate([np.arange(i * LEAF, min((i + 1) * LEAF, len(tile.ids))) for i in gulp])
        at = at[allowed[at]]
        score = tile.v[at] @ q
        for w in windows:
            least = w.floor()[0]
            hit = np.flatnonzero((score >= least) & (score <= w.most))
            if len(hit) > w.k:
                best = np.lexsort((tile.rows[at[hit]], tile.ids[at[hit]], -score[hit]))[: w.k]
                hit = hit[best]
            for j in hit.tolist():
                one = (int(score[j]), -int(tile.ids[at[j]]), -int(tile.rows[at[j]]))
                if len(w.found) < w.k:
                    heapq.heappush(w.found, one)
                elif one > w.found[0]:
                    heapq.heapreplace(w.found, one)


def _search_units(exact: bool, same: bool):
    """Of each (block, tile): the best rows for each window of each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit in range(batch.num_rows):
                row = {name: batch.column(name)[unit].as_py() for name in ("dim", "n", "ids", "rows", "labels", "vectors", "anchors")}
                tile = Tile(row, exact)
                mine = {label: tile.labels == label for label in {a["label"] for a in row["anchors"]}}
                hits = []
                for a in row["anchors"]:
                    q = _components(a["v"], 1, row["dim"])[0]
                    allowed = mine[a["label"]] & (tile.rows != a["row"]) if same else ~mine[a["label"]]
                    # a window starts with what must be reached, known from the own tile
                    windows = [Wanted(w["wanted"], w["least"], w["most"], w["k"], []) for w in a["windows"]]
                    search(tile, q.astype(np.float64 if exact else np.int64), windows, allowed)
                    hits += [(a["row"], w.wanted, s, -i, -r) for w in windows for s, i, r in w.found]
                columns = list(zip(*hits)) if hits else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "wanted", "score", "vec_id", "row"])

    return run


def _anchor_rows(every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit in range(batch.num_rows):
                ids, rows, labels = (np.frombuffer(batch.column(x)[unit].as_py(), np.int64) for x in ("ids", "rows", "labels"))
                v = _components(batch.column("vectors")[unit].as_py(), len(ids), batch.column("dim")[unit].as_py())
                at = np.flatnonzero((ids % every == 0) & (ids != _NEVER))
                tiles = np.full(len(at), batch.column("tile")[unit].as_py(), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tiles), pa.array(rows[at]), pa.array(ids[at]), pa.array(labels[at]), pa.array([x.tobytes() for x in v[at]], pa.binary())],
                    names=["home", "row", "vec_id", "label", "v"],
                )

    return run


def _shuffled(one: DataFrame, other: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join that never gathers a side in the driver. The planner would, by the size of files of packed vectors or of a list before it is
    dealt out to every tile, and what it sends grows with anchors times tiles."""
    return one.join(other.hint("merge"), on, how)


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The k best rows for each wanted list, numbered from 1."""
    place = Window.partitionBy("anchor", "wanted").orderBy(F.desc("score"), "vec_id", "row")
    return hits.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def _find(tiles: DataFrame, anchors: DataFrame, windows: DataFrame, k: int, same: bool, exact: bool, last: int) -> DataFrame:
    """(anchor, wanted, rank, score, vec_id, row) for windows (row, wanted, least, most): first the own tile, then all others."""

    def hits(wanted: DataFrame, other: bool) -> DataFrame:
        window = F.struct("wanted", "least", "most", F.lit(k).alias("k"))
        each = wanted.groupBy("row").agg(F.collect_list(window).alias("windows"))  # at most POSITIVES
        ready = _shuffled(anchors, each, "row")
        # the anchors of neighbouring tiles together; at most BLOCK_TILES * TILE_ROWS of them
        group = F.floor(F.col("home") / BLOCK_TILES) if other else F.col("home")
        blocks = ready.withColumn("block", group).groupBy("block", "home").agg(F.collect_list(F.struct("row", "label", "v", "windows")).alias("anchors"))
        if other:
            blocks = blocks.groupBy("block").agg(F.flatten(F.collect_list("anchors")).alias("anchors"))
            blocks = blocks.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(last))))
        else:
            blocks = blocks.withColumnRenamed("home", "tile")
        units = _shuffled(blocks, tiles, "tile").select("dim", "n", "ids", "rows", "labels", "vectors", "anchors")
        return units.mapInArrow(_search_units(exact, same), HIT_SCHEMA)

    near = stored(_best(hits(windows, False), k), f"rtree-home-{same}")
    # with k found at home, nothing below the kth of them can be among the k best
    kth = near.filter(F.col("rank") == k).select(F.col("anchor").alias("row"), "wanted", F.col("score").alias("kth"))
    raised = _shuffled(windows, kth, ["row", "wanted"], "left").withColumn("least", F.greatest("least", "kth")).drop("kth")
    return stored(_best(hits(raised, True), k), f"rtree-all-{same}")


def mine(rows: DataFrame, every: int = 50) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from ``rows`` (vec_id, embedding, label).

    Anchors are the rows whose vec_id is divisible by ``every``. Rows with a null label, a null vector, or a null or
    non-finite component take no part; shorter vectors end in zeros; an empty vector is all zeros. A null vec_id is no anchor and ranks last
    among ties. Repeated rows are rows of their own, and so are repeated anchors, but the result has each
    line once. Vectors whose inner products may not fit a long are refused. An empty table gives an empty result.
    """
    vectors = stored(quantised(rows), "rtree-vectors")
    shape = shape_of(vectors)
    exact = shape.exact
    tiles = stored(index(vectors, shape), "rtree-tiles")
    last = tiles.agg(F.max("tile")).head()[0] or 0
    anchors = stored(tiles.select("tile", "dim", "ids", "rows", "labels", "vectors").mapInArrow(_anchor_rows(every), "home int, row bigint, vec_id bigint, label bigint, v binary"), "rtree-anchors")
    everything = anchors.select("row", F.lit(0).cast("bigint").alias("wanted"), F.lit(-_NEVER).alias("least"), F.lit(_NEVER).alias("most"))
    positives = _find(tiles, anchors, everything, POSITIVES, True, exact, last)
    # the window of a positive depends on its score alone
    windows = positives.select(F.col("anchor").alias("row"), F.col("score").alias("wanted")).distinct()
    windows = windows.withColumns({"least": _ceil_of("wanted", LEAST_PERCENT), "most": _floor_of("wanted", MOST_PERCENT)}).filter("least <= most")
    negatives = _find(tiles, anchors, windows, NEGATIVES, False, exact, last)
    lists = positives.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = _shuffled(lists, negatives.withColumnRenamed("wanted", "positive_score"), ["anchor", "positive_score"])
    found = _shuffled(found, anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    nothing = lambda c: F.when(F.col(c) != _NEVER, F.col(c)).alias(c)
    return found.withColumn("negative_id", F.col("vec_id")).select(
        "anchor_id", nothing("positive_id"), "rank", nothing("negative_id"), "positive_score", F.col("score").alias("negative_score")
    ).distinct()


def _floor_of(score: str, percent: int) -> Column:
    """floor(score * percent / 100) in whole numbers."""
    return F.expr(f"(score_ * {percent} - pmod(score_ * {percent}, 100)) div 100".replace("score_", score))


def _ceil_of(score: str, percent: int) -> Column:
    return -F.expr(f"(-score_ * {percent} - pmod(-score_ * {percent}, 100)) div 100".replace("score_", score))
