"""Hard negatives against every score, with small tiles so that boxes are pruned and many tiles meet."""

import math
import random

import numpy as np
import pytest

from sparkwell.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, row string, v int"


@pytest.fixture
def small(monkeypatch):
    for name, value in {"LEAF": 4, "FAN": 2, "NODES": 2, "TILE_ROWS": 16, "SLAB_ROWS": 64, "BLOCK_TILES": 3}.items():
        monkeypatch.setattr(hn, name, value)


def plain(rows, every=50):
    kept = []
    for vec_id, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label))
    out = set()
    order = lambda s, r: (-s, math.inf if r[0] is None else r[0])
    for i, a in enumerate(kept):
        if a[0] is None or a[0] % every:
            continue
        scored = [(sum(x * y for x, y in zip(a[1], r[1])), r) for j, r in enumerate(kept) if j != i]
        scored.sort(key=lambda x: order(*x))
        for ps, p in [x for x in scored if x[1][2] == a[2]][:5]:
            hits = [(s, r) for s, r in scored if r[2] != a[2] and 50 * ps <= 100 * s <= 95 * ps]
            out |= {(a[0], p[0], k + 1, r[0], ps, s) for k, (s, r) in enumerate(hits[:3])}
    return out


def found(spark, rows, every=50):
    df = spark.createDataFrame([(*r, 1.0, "x", 2) for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in hn.mine(df, every).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_copies_and_ties(spark, small, seed):
    """A third of the rows are copies of one vector; others are near a few centres, with equal scores."""
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(4, 6))
    rows = []
    for i in range(330):
        v = centres[0] if i % 3 == 0 else np.round(centres[rnd.integers(4)] + rnd.normal(size=6) * 0.2, 1)
        rows.append((i, [float(x) for x in v], int(rnd.integers(3))))
    assert found(spark, rows, 10) == plain(rows, 10)


def test_small_slabs_share_tiles(spark, small, monkeypatch):
    """More slabs than tiles: a cluster may deal out many partitions, and no tile is smaller for it."""
    monkeypatch.setattr(hn, "SLAB_ROWS", 5)
    rnd = random.Random(7)
    rows = [(i, [round(rnd.uniform(-1, 1), 1) for _ in range(3)], rnd.randrange(3)) for i in range(150)]
    df = spark.createDataFrame([(*r, 1.0, "x", 2) for r in rows], SCHEMA)
    vectors = hn.stored(hn.quantised(df), "test-vectors")
    tiles = hn.index(vectors, hn.shape_of(vectors)).select("tile", "n").collect()
    assert sum(t.n for t in tiles) == 150 and sorted(t.tile for t in tiles) == list(range(len(tiles))) and len(tiles) <= 12
    assert found(spark, rows, 10) == plain(rows, 10)


def test_negative_scores_nulls_and_lengths(spark, small):
    rnd = random.Random(4)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(3)], rnd.randrange(2)) for i in range(60)]
    rows += [(100, None, 1), (101, [0.5, None, 1.0], 1), (102, [float("nan")] * 3, 0), (103, [float("inf"), 0.0, 0.0], 0), (50, [1.0, 1.0, 1.0], None)]
    rows += [(None, [0.9, 0.9, 0.9], 0), (150, [0.3], 1), (200, [], 0), (250, [0.0, 0.0, 0.0, 0.0, 2.0], 1)]
    got = found(spark, rows, 5)
    assert got == plain(rows, 5) and got


def test_no_join_gathers_anchors_or_tiles_in_the_driver(spark, small, monkeypatch):
    """Files of packed vectors look small to the planner, and so does a list of anchors before it is dealt out to every tile."""
    plans = {}

    def noted(df, label, keep=hn.stored):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return keep(df, label)

    monkeypatch.setattr(hn, "stored", noted)
    df = spark.createDataFrame([(i, [math.cos(i), math.sin(i)], i % 3, 1.0, "x", 2) for i in range(120)], SCHEMA)
    out = hn.mine(df, 10)
    plans["result"] = out._jdf.queryExecution().executedPlan().toString()
    assert out.count()
    plans.pop("rtree-tiles")  # takes a number for each slab
    assert sum("Join" in p for p in plans.values()) >= 5
    assert [label for label, p in plans.items() if "Broadcast" in p] == []


def test_repeated_rows(spark, small):
    rows = [(0, [1.0, 0.0], 1)] * 2 + [(i, [1.0 - i / 100, 0.1], i % 2) for i in range(1, 40)]
    assert found(spark, rows) == plain(rows)


def test_large_components_are_exact_and_overflow_is_refused(spark, small):
    rows = [(i, [1e5 + i * 97.0, -3e4 - i], i % 3) for i in range(60)]
    assert found(spark, rows, 10) == plain(rows, 10)
    with pytest.raises(ArithmeticError):
        found(spark, [(0, [1e30], 1), (1, [1e30], 2)])


def test_few_rows_and_no_rows(spark):
    assert found(spark, []) == set()
    assert found(spark, [(50, [1.0], 1)]) == set()
    assert found(spark, [(50, [1.0], 1), (51, [1.0], 1)]) == set()
    assert found(spark, [(50, [], 1), (51, [], 1), (53, [], 2)]) == {(50, 51, 1, 53, 0, 0)}


def test_boxes_are_pruned(monkeypatch):
    """Clustered rows: the search scores few leaves, and the same rows as a full scan."""
    rnd = np.random.default_rng(0)
    v = np.repeat(rnd.integers(-200, 200, size=(64, 8)), 64, 0) + rnd.integers(-3, 4, size=(4096, 8))
    ids = np.arange(4096)
    order = hn._packed(v, ids, list(range(3)))
    row = {"n": 4096, "dim": 8, "ids": ids[order].tobytes(), "rows": ids[order].tobytes(), "labels": (ids[order] % 2).tobytes(), "vectors": v[order].tobytes()}
    tile = hn.Tile(row, True)
    scored = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            scored.append(np.size(key))
            return super().__getitem__(key)

    q = v[7].astype(float)
    tile.v = tile.v.view(Counted)
    w = hn.Wanted(0, -hn._NEVER, hn._NEVER, 5, [])
    hn.search(tile, q, [w], np.ones(4096, bool))
    scores = v @ v[7]
    best = np.lexsort((ids, -scores))[:5]
    assert sorted((s, i) for s, i, _ in w.found) == sorted((int(scores[i]), -int(i)) for i in best)
    assert sum(scored) < 4096 / 4
