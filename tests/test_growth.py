"""Steps whose cost must not grow faster than their input."""

import random

import numpy as np
import pytest

from sparkwell import session
from sparkwell.operators import graph, pairs, stock, vectors
from sparkwell.plans import business
from sparkwell.tables import Tables


def test_more_rows_get_more_cells(spark):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(200, 16))
    rows = [(i, (centres[i % 200] + rnd.normal(size=16) * 0.1).tolist()) for i in range(20_000)]
    base = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    cells = vectors.fit_cells(base, "vec_id", "embedding", 5)
    assert len(cells.centres) > vectors.FIT_ROWS // 64 and cells.probes <= len(cells.centres) / 4


def test_queries_of_a_cell_are_dealt_over_parts(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PART_ROWS", 50)
    monkeypatch.setattr(vectors, "PART_QUERIES", 20)
    monkeypatch.setattr(vectors, "BLOCK_QUERIES", 7)
    rnd = np.random.default_rng(5)
    x = np.round(rnd.normal(size=(400, 3)), 1)
    base = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    index = vectors.CellIndex(base, "vec_id", "embedding", vectors.Cells(np.eye(3), 3))  # every cell is probed
    got = sorted((r.query_id, r.place, r.vec_id) for r in index.search(base, "vec_id", "embedding", 4).collect())
    ids = np.flatnonzero(np.linalg.norm(x, axis=1) > 0)
    u = x[ids] / np.linalg.norm(x[ids], axis=1, keepdims=True)
    dist = np.round(1 - u @ u.T, 9)
    want = [(int(q), n + 1, int(ids[c])) for i, q in enumerate(ids) for n, c in enumerate(np.lexsort((ids, dist[i]))[:4])]
    assert got == sorted(want)


@pytest.mark.parametrize(("heavy", "block", "most"), [(10_000, 1000, 1_000_000), (10_000, 4, 3), (6, 4, 1_000_000), (10, 3, 5)])
def test_overlapping_pairs_by_lists(spark, monkeypatch, heavy, block, most):
    monkeypatch.setattr(pairs, "PAIRS", most)
    rng = random.Random(heavy + block)
    member = {(m, g): rng.randrange(1, 5) for m in range(25) for g in range(20) if rng.random() < (0.9 if g < 3 else 0.2)}
    want = []
    for a in range(25):
        for b in range(a + 1, 25):
            common = [g for g in range(20) if (a, g) in member and (b, g) in member]
            if len(common) >= 3:
                want.append((a, b, len(common), sum(member[a, g] + member[b, g] for g in common)))
    df = spark.createDataFrame([(m, g, w) for (m, g), w in member.items()], "m BIGINT, g BIGINT, w BIGINT")
    found = pairs.overlapping_pairs(df, "m", "g", "w", 3, heavy, block)
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_pairs_without_set_aside_groups_cross_no_exchange_after_they_are_made(spark):
    df = spark.createDataFrame([(m, g, 1) for m in range(9) for g in range(5)], "m BIGINT, g BIGINT, w BIGINT")
    plan = pairs.overlapping_pairs(df, "m", "g", "w", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("explode(arrays_zip") < plan.index("REPARTITION_BY_NUM") and "SortMergeJoin" not in plan


def test_decided_orders_leave_the_table(spark, monkeypatch):
    written = []

    def cut(df, label="cut"):
        found = session.cut_lineage(df, label)
        written.append(found.count())
        return found

    monkeypatch.setattr(stock, "cut_lineage", cut)
    # order 0 fits at once; each later one waits for the verdict on the one before
    lines = spark.createDataFrame(
        [(o, o, p, 6) for o in range(8) for p in (o, o + 1)] + [(100 + o, 0, 50 + o, 1) for o in range(200)], "order_id BIGINT, arrival BIGINT, product_id BIGINT, quantity BIGINT"
    )
    limits = spark.createDataFrame([(p, 10) for p in range(300)], "product_id BIGINT, stock BIGINT")
    got = {r.order_id: r.accepted for r in stock.admit_orders(lines, limits).collect()}
    assert got == {o: o % 2 == 0 for o in range(8)} | {100 + o: True for o in range(200)}
    assert len(written) > 3 and max(written[2:]) < 20


def test_tasks_of_pair_weights_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(graph, "MEMBERS_PER_TASK", 10)
    lines = spark.createDataFrame([(o, i) for o in range(60) for i in range(3)], "o BIGINT, i BIGINT")
    edges = graph.copurchase_edges(lines, "o", "i")
    assert "18), REPARTITION_BY_NUM" in edges._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in edges.collect()} == {(0, 1, 60), (0, 2, 60), (1, 2, 60)}


def test_shuffles_start_with_more_partitions_than_cores(spark):
    kept = {x: spark.conf.get(x, None) for x in ("spark.sql.shuffle.partitions", session.FIRST_PARTITIONS_CONF)}
    try:
        spark.conf.unset(session.FIRST_PARTITIONS_CONF)
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        session.prepare(spark)
        cores = spark.sparkContext.defaultParallelism
        assert (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get(session.FIRST_PARTITIONS_CONF)) == (str(cores), str(32 * cores))
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_lines_of_rides_meet_no_customer(spark, sf_dir):
    """The wide lines are shuffled for the join with orders only."""
    plan = business.ride_months(Tables(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("l_suppkey") < plan.index("o_custkey") and "(o_custkey" in plan.split("l_orderkey", 2)[2]
