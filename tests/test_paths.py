"""Shortest paths and distances against plain searches, and daily sketches against exact answers."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from sparkwell.operators import graph
from sparkwell.operators.sketches import DailySketches


def drawn(seed, nodes=40, edges=70):
    rnd = random.Random(seed)
    return [(rnd.randrange(nodes), rnd.randrange(nodes), rnd.choice([0, 1, 1, 2, 3, 9])) for _ in range(edges)]


def plain_path(edges, source, target):
    near = {}
    for a, b, _ in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    depth, layer = {source: 0}, [source]
    while layer:
        layer = [b for a in layer for b in near.get(a, ()) if b not in depth and not depth.update({b: depth[a] + 1})]
    if target not in depth:
        return None
    path = [target]
    while path[-1] != source:
        path.append(min(b for b in near[path[-1]] if depth.get(b) == depth[path[-1]] - 1))
    return path[::-1]


@pytest.mark.parametrize("seed,source,target", [(1, 0, 17), (2, 3, 31), (3, 5, 5), (4, 0, 99)])
def test_two_sided_search(spark, seed, source, target):
    edges = drawn(seed) + [(50 + i, 51 + i, 1) for i in range(6)]
    node = lambda n: spark.createDataFrame([(n,)], "node BIGINT")
    df = spark.createDataFrame(edges, "src BIGINT, dst BIGINT, weight BIGINT")
    found = [(r.path, r.hops) for r in graph.shortest_path(df, node(source), node(target)).collect()]
    wanted = plain_path(edges, source, target)
    assert found == ([] if wanted is None else [(wanted, len(wanted) - 1)])


def test_two_sided_search_on_a_chain_and_without_a_start(spark):
    df = spark.createDataFrame([(i + 1, i, 1) for i in range(9)], "src BIGINT, dst BIGINT, weight BIGINT")
    node = lambda n: spark.createDataFrame([(n,)], "node BIGINT")
    assert graph.shortest_path(df, node(0), node(9)).collect()[0].path == list(range(10))
    assert graph.shortest_path(df, node(0).limit(0), node(9)).collect() == []


def plain_distances(edges, source):
    dist, queue = {}, [(0, source)]
    while queue:
        d, a = heapq.heappop(queue)
        if a not in dist:
            dist[a] = d
            for x, b, w in edges:
                if x == a:
                    heapq.heappush(queue, (d + w, b))
    return dist


@pytest.mark.parametrize("seed,width", [(1, None), (2, 2), (3, 1)])
def test_delta_stepping(spark, seed, width, monkeypatch):
    monkeypatch.setattr(graph, "MAX_PARTS", 3)
    edges = drawn(seed)
    df = spark.createDataFrame(edges, "src BIGINT, dst BIGINT, weight BIGINT")
    found = graph.weighted_distances(df, spark.createDataFrame([(edges[0][0],)], "node BIGINT"), width)
    assert {r.node: r.dist for r in found.collect()} == plain_distances(edges, edges[0][0])


def test_daily_sketches_beyond_their_exact_range(spark, folder, monkeypatch):
    from sparkwell.operators import sketches

    monkeypatch.setattr(sketches, "REGISTERS", 12)
    monkeypatch.setattr(sketches, "QUANTILES", 400)
    rows = spark.range(60_000).select(
        F.expr("id % 20000").alias("user"), F.expr("CAST(id * 7919 % 60000 AS DOUBLE)").alias("value"),
        F.expr("date_add(DATE '2024-01-01', CAST(id % 10 AS INT))").alias("day"), F.lit("a").alias("kind"),
    )
    kept = DailySketches(spark, folder, "kind STRING")
    kept.load(rows.withColumn("user", F.lit(1)), F.col("day"), "user", "value")
    assert kept.distinct("kind").first().distinct_values == 1
    kept.load(rows, F.col("day"), "user", "value")  # corrected days replace theirs
    one = kept.distinct("kind").first()
    assert abs(one.distinct_values - 20_000) < 20_000 * 0.08 and one.days == 10
    spread = kept.quantiles(["kind"], {"p50": 0.5, "p99": 0.99}).first()
    assert abs(spread.p50 - 30_000) < 60_000 * 0.02 and abs(spread.p99 - 59_400) < 60_000 * 0.02


def test_daily_sketches_of_nulls(spark, folder):
    rows = spark.createDataFrame([("a", None, None, 1), ("b", 5, 2.0, 1)], "kind STRING, user BIGINT, value DOUBLE, d INT")
    kept = DailySketches(spark, folder, "kind STRING")
    kept.load(rows, F.date_add(F.lit("2024-01-01"), F.col("d")), "user", "value")
    assert {r.kind: r.p50 for r in kept.quantiles(["kind"], {"p50": 0.5}).collect()} == {"a": None, "b": 2.0}
    assert {r.kind: r.distinct_values for r in kept.distinct("kind").collect()} == {"a": 0, "b": 1}
