"""Approximate neighbours: recall, whole answers, hot cells, odd rows."""

import numpy as np
import pytest

from sparkwell.operators import vectors
from sparkwell.plans.vectors_text import vector_ann
from sparkwell.tables import Tables

SCHEMA = "vec_id bigint, embedding array<float>"


def exact(rows, queries, k):
    ids = np.array([i for i, v in rows if np.linalg.norm(v) > 0])
    x = np.array([v for _, v in rows if np.linalg.norm(v) > 0], dtype="float32").astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        d = np.round(1 - x @ x[ids == q][0], 9)
        out[q] = set(ids[np.lexsort((ids, d))[:k]].tolist())
    return out


def answers(found):
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    return got


def test_registered_query_reaches_recall(spark, sf_dir):
    rows = vector_ann(Tables(spark, sf_dir)).collect()
    base = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    wanted = exact(base, {i for i, _ in base if i % 50 == 0}, 5)
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert set(got) == set(wanted)
    true = sum(len(got[q] & wanted[q]) for q in wanted) / sum(map(len, wanted.values()))
    assert true >= 0.9
    assert {r["recall"] for r in rows} == {round(true, 6)}  # at most 200 queries here, so all are measured
    assert sum(len(got[q] - {q}) for q in got) >= 4 * 0.9 * len(got)  # an index that returns only the query itself fails


@pytest.fixture
def clustered(spark):
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + rnd.normal(size=16) * 0.15).tolist()) for i in range(4000)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_few_cells_are_probed_where_rows_cluster(clustered):
    rows, base = clustered
    cells = vectors.fit_cells(base, "vec_id", "embedding", 5)
    assert cells.probes <= len(cells.centres) / 4
    index = vectors.CellIndex(base, "vec_id", "embedding", cells)
    queries = base.filter("vec_id % 100 = 0")
    found = index.search(queries, "vec_id", "embedding", 5)
    got, wanted = answers(found), exact(rows, range(0, 4000, 100), 5)
    true = sum(len(got[q] & wanted[q]) for q in wanted) / (5 * len(wanted))
    assert true >= 0.9 and all(q in got[q] for q in wanted)
    assert vectors.recall_of(found, base, queries, "vec_id", "embedding", 5).first()["recall"] == pytest.approx(true)
    # measured recall falls with the answer
    only_itself = found.filter("query_id = vec_id")
    assert vectors.recall_of(only_itself, base, queries, "vec_id", "embedding", 5).first()["recall"] == pytest.approx(0.2)


def test_a_cell_of_copies_is_dealt_over_parts(clustered, spark, monkeypatch):
    rows, _ = clustered
    monkeypatch.setattr(vectors, "PART_ROWS", 100)
    rows = rows[:600] + [(i, rows[0][1]) for i in range(10_000, 11_000)]
    base = spark.createDataFrame(rows, SCHEMA)
    index = vectors.CellIndex(base, "vec_id", "embedding", vectors.fit_cells(base, "vec_id", "embedding", 3))
    assert index.parts.agg({"parts": "max"}).first()[0] >= 10
    assert index.rows.select("cell", "part").distinct().count() > index.parts.count()
    found = answers(index.search(base.filter("vec_id IN (0, 5, 10500)"), "vec_id", "embedding", 3))
    assert found[0] == found[10500] == {0, 10000, 10001} and 5 in found[5]


def test_many_queries_odd_rows_and_no_rows(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, rnd.normal(size=4).tolist()) for i in range(1500)] + [(9001, [0.0] * 4), (9002, None)]
    base = spark.createDataFrame(rows, SCHEMA)
    cells = vectors.fit_cells(base, "vec_id", "embedding", 1)
    found = answers(vectors.CellIndex(base, "vec_id", "embedding", cells).search(base, "vec_id", "embedding", 1))
    assert found == {i: {i} for i in range(1500)}  # more queries than the driver would take
    none = base.filter("vec_id < 0")
    cells = vectors.fit_cells(none, "vec_id", "embedding", 5)
    assert vectors.CellIndex(none, "vec_id", "embedding", cells).search(none, "vec_id", "embedding", 5).collect() == []


def test_recall_is_that_of_every_query(clustered):
    """More queries than could be picked: those whose answers are missing count too."""
    rows, base = clustered
    queries = base.filter("vec_id < 500")
    nearest = vectors.exact_nearest(base, queries, "vec_id", "embedding", 2)
    some = nearest.filter("query_id % 5 = 0")
    got = vectors.recall_of(some, base, queries, "vec_id", "embedding", 2).first()
    assert got["asked"] == 500 and got["recall"] == pytest.approx(0.2)
    assert answers(nearest) == exact(rows, range(500), 2)


def test_centres_and_probes_are_of_every_row_and_query(clustered, spark, monkeypatch):
    rows, base = clustered
    monkeypatch.setattr(vectors, "FIT_ROWS", 256)
    nowhere = spark.createDataFrame([(9001, [0.0] * 16), (9002, None)], SCHEMA)  # partitions without a vector to fit
    base = base.repartition(5).unionByName(nowhere)
    queries = base.filter("vec_id % 3 = 0")
    cells = vectors.fit_cells(base, "vec_id", "embedding", 5, queries=queries)
    n = len(cells.centres)
    order = [r[0] for r in base.selectExpr("vec_id", "xxhash64(vec_id) AS h").orderBy("h").collect() if r[0] < 4000]
    x = np.array([v for _, v in rows], dtype="float32").astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert np.allclose(cells.centres, vectors._centres(x[order], n), atol=1e-6)  # k-means over the whole table, from the same rows
    near = x[::3] @ x.T
    near[np.arange(len(near)), np.arange(0, len(x), 3)] = np.inf
    near = np.argsort(-near, axis=1, kind="stable")[:, 1:6]
    home, place = cells.nearest(x, 1)[:, 0], np.argsort(cells.nearest(x[::3], n), axis=1)
    reached = [(place[np.arange(len(near))[:, None], home[near]] < p).mean() for p in (cells.probes - 1, cells.probes)]
    assert reached[0] < 0.95 <= reached[1]


def test_a_row_without_a_key_is_a_neighbour_too(spark):
    base = spark.createDataFrame([(0, [1.0, 0.0]), (None, [1.0, 0.1]), (2, [0.0, 1.0])], SCHEMA)
    found = vectors.exact_nearest(base, base.filter("vec_id = 0"), "vec_id", "embedding", 2).orderBy("place").collect()
    assert [r["vec_id"] for r in found] == [0, None]
