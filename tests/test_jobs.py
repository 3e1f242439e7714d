"""Small fixtures with results worked out by hand or by a plain Python fold."""

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sparkwell.operators import graph
from sparkwell.operators.joins import as_of, salted_join, tier_join
from sparkwell.operators.merge import delete_where, merge, merged_rows, scd2
from sparkwell.operators.pairs import overlapping_pairs
from sparkwell.operators.revenue import RevenueStore
from sparkwell.operators.stock import admit_orders
from sparkwell.plans.vectors_text import is_destructive
from sparkwell.session import cut_lineage
from sparkwell.sources import readers
from sparkwell.sources.versioned import VersionedTable
from sparkwell.streaming import jobs


def tuples(df):
    return sorted(map(tuple, df.collect()))


# --- revenue store: one file per day, loaded incrementally


def add_day(spark, landing, rows):
    df = spark.createDataFrame(rows, "t STRING, z INT, total_amount DOUBLE")
    df.select(F.col("t").cast("timestamp").alias("tpep_pickup_datetime"), F.col("z").alias("PULocationID"), "total_amount").coalesce(
        1
    ).write.mode("append").parquet(landing)


def test_revenue_is_incremental_and_idempotent(spark, folder):
    landing, store = f"{folder}/landing", RevenueStore(spark, f"{folder}/store")
    add_day(spark, landing, [("2019-01-01 05:10:00", 1, 10.0), ("2019-01-01 05:40:00", 2, 20.0)])
    assert store.run_etl(landing) == 1
    assert store.total_revenue("2019-01-01", 5) == 30.0
    assert store.run_etl(landing) == 0
    add_day(spark, landing, [("2019-03-10 14:00:00", 1, 20.0), ("2019-03-10 15:00:00", 1, 100.0), ("2019-03-10 05:00:00", 1, 50.0)])
    store.run_etl(landing)
    assert [store.total_revenue("2019-03-10", h) for h in (14, 15, 16)] == [20.0, 100.0, 0.0]
    assert store.avg_revenue(5) == pytest.approx(40.0)  # mean of the daily sums 30 and 50
    assert store.total_revenue("2019-01-01", 5) == 30.0


# --- streams: one-minute windows, two-minute tolerance


def publish(spark, path, rows):
    df = spark.createDataFrame(rows, "t STRING, page STRING")
    value = F.to_json(F.struct(F.lit("u").alias("user_id"), F.col("page"), F.col("t").alias("ts")))
    time = F.col("t").cast("timestamp")
    jobs.append_to_topic(df.coalesce(1), path, F.lit("u"), value, time, F.lit(0))


def at(second):
    return f"2026-05-03T10:{second // 60:02d}:{second % 60:02d}Z"


@pytest.mark.parametrize("filler,expected", [(False, 5), (True, 4)])
def test_late_row_is_dropped_only_after_a_further_batch(spark, folder, filler, expected):
    def drain():
        counts = jobs.windowed_counts(jobs.records(jobs.topic_stream(spark, f"{folder}/topic"), jobs.PAGEVIEW_SCHEMA))
        return jobs.drain_to_files(counts, f"{folder}/sink", f"{folder}/checkpoint"), counts.schema

    early = [(at(s), "/home") for s in (0, 2, 4, 6)] + [(at(300), "/pusher")]
    late = [(at(8), "/home")]
    publish(spark, f"{folder}/topic", early if filler else early + late)
    drain()
    if filler:
        publish(spark, f"{folder}/topic", late)
    publish(spark, f"{folder}/topic", [(at(900), "/pusher")])
    query, schema = drain()
    out = spark.read.schema(schema).parquet(f"{folder}/sink")
    assert out.filter("page = '/home'").agg(F.sum("count")).first()[0] == expected
    dropped = sum(int(s.numRowsDroppedByWatermark) for p in query.recentProgress for s in p.stateOperators)
    assert (dropped > 0) == filler


def test_append_without_watermark_is_refused(spark, folder):
    publish(spark, f"{folder}/topic", [(at(0), "/home")])
    views = jobs.records(jobs.topic_stream(spark, f"{folder}/topic"), jobs.PAGEVIEW_SCHEMA)
    with pytest.raises(AnalysisException):
        jobs.drain_to_files(views.groupBy("page").count(), f"{folder}/sink", f"{folder}/checkpoint")


def test_rate_stream_schema(spark):
    assert jobs.rate_stream(spark, 5).columns == ["timestamp", "value"]


# --- files


def test_numbered_lines_and_validation(spark, tmp_path):
    file = tmp_path / "customers.csv"
    file.write_text("id,name,email\n1,Ann,ann@x.org\n0,Bob,bob@x.org\n3, ,c@x.org\n4,Dan,dan\nx,Eve,e@x.org\n")
    lines = readers.numbered_lines(spark, str(file)).filter("line_no > 1")
    good, bad = readers.split_good_bad(readers.parse_customer_lines(lines))
    assert [(r.line_no, r.id) for r in good.collect()] == [(2, 1)]
    assert sorted((r.line_no, r.reasons) for r in bad.collect()) == [(3, ["id"]), (4, ["name"]), (5, ["email"]), (6, ["id"])]


def test_numbered_lines_over_several_splits(spark, tmp_path):
    file = tmp_path / "long.txt"
    file.write_text("".join(f"row {i}\n" for i in range(1, 5001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        lines = readers.numbered_lines(spark, str(file))
        assert lines.filter(F.concat(F.lit("row "), F.col("line_no").cast("string")) != F.col("value")).count() == 0
        assert lines.count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_versioned_table_rejects_a_taken_version(spark, folder):
    table = VersionedTable(spark, folder)
    table.replace(spark.range(3))
    other = VersionedTable(spark, folder)
    other._versions = lambda: []
    with pytest.raises(RuntimeError):
        other.replace(spark.range(5))
    assert table.read().count() == 3


# --- merges


def test_merge_sees_null_changes(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k INT, v STRING")
    source = spark.createDataFrame([(1, None), (3, None), (4, "d")], "k INT, v STRING")
    actions = merge(target, source, ["k"], only_changed=True, delete_missing=True)
    got = actions.select(F.coalesce("_t.k", "_s.k"), "action")
    assert tuples(got) == [(1, "UPDATE"), (2, "DELETE"), (3, "KEEP"), (4, "INSERT")]
    assert sorted(r.k for r in merged_rows(actions).collect()) == [1, 3, 4]


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (20,)], "x INT")
    assert sorted(str(r.x) for r in delete_where(df, F.col("x") < 10).collect()) == ["20", "None"]


def test_scd2_is_idempotent(spark):
    dim = spark.sql("SELECT 1 AS k, 'a' AS v, DATE '2024-01-01' AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current")
    updates = spark.sql("SELECT 1 AS k, 'b' AS v")
    once = cut_lineage(scd2(dim, updates, ["k"], ["v"], "2024-06-01"))
    assert tuples(once) == tuples(scd2(once, updates, ["k"], ["v"], "2024-06-01"))
    assert [str(r.valid_to) for r in once.filter("NOT is_current").collect()] == ["2024-05-31"]


# --- joins


def test_salted_join_equals_plain_join(spark):
    big = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert tuples(salted_join(big, small, "k", share=0.1)) == tuples(big.join(small, "k"))


def test_as_of_takes_the_last_version(spark):
    versions = spark.createDataFrame([("a", 1, 10), ("a", 5, 50)], "k STRING, at INT, price INT")
    facts = spark.createDataFrame([("a", 0), ("a", 4), ("a", 5), ("b", 9)], "k STRING, t INT")
    got = as_of(facts, versions, ["k"], "t", "at", ["price"])
    assert sorted(got.select("k", "t", "price").collect()) == [("a", 0, None), ("a", 4, 10), ("a", 5, 50), ("b", 9, None)]


def test_tiers_are_half_open(spark):
    df = spark.createDataFrame([(19.99,), (20.0,), (50.0,), (-1.0,)], "v DOUBLE")
    got = tier_join(df, "v", [("Budget", 0, 20), ("Standard", 20, 50), ("Premium", 50, 1e6)])
    assert tuples(got) == [(19.99, "Budget"), (20.0, "Standard"), (50.0, "Premium")]


# --- graphs: the transfer graph of fifteen accounts and eighteen transfers

TRANSFERS = [
    ("L1", "L2"), ("L1", "L3"), ("L2", "L3"), ("L3", "L4"), ("L4", "L5"), ("L2", "L5"), ("L5", "M1"), ("M1", "M2"), ("M2", "M3"),
    ("M3", "C1"), ("F1", "F2"), ("F2", "F3"), ("F3", "F1"), ("F1", "C1"), ("F2", "C1"), ("F3", "C1"), ("D1", "D2"), ("D2", "D3"),
]


@pytest.fixture(scope="module")
def bank(spark):
    names = sorted({n for e in TRANSFERS for n in e})
    ids = {n: i for i, n in enumerate(names)}
    nodes = spark.createDataFrame([(i,) for i in ids.values()], "node BIGINT")
    edges = spark.createDataFrame([(ids[a], ids[b]) for a, b in TRANSFERS], "src BIGINT, dst BIGINT")
    return ids, nodes, edges


def test_components(bank):
    ids, nodes, edges = bank
    sizes = graph.components(nodes, edges).groupBy("component").count()
    assert sorted(r["count"] for r in sizes.collect()) == [3, 12]


def test_pagerank_against_a_plain_loop(bank):
    ids, nodes, edges = bank
    pairs = [(ids[a], ids[b]) for a, b in TRANSFERS]
    out = {i: sum(1 for a, _ in pairs if a == i) for i in ids.values()}
    rank = {i: 1 / 15 for i in ids.values()}
    for _ in range(10):
        rank = {i: 0.15 / 15 + 0.85 * sum(rank[a] / out[a] for a, b in pairs if b == i) for i in rank}
    got = {r.node: r["rank"] for r in graph.pagerank(nodes, edges, 10).collect()}
    assert got == pytest.approx(rank)
    assert max(got, key=got.get) == ids["C1"]


def test_triangle_and_degree(bank):
    ids, nodes, edges = bank
    assert tuples(graph.directed_triangles(edges)) == [(ids["F1"], ids["F2"], ids["F3"])]
    degree = {r.node: (r.outgoing, r.incoming) for r in graph.degrees(nodes, edges).collect()}
    assert degree[ids["C1"]] == (0, 4) and degree[ids["D1"]] == (1, 0)


def test_a_long_chain_is_one_component(spark):
    edges = spark.range(200).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    nodes = spark.range(201).select(F.col("id").alias("node"))
    assert graph.components(nodes, edges).filter("component <> 0").isEmpty()


def test_warm_path_is_cheaper(spark):
    ties = [(1, 2, 10), (2, 3, 9), (3, 4, 8), (4, 5, 9), (1, 6, 3), (6, 5, 2)]
    edges = spark.createDataFrame([(a, b, i, 1 / f) for i, (a, b, f) in enumerate(ties)], "src BIGINT, dst BIGINT, id BIGINT, cost DOUBLE")
    node = lambda n: spark.createDataFrame([(n,)], "node BIGINT")
    found = graph.paths_between(edges, node(1), node(5), 5).collect()
    costs = {tuple(r.nodes): round(sum(r.costs), 3) for r in found}
    assert costs == {(1, 2, 3, 4, 5): 0.447, (1, 6, 5): 0.833}
    assert graph.shortest_path(edges, node(1), node(5)).collect()[0].path == [1, 6, 5]


def test_pair_weights_of_large_orders(spark):
    """A 101-item order counts, and an order of many blocks gives each pair once."""
    rows = [(1, i) for i in range(101)] + [(1, 5), (2, 5), (2, 7), (2, 300), (3, 7), (None, 1), (4, None)]
    lines = spark.createDataFrame(rows, "o bigint, i bigint")
    baskets = {}
    for o, i in rows:
        if o is not None and i is not None:
            baskets.setdefault(o, set()).add(i)
    wanted = {}
    for items in baskets.values():
        for a in items:
            for b in items:
                if a < b:
                    wanted[a, b] = wanted.get((a, b), 0) + 1
    for block in (100, 7):
        got = {(r["a"], r["b"]): r["weight"] for r in graph.copurchase_edges(lines, "o", "i", block).collect()}
        assert got == wanted and got[5, 7] == 2


@pytest.mark.parametrize("seed", [1, 2])
def test_overlapping_pairs_against_brute_force(spark, seed):
    rng = random.Random(seed)
    member = {(m, g) for m in range(25) for g in range(30) if rng.random() < (0.9 if g < 2 else 0.15)}
    rows = [(m, g, rng.randrange(1, 5)) for m, g in sorted(member)]
    weight = {(m, g): w for m, g, w in rows}
    want = []
    for a in range(25):
        for b in range(a + 1, 25):
            common = [g for g in range(30) if (a, g) in member and (b, g) in member]
            if len(common) >= 3:
                want.append((a, b, len(common), sum(weight[a, g] + weight[b, g] for g in common)))
    df = spark.createDataFrame(rows, "m BIGINT, g BIGINT, w BIGINT")
    assert tuples(overlapping_pairs(df, "m", "g", "w", 3)) == sorted(want)


# --- stock


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_order_admission_against_a_sequential_fold(spark, seed):
    rng = random.Random(seed)
    lines = []
    for o in range(60):
        for p in rng.sample(range(8), rng.randrange(1, 4)):
            lines.append((o, o // 2, p, rng.randrange(1, 6)))
    stock = {p: rng.randrange(5, 40) for p in range(8)}
    left, want = dict(stock), {}
    for o in sorted({x[0] for x in lines}, key=lambda o: (o // 2, o)):
        need = [(p, q) for x, _, p, q in lines if x == o]
        want[o] = all(left[p] >= q for p, q in need)
        if want[o]:
            for p, q in need:
                left[p] -= q
    df = spark.createDataFrame(lines, "order_id BIGINT, arrival BIGINT, product_id BIGINT, quantity BIGINT")
    got = admit_orders(df, spark.createDataFrame(list(stock.items()), "product_id BIGINT, stock BIGINT"))
    assert {r.order_id: r.accepted for r in got.collect()} == want


# --- text


def test_destructive_statements(spark):
    samples = [
        ("SELECT * FROM film", False), ("select count(*) from film", False), ("DROP TABLE customer", True),
        ("delete from rental where rental_id < 100", True), ("SELECT * FROM film /* DROP TABLE customer */", False),
        ("SELECT * FROM film -- DROP TABLE", False), ("WITH cte AS (DELETE FROM rental RETURNING *) SELECT 1", True),
    ]
    df = spark.createDataFrame(samples, "q STRING, want BOOLEAN")
    assert df.filter(is_destructive(F.col("q")) != F.col("want")).isEmpty()


def test_file_ledger_survives_reopening(spark, folder):
    from sparkwell.sources.ledger import FileLedger

    listing = spark.createDataFrame([("a", "1")], "name string, etag string")
    rows = spark.createDataFrame([("a", 5)], "name string, value int")
    assert FileLedger(spark, folder).ingest(listing, rows)
    assert not FileLedger(spark, folder).ingest(listing, rows)


def test_empty_republish_removes_the_old_rows(spark, folder):
    from sparkwell.sources.ledger import FileLedger

    rows = spark.createDataFrame([("a b=1", 1), ("c", 2)], "name STRING, v INT")
    names = lambda *pairs: spark.createDataFrame(pairs, "name STRING, etag STRING")
    ledger = FileLedger(spark, folder)
    ledger.ingest(names(("a b=1", "1"), ("c", "1")), rows)
    assert ledger.ingest(names(("a b=1", "2"), ("c", "1")), rows.filter("name = 'c'"))
    assert tuples(ledger.read("v INT, name STRING")) == [(2, "c")]


def test_revenue_is_merged_after_a_crash_and_by_other_stores(spark, folder, monkeypatch):
    landing = f"{folder}/landing"
    add_day(spark, landing, [("2019-01-01 05:10:00", 1, 10.0)])
    store = RevenueStore(spark, f"{folder}/store")
    with monkeypatch.context() as m:
        m.setattr(RevenueStore, "_merge", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.run_etl(landing)
    assert store.run_etl(landing) == 0
    assert store.total_revenue("2019-01-01", 5) == 10.0 and store.avg_revenue(5) == 10.0
    add_day(spark, landing, [("2019-01-02 05:10:00", 1, 30.0)])
    RevenueStore(spark, f"{folder}/store").run_etl(landing)
    assert store.avg_revenue(5) == 20.0


def test_unreadable_documents_are_kept(spark):
    docs = ['[{"id": 1, "customer_id": 1, "amount": 1.0, "status": "pending"}]', '[{"id": 1,', "[]", "{", None]
    found = readers.parse_order_documents(spark.createDataFrame([(d,) for d in docs], "content STRING")).collect()
    assert sorted(len(r.reasons) for r in found) == [0, 4, 4, 4]
