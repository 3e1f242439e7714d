"""Status tables, upserts over many batches, and versions."""

import random

import pytest
from pyspark.sql import functions as F

from sparkwell.sources.versioned import VersionedTable
from sparkwell.streaming import jobs

ROWS = "k INT, v INT"


def batch(spark, rows):
    return spark.createDataFrame(rows, ROWS).coalesce(1)


def held(table):
    return {r.k: r.v for r in table.read().collect()}


def publish(spark, path, n):
    views = spark.range(n).select(F.to_json(F.struct(F.lit("/home").alias("page"), F.lit("2026-05-03T10:00:00Z").alias("ts"))).alias("value"))
    jobs.append_to_topic(views.coalesce(1), path, F.lit("u"), F.col("value"), F.current_timestamp(), F.lit(0))


def test_every_batch_has_its_status(spark, folder):
    """More batches than a query remembers, and a second run of the same query; values without a time are read but kept out."""
    for n in range(1, 7):
        publish(spark, f"{folder}/topic", n)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    drain = lambda: jobs.drain_to_files(jobs.records(jobs.topic_stream(spark, f"{folder}/topic", 1), jobs.PAGEVIEW_SCHEMA), f"{folder}/s", f"{folder}/c")
    try:
        with jobs.StatusLog(spark, f"{folder}/status"):
            first = drain()
            assert len(first.recentProgress) <= 2
            publish(spark, f"{folder}/topic", 100)
            drain()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    rows = jobs.batch_status(spark, f"{folder}/status").filter("input_rows > 0").collect()
    assert sorted((r.batch_id, r.input_rows) for r in rows)[-1] == (6, 100)
    assert sorted(r.input_rows for r in rows) == [1, 2, 3, 4, 5, 6, 100]
    ends = jobs.run_ends(spark, f"{folder}/status").collect()
    assert {r.ended for r in ends} == {"stopped"} and len({r.run_id for r in ends}) == 2 and len({r.id for r in ends}) == 1


def test_a_failed_run_says_so(spark, folder):
    publish(spark, f"{folder}/topic", 1)

    def fail(df, batch_id):
        raise ValueError("no")

    with pytest.raises(Exception), jobs.StatusLog(spark, f"{folder}/status"):
        jobs.drain_each_batch(jobs.topic_stream(spark, f"{folder}/topic"), fail, f"{folder}/c", "append")
    assert [r.ended for r in jobs.run_ends(spark, f"{folder}/status").collect()] == ["failed"]


def test_upserts_against_a_plain_dict(spark, folder):
    """Batches come again, before and after they are folded in; a reader meets few files however many there were."""
    rnd, table, expected, sent = random.Random(3), jobs.UpsertTable(spark, folder, ROWS, ["k"], every=3), {}, []
    for n in range(14):
        rows = [(k, rnd.randrange(1000)) for k in rnd.sample(range(200 if n == 0 else 30), 150 if n == 0 else 8)]
        sent.append(rows)
        expected |= dict(rows)
        table.write(batch(spark, rows), n)
        if n % 4 == 2:
            again = rnd.randrange(max(0, n - 3), n + 1)
            if again <= table.folded() or again == n:
                table.write(batch(spark, sent[again]), again)
        assert len(table.waiting()) < 3
    assert held(table) == expected
    assert len(table._parts(base=True)) <= 3
    assert table.base.exists() and table.delta.exists()
    # opened again, it goes on
    other = jobs.UpsertTable(spark, folder, ROWS, ["k"], every=3)
    other.write(batch(spark, [(1, -1)]), 14)
    assert held(other) == expected | {1: -1}


def test_a_fold_that_dies_loses_nothing(spark, folder, monkeypatch):
    table = jobs.UpsertTable(spark, folder, ROWS, ["k"], every=2)
    table.write(batch(spark, [(1, 1), (2, 2)]), 0)
    monkeypatch.setattr(VersionedTable, "replace", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.write(batch(spark, [(1, 10)]), 1)
    monkeypatch.undo()
    assert held(table) == {1: 10, 2: 2}
    table.write(batch(spark, [(1, 10)]), 1)
    assert table.waiting() == [] and held(table) == {1: 10, 2: 2}


def test_empty_batches_and_tables(spark, folder):
    table = jobs.UpsertTable(spark, folder, ROWS, ["k"], every=2)
    assert held(table) == {}
    for n in range(3):
        table.write(batch(spark, []), n)
    assert held(table) == {}


def test_versions_that_were_not_ended_and_old_data(spark, folder):
    table = VersionedTable(spark, folder)
    assert table.version() is None and table.last_note() is None and table.bytes() == 0
    for n in range(3):
        table.replace(spark.range(n + 1), str(n))
        table.drop_before_last()
    assert table.read().count() == 3 and table.bytes() > 0
    # a writer that died with its commit file open holds its version, and the next one passes it
    table._fs.create(table._hadoop.Path(table._log, "000003.json"), False).close()
    assert table.last_note() == "2" and table.read().count() == 3
    table.replace(spark.range(9), "3")
    assert table.last_note() == "3" and table.notes() == ["0", "1", "2", "3"] and table.read().count() == 9
    assert VersionedTable(spark, folder).version() == "000004.json"
