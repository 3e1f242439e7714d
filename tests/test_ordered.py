"""The chunked scans give the plain windows' answers, also when one key has a third of all rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkwell.operators.ordered import (
    exact_percentiles, over_rows, running, with_ntile, with_peers, with_row_number,
)

ORDER = [("v", "asc"), ("id", "asc")]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(i, None if i % 11 == 0 else ("hot" if i % 3 == 0 else f"k{i % 7}"), rng.randrange(20), float(rng.randrange(1000))) for i in range(300)]
    return spark.createDataFrame(data, "id BIGINT, k STRING, v INT, x DOUBLE").cache()


def result(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_and_row_number(rows, keys, tiny_groups):
    w = Window.partitionBy(*keys).orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    got = running(rows, keys, ORDER, {"s": ("sum", F.col("x")), "lo": ("min", F.col("x")), "n": ("count", F.lit(1))})
    want = rows.withColumns({"s": F.sum("x").over(w), "lo": F.min("x").over(w), "n": F.count(F.lit(1)).over(w)})
    assert result(got) == result(want)
    assert result(with_row_number(rows, keys, ORDER)) == result(rows.withColumn("rn", F.count(F.lit(1)).over(w)))


@pytest.mark.parametrize("keys", [["k"], []])
def test_frames_cross_block_borders(rows, keys, tiny_groups):
    exprs = {
        "prev": lambda w: F.lag("x", 2).over(w), "nxt": lambda w: F.lead("x").over(w),
        "avg": lambda w: F.avg("x").over(w.rowsBetween(-2, 1)),
    }
    w = Window.partitionBy(*keys).orderBy("v", "id")
    got = over_rows(rows, keys, ORDER, exprs, before=2, after=1)
    assert result(got) == result(rows.withColumns({n: e(w) for n, e in exprs.items()}))


@pytest.mark.parametrize("keys", [["k"], []])
def test_peers_and_tiles(rows, keys, tiny_groups):
    w = Window.partitionBy(*keys).orderBy(F.col("v").desc())
    got = with_peers(rows, keys, [("v", "desc")], rank="r", dense_rank="d", sums={"s": F.col("x")})
    want = rows.withColumns(
        {"r": F.rank().over(w).cast("long"), "d": F.dense_rank().over(w).cast("long"), "s": F.sum("x").over(w)}
    )
    assert result(got) == result(want)
    tiles = with_ntile(rows, keys, ORDER, 4)
    plain = rows.withColumn("tile", F.ntile(4).over(Window.partitionBy(*keys).orderBy("v", "id")).cast("long"))
    assert result(tiles) == result(plain)


def test_percentiles(rows, tiny_groups):
    got = exact_percentiles(rows.select("k", "x"), ["k"], "x", {"p50": 0.5, "p90": 0.9})
    want = rows.groupBy("k").agg(F.count("x").alias("n"), F.percentile("x", 0.5).alias("p50"), F.percentile("x", 0.9).alias("p90"))
    rounded = lambda df: result(df.select("k", "n", F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90")))
    assert rounded(got) == rounded(want)
