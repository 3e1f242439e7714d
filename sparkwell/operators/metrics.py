"""Metric, log and feed measures over plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwell.operators.ordered import over_rows, running


def increases(samples: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Adds ``increase`` over the sample before; after a counter reset it is the new value itself."""
    asc = [(c, "asc") for c in order]
    lagged = over_rows(samples, keys, asc, {"_prev": lambda w: F.lag(value).over(w)}, before=1)
    step = F.when(F.col(value) >= F.col("_prev"), F.col(value) - F.col("_prev")).otherwise(F.col(value))
    return lagged.withColumn("increase", F.when(F.col("_prev").isNotNull(), step)).drop("_prev")


def least_squares_slope(samples: DataFrame, keys: Sequence[str], x: Column, y: Column) -> DataFrame:
    """Slope per group from sums, so groups combine map-side."""
    stats = samples.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.count(y).alias("n"))
    return stats.filter("n >= 2")


def bad_runs(polls: DataFrame, order: Sequence[str], time: str, bad: Column) -> DataFrame:
    """(first_bad, last_bad, polls): maximal runs of consecutive bad rows.

    The number of good rows seen so far is constant within a run.
    """
    flagged = polls.withColumn("_bad", bad)
    scanned = running(flagged, [], [(c, "asc") for c in order], {"_good": ("sum", F.when(F.col("_bad"), 0).otherwise(1))})
    return (
        scanned.filter("_bad").groupBy("_good")
        .agg(F.min(time).alias("first_bad"), F.max(time).alias("last_bad"), F.count(F.lit(1)).alias("polls")).drop("_good")
    )
