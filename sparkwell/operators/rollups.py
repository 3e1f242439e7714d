"""Aggregates kept as mergeable state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hourly_revenue(df: DataFrame, time: str, amount: str, extra: Sequence[str] = ()) -> DataFrame:
    """Sum and count per (day, hour): the grain from which every hourly answer is read."""
    return df.groupBy(
        F.to_date(time).alias("day"), F.hour(time).cast("bigint").alias("hour"), *extra
    ).agg(F.sum(amount).alias("revenue"), F.count(F.lit(1)).alias("trips"))


def partial_sums(df: DataFrame, batch: Column, keys: Sequence[Column], amount: Column) -> DataFrame:
    """One row per (batch, keys) with sum and count; sums of different batches may be added."""
    return df.groupBy(batch.alias("batch_id"), *keys).agg(
        F.sum(amount).alias("total"), F.count(amount).alias("n")
    )


def merge_partials(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals over batches; a batch delivered again counts once."""
    once = partials.dropDuplicates(["batch_id", *keys])
    merged = once.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return merged.withColumn("mean", F.col("total") / F.col("n"))
