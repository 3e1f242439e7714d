"""Data-quality rules as tables of results, and gates on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(rule, rows, violations): a row violates a CHECK only where it is false; NULL passes. One pass for all rules."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(~cond).alias(f"v_{i}") for i, cond in enumerate(checks.values())]
    )
    results = [
        F.struct(F.lit(name).alias("rule"), F.col("rows").alias("rows"), F.col(f"v_{i}").alias("violations"))
        for i, name in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*results)))


def unique_report(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """Rows beyond the first per key; keys combine map-side."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.lit(rule).alias("rule"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"),
    )


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    known = parent.select(F.col(parent_key).alias("_p")).distinct()
    return child.filter(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_p"), "left_anti")


def gate(report: DataFrame) -> bool:
    """True when no rule is violated; the report has one row per rule."""
    return report.filter("violations > 0").isEmpty()


def key_shares(df: DataFrame, key: str, top: int) -> DataFrame:
    """The ``top`` heaviest keys with their share of all rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    ranked = counts.select(key, "n", total.alias("_total")).orderBy(F.col("n").desc(), key).limit(top)
    return ranked.select(key, "n", (F.col("n") / F.col("_total")).alias("share"))
