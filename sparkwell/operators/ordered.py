"""Ordered analytics that hold when one group has a third of all rows.

A plain SQL window sends a whole group to one task. Each operator here first
checks whether any group can exceed ``spark.sparkwell.window.maxGroupRows``:

* small inputs cannot, so the plain window is used;
* otherwise one map-side combined count finds the oversized groups. Only their
  rows are range-partitioned on (keys, order), pinned by a checkpoint, scanned
  chunk by chunk, and shifted by the carried totals of the earlier chunks.

All results are exact. ``order`` must be total inside a group (add the row id).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwell.session import cut_lineage, input_bytes

MAX_GROUP_CONF = "spark.sparkwell.window.maxGroupRows"
DEFAULT_MAX_GROUP = 5_000_000
SMALL_INPUT_BYTES = 32 * 1024 * 1024

Order = Sequence[tuple[str, str]]  # (column, "asc" | "desc"), NULLs last


def sort_columns(order: Order) -> list[Column]:
    return [
        F.col(c).asc_nulls_last() if direction == "asc" else F.col(c).desc_nulls_last()
        for c, direction in order
    ]


def max_group_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(MAX_GROUP_CONF, str(DEFAULT_MAX_GROUP)))


def small_input(df: DataFrame) -> bool:
    """True when all inputs together are too small to hold an oversized group."""
    if max_group_rows(df) < DEFAULT_MAX_GROUP:
        return False
    return input_bytes(df) <= SMALL_INPUT_BYTES


def pinned(df: DataFrame) -> DataFrame:
    """Write out an input that is read several times, unless it is a mere scan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return cut_lineage(df) if re.search(r"\b(Join|Aggregate|Window)\b", plan) else df


def oversized_groups(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int] | None:
    """Groups above the row limit with their counts, or None when there are none."""
    limit = max_group_rows(df)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_group_rows"))
    big = counts.filter(F.col("_group_rows") > limit)
    total = big.agg(F.sum("_group_rows")).first()[0]
    return None if total is None else (big, -(-int(total) // limit) + 1)


def join_back(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on ``keys`` that keeps the left key columns.

    No broadcast hint: adaptive execution broadcasts the right side from its
    measured size and splits skewed partitions of the left side otherwise.
    """
    if not keys:  # one global row: a scalar subquery, evaluated once
        row = right.select(F.struct(*right.columns)).scalar()
        return left.withColumn("_row", row).select(*left.columns, "_row.*")
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def with_group_stats(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Whole-group aggregates next to each row: combine map-side, then join back."""
    stats = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return join_back(df, stats, keys)


def _split(df: DataFrame, keys: Sequence[str], big: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of oversized groups, all other rows)."""
    if not keys:
        return df, df.limit(0)
    flagged = join_back(df, big, keys, "left")
    hot = flagged.filter(F.col("_group_rows").isNotNull()).drop("_group_rows")
    rest = flagged.filter(F.col("_group_rows").isNull()).drop("_group_rows")
    return hot, rest


def _chunked(hot: DataFrame, keys: Sequence[str], order: Order, chunks: int) -> DataFrame:
    """Range-partition and pin the chunk number, so that retries cannot move a row."""
    ranged = hot.repartitionByRange(chunks, *[F.col(k) for k in keys], *sort_columns(order))
    return cut_lineage(ranged.withColumn("_chunk", F.spark_partition_id()))


_FOLD = {
    "sum": (F.sum, lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)),
    "count": (F.count, lambda a, b: F.coalesce(a, F.lit(0)) + b),
    "min": (F.min, lambda a, b: F.least(a, b)),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
}


def running(
    df: DataFrame, keys: Sequence[str], order: Order, outputs: dict[str, tuple[str, Column]]
) -> DataFrame:
    """Running totals (ROWS UNBOUNDED PRECEDING). ``outputs``: name -> (sum|count|min|max, column)."""
    plain = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    plain = plain.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def scan(frame: DataFrame, window) -> DataFrame:
        return frame.withColumns({n: _FOLD[f][0](c).over(window) for n, (f, c) in outputs.items()})

    if small_input(df):
        return scan(df, plain)
    df = pinned(df)
    found = oversized_groups(df, keys)
    if found is None:
        return scan(df, plain)
    big, chunks = found
    hot, rest = _split(df, keys, big)
    hot = _chunked(hot, keys, order, chunks)
    per_chunk = hot.groupBy(*keys, "_chunk").agg(
        *[_FOLD[f][0](c).alias(f"_part_{n}") for n, (f, c) in outputs.items()]
    )
    # one row per chunk of a group: never more rows than range partitions
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(
        *keys, "_chunk",
        *[
            (F.sum if f in ("sum", "count") else _FOLD[f][0])(f"_part_{n}").over(earlier).alias(f"_carry_{n}")
            for n, (f, _) in outputs.items()
        ],
    )
    local = Window.partitionBy(*keys, "_chunk").orderBy(*sort_columns(order))
    local = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shifted = join_back(scan(hot, local), carry, [*keys, "_chunk"])
    shifted = shifted.withColumns(
        {n: _FOLD[f][1](F.col(f"_carry_{n}"), F.col(n)) for n, (f, _) in outputs.items()}
    )
    shifted = shifted.select(*df.columns, *outputs)
    return shifted.unionByName(scan(rest, plain)) if keys else shifted


def with_row_number(df: DataFrame, keys: Sequence[str], order: Order, name: str = "rn") -> DataFrame:
    return running(df, keys, order, {name: ("count", F.lit(1))})


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    exprs: dict[str, Callable[[Window], Column]],
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Windows that look at most ``before`` rows back and ``after`` rows ahead.

    Each expression gets the ordered window. Oversized groups are cut into
    blocks of row numbers; the rows a neighbour block needs are copied to it.
    """
    plain = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    if small_input(df):
        return df.withColumns({n: e(plain) for n, e in exprs.items()})
    df = pinned(df)
    found = oversized_groups(df, keys)
    if found is None:
        return df.withColumns({n: e(plain) for n, e in exprs.items()})
    big, _ = found
    hot, rest = _split(df, keys, big)
    size = max(max_group_rows(df), 2 * (before + after), 1)
    pos = (F.col("_rn") - 1) % size
    home = F.floor((F.col("_rn") - 1) / size)
    numbered = with_row_number(hot, keys, order, "_rn").withColumn("_home", home)
    places = F.array(
        F.col("_home"),
        F.when(pos >= size - before, F.col("_home") + 1),
        F.when(pos < after, F.col("_home") - 1),
    )
    copies = numbered.withColumn("_block", F.explode(F.array_compact(places)))
    block = Window.partitionBy(*keys, "_block").orderBy("_rn")
    hot_out = (
        copies.withColumns({n: e(block) for n, e in exprs.items()})
        .filter(F.col("_block") == F.col("_home"))
        .select(*df.columns, *exprs)
    )
    if not keys:
        return hot_out
    return hot_out.unionByName(rest.withColumns({n: e(plain) for n, e in exprs.items()}))


def with_peers(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    rank: str | None = None,
    dense_rank: str | None = None,
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """RANK, DENSE_RANK and RANGE running sums, where equal order values are peers.

    Rows are first combined to one per (keys, order value), so a value shared by
    any number of rows costs one row in the scan; the result is joined back.
    """
    sums = sums or {}
    values = [c for c, _ in order]
    combined = df.groupBy(*keys, *values).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()]
    )
    outputs = {"_upto": ("sum", F.col("_n")), "_dense": ("count", F.lit(1))}
    outputs |= {n: ("sum", F.col(f"_s_{n}")) for n in sums}
    scanned = running(combined, keys, order, outputs)
    picked = [F.col(c) for c in (*keys, *values)] + [F.col(n) for n in sums]
    if rank:
        picked.append((F.col("_upto") - F.col("_n") + 1).alias(rank))
    if dense_rank:
        picked.append(F.col("_dense").alias(dense_rank))
    return join_back(df, scanned.select(*picked), [*keys, *values])


def with_ntile(df: DataFrame, keys: Sequence[str], order: Order, tiles: int, name: str = "tile") -> DataFrame:
    """NTILE: the first ``n % tiles`` tiles take one row more."""
    numbered = with_row_number(df, keys, order, "_rn")
    sized = with_group_stats(numbered, keys, _n=F.count(F.lit(1)))
    small = F.floor(F.col("_n") / tiles)
    extra = F.col("_n") % tiles
    cut = extra * (small + 1)
    tile = F.when(F.col("_rn") <= cut, F.floor((F.col("_rn") - 1) / (small + 1)) + 1).otherwise(
        F.floor((F.col("_rn") - cut - 1) / F.greatest(small, F.lit(1))) + 1 + extra
    )
    return sized.withColumn(name, tile.cast("long")).drop("_rn", "_n")


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, points: dict[str, float], weight: str | None = None
) -> DataFrame:
    """Interpolated percentiles per group without holding a group in one task.

    Rows are combined to (keys, value, count); positions come from running
    counts. With ``weight`` a row stands for that many. Adds ``n``, the non-NULL row count. Groups without values are absent.
    """
    combined = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("_c"))
    )
    if small_input(df):
        whole = Window.partitionBy(*keys)
        upto = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sized = combined.withColumns({"_upto": F.sum("_c").over(upto), "n": F.sum("_c").over(whole)})
    else:
        combined = cut_lineage(combined)
        scanned = running(combined, keys, [(value, "asc")], {"_upto": ("sum", F.col("_c"))})
        totals = combined.groupBy(*keys).agg(F.sum("_c").alias("n"))
        sized = join_back(scanned, totals, keys)
    aggs = [F.max("n").alias("n")]
    for name, p in points.items():
        place = F.lit(p) * (F.col("n") - 1)
        aggs.append(F.min(F.when(F.col("_upto") > F.floor(place), F.col(value))).alias(f"_lo_{name}"))
        aggs.append(F.min(F.when(F.col("_upto") > F.ceil(place), F.col(value))).alias(f"_hi_{name}"))
    picked = sized.groupBy(*keys).agg(*aggs)
    for name, p in points.items():
        place = F.lit(p) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        picked = picked.withColumn(name, lo + (hi - lo) * (place - F.floor(place))).drop(lo, hi)
    return picked.drop(*[f"_{s}_{n}" for n in points for s in ("lo", "hi")])


def top_per_group(df: DataFrame, keys: Sequence[str], order: Order, n: int, name: str = "rn") -> DataFrame:
    """First ``n`` rows per group. Spark trims each map task to ``n`` per group before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.withColumn(name, F.row_number().over(window).cast("long")).filter(F.col(name) <= n)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple per key, combined map-side."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)
