"""Sketches kept as small tables, columns of daily state or bounded arrays, all combined map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell.sources.sinks import replace_partitions


def bloom_positions(key: Column, bits: int, hashes: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits)) for seed in range(hashes)])


def bloom_words(keys: DataFrame, key: str, bits: int = 1 << 17, hashes: int = 5) -> DataFrame:
    """One row per non-empty 64-bit word of the filter: (word, value)."""
    pos = keys.select(F.explode(bloom_positions(F.col(key), bits, hashes)).alias("pos"))
    word = F.floor(F.col("pos") / 64).cast("int").alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("pos") % 64).cast("int"))
    return pos.groupBy(word).agg(F.bit_or(bit).alias("value"))


def bloom_array(keys: DataFrame, key: str, bits: int = 1 << 17, hashes: int = 5) -> DataFrame:
    """The whole filter as one array of ``bits / 64`` longs, at most 2 MB whatever the key count."""
    words = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"))
    filled = words.join(bloom_words(keys, key, bits, hashes), "word", "left")
    cell = F.struct("word", F.coalesce("value", F.lit(0)).alias("value"))
    return filled.agg(F.transform(F.sort_array(F.collect_list(cell)), lambda c: c["value"]).alias("bloom"))


def bloom_might_contain(bloom: Column, key: Column, bits: int = 1 << 17, hashes: int = 5) -> Column:
    def present(pos: Column) -> Column:
        word = F.get(bloom, F.floor(pos / 64).cast("int"))
        return F.getbit(word, (pos % 64).cast("int")) == 1

    return F.forall(bloom_positions(key, bits, hashes), present)


MAX_BLOOM_BITS = 1 << 24  # 2 MB


def bloom_bits(keys: int) -> int | None:
    """Ten bits a key, as a power of two; None when the largest filter would be too full to help."""
    wanted = max(1 << 17, 1 << (10 * keys - 1).bit_length() if keys else 0)
    return wanted if wanted <= MAX_BLOOM_BITS else None


def bloom_prefilter_join(big: DataFrame, small: DataFrame, key: str, hashes: int = 5) -> DataFrame:
    """Drop definite non-matches of ``big`` before the shuffle, then join exactly.

    The filter is sized by the key count of ``small``; beyond its bound the plain join is used.
    """
    bits = bloom_bits(small.select(key).distinct().count())
    if bits is None:
        return big.join(small, key)
    bloom = bloom_array(small, key, bits, hashes)
    kept = big.withColumn("_bloom", bloom.scalar()).filter(
        F.col(key).isNotNull() & bloom_might_contain(F.col("_bloom"), F.col(key), bits, hashes)
    )
    return kept.drop("_bloom").join(small, key)


def count_min_cells(df: DataFrame, item: str, width: int, depth: int) -> DataFrame:
    """Cell table (row, cell, count) of a count-min sketch: at most depth x width rows."""
    cells = F.array(
        *[
            F.struct(F.lit(r).alias("row"), F.pmod(F.xxhash64(F.col(item), F.lit(r)), F.lit(width)).alias("cell"))
            for r in range(depth)
        ]
    )
    return df.select(F.explode(cells).alias("c")).groupBy("c.row", "c.cell").agg(F.count(F.lit(1)).alias("cnt"))


def count_min_estimates(items: DataFrame, item: str, cells: DataFrame, width: int, depth: int) -> DataFrame:
    """Smallest cell per item."""
    probes = F.explode(
        F.array(
            *[
                F.struct(F.lit(r).alias("row"), F.pmod(F.xxhash64(F.col(item), F.lit(r)), F.lit(width)).alias("cell"))
                for r in range(depth)
            ]
        )
    )
    probe = items.select(item, probes.alias("p")).select(item, "p.row", "p.cell")
    return probe.join(cells, ["row", "cell"]).groupBy(item).agg(F.min("cnt").alias("estimate"))


#: Registers of the distinct counts as a power of two (standard error 0.08 percent, 2 MB at most; near exact
#: while few values are seen), and the size of the quantile sketches (rank error below 0.01 percent; exact up to that many values).
REGISTERS, QUANTILES = 21, 65_535


class DailySketches:
    """Mergeable state for each day and key: distinct values of one column, and the distribution of another.

    ``load`` writes the partitions of the days it is given and leaves the others; a corrected day is loaded again alone.
    Any span of days is answered by merging their states, without the rows they came from.
    """

    def __init__(self, spark: SparkSession, path: str, keys: str):
        self.spark, self.path = spark, path
        self.schema = f"{keys}, rows BIGINT, seen BINARY, spread BINARY, day DATE"
        self.keys = [k.split()[0] for k in keys.split(",")]

    def load(self, rows: DataFrame, day: Column, distinct: str, value: str) -> None:
        state = rows.groupBy(day.alias("day"), *self.keys).agg(
            F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(distinct, F.lit(REGISTERS)).alias("seen"),
            F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(QUANTILES)).alias("spread"),
        )
        replace_partitions(state, self.path, "day")

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def distinct(self, *keys: str) -> DataFrame:
        """(keys..., distinct_values, days) over all days that are read."""
        merged = self.read().groupBy(*keys).agg(F.hll_union_agg("seen").alias("seen"), F.countDistinct("day").alias("days"))
        return merged.select(*keys, F.hll_sketch_estimate("seen").alias("distinct_values"), "days")

    def quantiles(self, keys: list[str], points: dict[str, float]) -> DataFrame:
        """(keys..., a column for each point): the least value whose rank reaches the point; keys without a value have nulls."""
        merged = self.read().groupBy(*keys).agg(F.kll_merge_agg_double("spread").alias("spread"))
        filled = F.kll_sketch_get_n_double("spread") > 0
        return merged.select(*keys, *[F.when(filled, F.kll_sketch_get_quantile_double("spread", F.lit(p))).alias(n) for n, p in points.items()])
