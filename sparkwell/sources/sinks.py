"""Table writers. Every target path comes from the caller (a shared folder on a cluster)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_by(df: DataFrame, *keys: str) -> DataFrame:
    """Range shuffle on the partition columns plus a row hash.

    Few files per partition value, and a hot value is written by several tasks.
    """
    return df.repartitionByRange(*[F.col(k) for k in keys], F.xxhash64(*df.columns))


def write_sorted_partitions(df: DataFrame, path: str, key: str, sort: Sequence[str]) -> None:
    """One directory per ``key`` value; every file is sorted, and a hot value has several files."""
    by_range = df.repartitionByRange(key, *sort)
    by_range.sortWithinPartitions(key, *sort).write.partitionBy(key).parquet(path)


def append_missing_partitions(df: DataFrame, path: str, key: str, existing: DataFrame | None) -> None:
    """Write only the partitions that are not there yet."""
    fresh = df if existing is None else df.join(existing.select(key).distinct(), key, "left_anti")
    spread_by(fresh, key).write.mode("append").partitionBy(key).parquet(path)


def replace_partitions(df: DataFrame, path: str, *keys: str) -> None:
    """Overwrite exactly the partitions present in ``df``; running it again changes nothing."""
    writer = spread_by(df, *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


def drop_partitions(values: DataFrame, path: str, key: str) -> None:
    """Remove the directories of the given ``key`` values, one at a time; values without one are passed over."""
    spark = values.sparkSession
    jvm = spark._jvm
    folder = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for row in values.select(key).toLocalIterator():
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/{folder.getPartitionPathString(key, row[0])}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
