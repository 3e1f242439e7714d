"""Shared steps of the operators: folds, stored tables, bounded broadcasts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell.session import cut_lineage, shared_path

#: Rows up to which a table of a few numbers per row may be broadcast; counted, not estimated.
BROADCAST_ROWS = 200_000


def fold(column: str, folds: int) -> Column:
    """crc32 of an id as text, modulo ``folds``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % folds


def stored(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """The table, written once to the folder all executors share and read back."""
    if codec is None:
        return cut_lineage(df, f"llm-{label}")
    path = shared_path(df.sparkSession, f"llm-{label}")
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table of narrow rows, with a broadcast hint only if its counted rows allow that."""
    return F.broadcast(df) if df.count() <= limit else df


def local_table(spark: SparkSession, **columns: pa.Array) -> DataFrame:
    """A table of few rows that the driver has.

    It goes to the JVM as Arrow. From Python rows, Spark makes an RDD that each executor reads through a daemon and
    workers beside those of Arrow functions, which stay in its memory.
    """
    return spark.createDataFrame(pa.table(columns))
