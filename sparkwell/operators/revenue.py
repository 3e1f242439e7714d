"""Hourly revenue kept current from a landing folder, and the two questions asked of it."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell.sources.versioned import VersionedTable
from sparkwell.streaming.jobs import drain_each_batch, write_batch

TRIP_SCHEMA = "tpep_pickup_datetime TIMESTAMP, PULocationID INT, total_amount DOUBLE"
PARTIALS = "day DATE, hour BIGINT, total DOUBLE, n BIGINT, batch_id BIGINT"


class RevenueStore:
    """Sums and counts per (batch, day, hour); answers are read from their merged table.

    The file stream's checkpoint knows which files were read, and a batch that is
    replayed after a crash overwrites its own partition, so nothing doubles. The
    merged table's note is the last batch in it: every run merges the later ones,
    also those that a run before it loaded and did not merge.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.partials = f"{path}/partials"
        self.checkpoint = f"{path}/checkpoint"
        self.hourly = VersionedTable(spark, f"{path}/hourly")
        self._by_hour: dict[int, float] = {}
        self._version: str | None = None

    def run_etl(self, landing: str) -> int:
        """Load the files that are new in ``landing``; returns the number of batches (0 = nothing new)."""
        batches: list[int] = []

        def write(df: DataFrame, batch_id: int) -> None:
            time = F.col("tpep_pickup_datetime")
            sums = df.filter(time.isNotNull()).groupBy(F.to_date(time).alias("day"), F.hour(time).cast("bigint").alias("hour"))
            out = sums.agg(F.sum("total_amount").alias("total"), F.count("total_amount").alias("n"))
            write_batch(out, self.partials, batch_id)
            batches.append(batch_id)

        stream = self.spark.readStream.schema(TRIP_SCHEMA).option("maxFilesPerTrigger", 1000).parquet(landing)
        drain_each_batch(stream, write, self.checkpoint, "append")
        self._merge()
        return len(batches)

    def _merge(self) -> None:
        """Add the batches after the last merged one to the merged table."""
        try:
            parts = self.spark.read.schema(PARTIALS).parquet(self.partials)
        except AnalysisException:  # no batch was ever written
            return
        merged = self.hourly.last_note()
        later = parts if merged is None else parts.filter(F.col("batch_id") > int(merged))
        last = later.agg(F.max("batch_id")).first()[0]
        if last is None:
            return
        sums = later.select("day", "hour", "total", "n")
        if merged is not None:
            sums = sums.unionByName(self.hourly.read())
        self.hourly.replace(sums.groupBy("day", "hour").agg(F.sum("total").alias("total"), F.sum("n").alias("n")), str(last))

    def total_revenue(self, day: str | dt.date, hour: int) -> float:
        """Revenue of one date and hour over all zones; 0.0 when there were no trips."""
        at = (F.col("day") == F.lit(str(day)).cast("date")) & (F.col("hour") == hour)
        found = self.hourly.read().filter(at).agg(F.round(F.sum("total"), 2)).first()[0]
        return float(found or 0.0)

    def avg_revenue(self, hour: int) -> float:
        """Mean over days of the revenue in one hour; the 24 answers are kept as long as the table's version, whoever loads."""
        version = self.hourly.version()
        if version != self._version or version is None:
            means = self.hourly.read().groupBy("hour").agg(F.avg("total").alias("mean"))
            self._by_hour = {r.hour: r["mean"] for r in means.collect()}  # one row per hour of the day
            self._version = version
        return self._by_hour.get(hour, 0.0)
