"""Incremental ingest: what was loaded is itself a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell.session import cut_lineage
from sparkwell.sources.sinks import drop_partitions, replace_partitions
from sparkwell.sources.versioned import VersionedTable

LEDGER = "name STRING, etag STRING"


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, size, modified): the files below a folder; ``name`` is the value of the ``name=`` folder they are in.

    Only the listing is read, no content. Files of one name are one delivery.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.url_decode(F.regexp_extract("path", r"/name=([^/]*)/", 1))  # as writers escape folder names
    return files.select("path", name.alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def deliveries(files: DataFrame) -> DataFrame:
    """(name, etag) of listed files: the etag changes when a file of that name comes, goes or changes."""
    facts = F.concat_ws(":", "path", "size", F.unix_micros("modified"))
    return files.groupBy("name").agg(F.sha1(F.array_join(F.sort_array(F.collect_list(facts)), "\n")).alias("etag"))


class FileLedger:
    """Loads listed files once per (name, etag) into a table partitioned by file name.

    Data first, ledger second: a crash in between reloads the same files into the
    same partitions, so the table converges.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.data_path = f"{path}/data"
        self.ledger = VersionedTable(spark, f"{path}/ledger")
        if not self.ledger.exists():
            self.ledger.replace(spark.createDataFrame([], LEDGER))

    def pending(self, listing: DataFrame) -> DataFrame:
        """Listed files whose (name, etag) is not in the ledger."""
        return listing.join(self.ledger.read(), ["name", "etag"], "left_anti").select("name", "etag")

    def ingest(self, listing: DataFrame, rows: DataFrame, crash_before_commit: bool = False) -> bool:
        """Load the rows (with column ``name``) of all pending files; False if there were none."""
        pending = self.pending(listing)
        if pending.isEmpty():
            return False
        pending = cut_lineage(pending, "pending")
        self._load(pending, rows.join(pending.select("name"), "name", "left_semi"), crash_before_commit)
        return True

    def ingest_folder(
        self, folder: str, schema: str, build: Callable[[DataFrame], DataFrame] = lambda rows: rows, drop_missing: bool = False, crash_before_commit: bool = False
    ) -> list[str]:
        """Load what is pending of a landing folder of Parquet files below ``name=`` folders; returns the pending names.

        The folder's listing is held against the ledger and only files of pending names are opened, so a run costs
        what has come since the last one. ``build`` makes the stored rows from those of the files; it keeps ``name``.
        With ``drop_missing`` names that are no longer in the folder lose their rows.
        """
        files = cut_lineage(landed(self.spark, folder), "listing")
        listing = deliveries(files)
        gone = self.ledger.read().join(listing, "name", "left_anti") if drop_missing else None
        pending = cut_lineage(self.pending(listing), "pending")
        # paths of new files only; the reader needs them on the driver, as it does those of any folder
        paths = [r["path"] for r in files.join(pending, "name", "left_semi").select("path").toLocalIterator()]
        if gone is not None and not gone.isEmpty():
            gone = cut_lineage(gone, "gone")
            self.ledger.replace(self.ledger.read().join(gone, "name", "left_anti"))
            drop_partitions(gone, self.data_path, "name")
        if not paths:
            return []
        rows = self.spark.read.schema(f"{schema}, name STRING").option("basePath", folder).parquet(*paths)
        self._load(pending, build(rows), crash_before_commit)
        return sorted(r["name"] for r in pending.collect())

    def _load(self, pending: DataFrame, fresh: DataFrame, crash_before_commit: bool) -> None:
        replace_partitions(fresh, self.data_path, "name")
        # a file that comes again without rows leaves none
        drop_partitions(pending.join(fresh.select("name").distinct(), "name", "left_anti"), self.data_path, "name")
        if not crash_before_commit:
            old = self.ledger.read()
            kept = old.join(pending.select("name"), "name", "left_anti")
            self.ledger.replace(kept.unionByName(pending))

    def read(self, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.data_path)


def missing_hours(ledger: DataFrame, hour: str, now: str) -> DataFrame:
    """Hours between the first loaded one and ``now`` that are not in the ledger."""
    span = ledger.agg(F.min(hour).alias("first"))
    last = F.date_trunc("hour", F.lit(now).cast("timestamp_ntz")) - F.expr("INTERVAL 1 HOUR")
    wanted = span.select(F.explode(F.sequence("first", last, F.expr("INTERVAL 1 HOUR"))).alias(hour))
    return wanted.join(ledger.select(hour).distinct(), hour, "left_anti")
