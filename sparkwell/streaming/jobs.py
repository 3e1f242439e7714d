"""Structured Streaming building blocks. Every job runs on any source with the topic columns."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from sparkwell.operators.ordered import latest_per_key
from sparkwell.sources.versioned import VersionedTable

BAD_PRODUCT = "__BAD__"  # fixed group name for records without a product

TOPIC_SCHEMA = "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
PAGEVIEW_SCHEMA = "user_id STRING, session_id STRING, page STRING, referrer STRING, ts TIMESTAMP"
CLICK_SCHEMA = "event_id STRING, product_id STRING, user_id STRING, ts TIMESTAMP"


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Topic as a stream; needs the connector jar on the classpath."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", topic).option("startingOffsets", starting).option("failOnDataLoss", "false").load()


def kafka_batch(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The whole log of a topic, for recomputation."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", topic).option("startingOffsets", "earliest").load()


def rate_stream(spark: SparkSession, rows_per_second: int) -> DataFrame:
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def topic_partition(key: Column, partitions: int) -> Column:
    """Equal keys share a partition, so their order is kept."""
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


def append_to_topic(events: DataFrame, path: str, key: Column, value: Column, time: Column, offset: Column,
                    topic: str = "events", partitions: int = 6) -> None:
    """Append records in topic form to a directory that stands for the log."""
    records = events.select(
        key.cast("string").alias("key"), value.alias("value"), F.lit(topic).alias("topic"),
        topic_partition(key.cast("string"), partitions).alias("partition"), offset.cast("bigint").alias("offset"),
        time.cast("timestamp").alias("timestamp"),
    )
    records.write.mode("append").parquet(path)


def topic_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(TOPIC_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def topic_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC_SCHEMA).parquet(path)


def records(topic: DataFrame, schema: str) -> DataFrame:
    """The JSON values of a topic as columns of ``schema``. A value without a time ``ts`` that can be read belongs to no window and is left out."""
    return topic.select(F.inline(F.array(F.from_json(F.col("value").cast("string"), schema)))).filter("ts IS NOT NULL")


def counts_in_windows(
    rows: DataFrame, by: Column, size: str, delay: str, slide: str | None = None
) -> DataFrame:
    """(window_start, window_end, by, count): rows for each value of ``by`` in each event-time window over ``ts``."""
    windows = F.window("ts", size, slide or size).alias("w")
    counts = rows.withWatermark("ts", delay).groupBy(windows, by).count()
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *counts.columns[1:])


def windowed_counts(views: DataFrame, size: str = "1 minute", delay: str = "2 minutes", slide: str | None = None) -> DataFrame:
    """Views of each page in each window."""
    return counts_in_windows(views, F.col("page"), size, delay, slide)


def sessions(views: DataFrame, gap: str, delay: str) -> DataFrame:
    grouped = views.withWatermark("ts", delay).groupBy(F.session_window("ts", gap), "user_id")
    counts = grouped.agg(F.count(F.lit(1)).alias("page_count"))
    return counts.select(
        "user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"),
        "page_count",
    )


def click_counts(clicks: DataFrame, size: str = "30 seconds", delay: str = "30 seconds") -> DataFrame:
    """Clicks on each product in each window; those on no product count under one name."""
    counts = counts_in_windows(clicks, F.ifnull("product_id", F.lit(BAD_PRODUCT)).alias("product_id"), size, delay)
    return counts.select("product_id", F.col("window_start").alias("minute_window"), F.col("count").alias("click_count"))


def _finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def drain_to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append everything available, then stop. Run again after more data: only the new rows are processed."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return _finish(writer.trigger(availableNow=True).start(path))


def drain_each_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, mode: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(fn).outputMode(mode).option("checkpointLocation", checkpoint)
    return _finish(writer.trigger(availableNow=True).start())


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write partition ``batch_id=n`` by overwrite, evaluating the batch once: a replay replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def batch_partition_writer(path: str, change: Callable[[DataFrame], DataFrame] | None = None):
    """The foreachBatch function for ``write_batch``."""

    def write(df: DataFrame, batch_id: int) -> None:
        write_batch(df if change is None else change(df), path, batch_id)

    return write


class UpsertTable:
    """A table of the latest row for each key, fed by micro-batches.

    A batch is written to a folder of its own. When ``every`` batches wait, they are folded into the delta, or, once the delta has
    a quarter of the bytes of the base, together with it into a new base. So a reader meets a base, a delta and fewer than
    ``every`` batches, however many there have been, and most folds rewrite the delta only.
    Both are versioned, and their note is the last batch they hold. A batch that comes again
    replaces itself if it waits, and is passed over if it has been folded in; a fold that dies leaves
    the version before it. Rows carry their batch, so a row that two places hold is the same row.
    """

    def __init__(self, spark: SparkSession, path: str, schema, keys: list[str], every: int = 16):
        self.spark, self.path, self.keys, self.every = spark, path, keys, every
        self.schema = spark.createDataFrame([], schema).withColumn("batch_id", F.lit(0).cast("bigint")).schema
        self.base, self.delta = VersionedTable(spark, f"{path}/base"), VersionedTable(spark, f"{path}/delta")

    def folded(self) -> int:
        """The last batch that the base or the delta holds; -1 before the first."""
        return max(int(x.last_note() or -1) for x in (self.base, self.delta))

    def _folder(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(f"{self.path}/batches")
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def waiting(self) -> list[int]:
        """Batches that are written but not folded in."""
        folder, fs = self._folder()
        names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
        folded = self.folded()
        return sorted(n for n in (int(x.removeprefix("batch_id=")) for x in names if x.startswith("batch_id=")) if n > folded)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """The function for foreachBatch."""
        if batch_id <= self.folded():
            return
        write_batch(rows, f"{self.path}/batches", batch_id)
        if len(self.waiting()) >= self.every:
            self.fold()

    def _delta(self) -> VersionedTable | None:
        """The delta, unless the base holds it."""
        live = int(self.delta.last_note() or -1) > int(self.base.last_note() or -1)
        return self.delta if live else None

    def _parts(self, base: bool) -> list[DataFrame]:
        tables = [self.base if base and self.base.exists() else None, self._delta()]
        parts = [x.read() for x in tables if x]
        paths = [f"{self.path}/batches/batch_id={n}" for n in self.waiting()]
        if paths:
            parts.append(self.spark.read.schema(self.schema).option("basePath", f"{self.path}/batches").parquet(*paths))
        return parts

    def _latest(self, parts: list[DataFrame]) -> DataFrame:
        rows = reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)
        return latest_per_key(rows, self.keys, ["batch_id"])

    def fold(self) -> None:
        waiting = self.waiting()
        if not waiting:
            return
        delta = self._delta()
        small = self.base.exists() and (delta is None or 4 * delta.bytes() < self.base.bytes())
        target = self.delta if small else self.base
        target.replace(self._latest(self._parts(base=not small)), str(waiting[-1]))
        target.drop_before_last()
        folder, fs = self._folder()
        for n in waiting:
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"batch_id={n}"), True)

    def read(self) -> DataFrame:
        return self._latest(self._parts(base=True))


def compacted(log: DataFrame) -> DataFrame:
    """Latest value per key of a log; a NULL value deletes its key."""
    return latest_per_key(log.select("key", "value", "offset"), ["key"], ["offset"]).filter("value IS NOT NULL")


PROGRESS = """id STRING, runId STRING, batchId BIGINT, timestamp STRING, numInputRows BIGINT,
    stateOperators ARRAY<STRUCT<numRowsTotal: BIGINT, numRowsDroppedByWatermark: BIGINT>>, ended STRING"""


class StatusLog(StreamingQueryListener):
    """Writes the progress of each batch of the session's queries, as Spark reports it, to one JSON file below ``path``, and how each run ended.

    What a query keeps of its own progress is bounded; the files are not. Used as a context:
    the listener is active within, and leaving waits until the runs that began within have reported their end.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._open: set[str] = set()
        self._changed = threading.Condition()

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_):
        with self._changed:
            self._changed.wait_for(lambda: not self._open, timeout=60)
        self.spark.streams.removeListener(self)

    def _write(self, name: str, text: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}.json")
        out = target.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(target, True)
        out.write(bytearray(text.encode()))
        out.close()

    def onQueryStarted(self, event):  # noqa: N802 (listener interface)
        with self._changed:
            self._open.add(str(event.runId))

    def onQueryProgress(self, event):  # noqa: N802
        progress = event.progress
        self._write(f"{progress.runId}-{progress.batchId}", json.dumps(json.loads(progress.json)))

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        end = {"id": str(event.id), "runId": str(event.runId), "ended": "failed" if event.exception else "stopped"}
        self._write(f"{event.runId}-end", json.dumps(end))
        with self._changed:
            self._open.discard(str(event.runId))
            self._changed.notify_all()


def batch_status(spark: SparkSession, path: str) -> DataFrame:
    """(id, batch_id, input_rows, state_rows, dropped) of each batch in a status log; of a batch that ran again the later report."""
    seen = spark.read.schema(PROGRESS).json(path).filter("batchId IS NOT NULL")
    of_state = lambda name: F.aggregate(F.ifnull("stateOperators", F.array()), F.lit(0).cast("bigint"), lambda n, s: n + F.ifnull(s[name], F.lit(0).cast("bigint")))
    last = seen.groupBy("id", F.col("batchId").alias("batch_id")).agg(F.max_by(F.struct("numInputRows", "stateOperators"), "timestamp").alias("p")).select("id", "batch_id", "p.*")
    return last.select(
        "id", "batch_id", F.col("numInputRows").alias("input_rows"), of_state("numRowsTotal").alias("state_rows"), of_state("numRowsDroppedByWatermark").alias("dropped")
    )


def run_ends(spark: SparkSession, path: str) -> DataFrame:
    """(id, run_id, ended) of each run that has ended."""
    return spark.read.schema(PROGRESS).json(path).filter("ended IS NOT NULL").select("id", F.col("runId").alias("run_id"), "ended")
