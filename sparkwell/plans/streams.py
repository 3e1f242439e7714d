"""Streaming jobs over a topic log written from the events table.

The SQL twins are the batch answers: an append aggregation has emitted exactly
the windows that ended before the watermark (greatest event time minus delay).
"""

from pyspark.errors import AnalysisException
from pyspark.sql.types import LongType

from sparkwell.operators.ordered import exact_percentiles, top_per_group, with_row_number
from sparkwell.plans.common import F, Tables, big, col, lit, query, rows, when
from sparkwell.session import shared_path
from sparkwell.streaming import jobs


def pageview_json():
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.to_json(
        F.struct(
            col("user_id").cast("string").alias("user_id"), F.concat(lit("s"), col("user_id").cast("string")).alias("session_id"),
            col("event_type").alias("page"), F.get_json_object("props", "$.k").alias("referrer"), ts.alias("ts"),
        )
    )


def click_json():
    """Errors stand for clicks without a product."""
    return F.to_json(
        F.struct(
            col("event_id").cast("string").alias("event_id"), F.nullif(col("event_type"), lit("error")).alias("product_id"),
            col("user_id").cast("string").alias("user_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"),
        )
    )


def publish(events, path, value=None):
    jobs.append_to_topic(events, path, col("user_id"), pageview_json() if value is None else value, col("ts"), col("event_id"))


class Stage:
    """One topic directory, one sink and one checkpoint below the shared folder."""

    def __init__(self, t: Tables, label: str):
        self.spark = t.spark
        root = shared_path(t.spark, label)
        self.topic, self.sink, self.checkpoint = f"{root}/topic", f"{root}/sink", f"{root}/checkpoint"

    def views(self, files_per_trigger=1000):
        return jobs.records(jobs.topic_stream(self.spark, self.topic, files_per_trigger), jobs.PAGEVIEW_SCHEMA)

    def clicks(self):
        return jobs.records(jobs.topic_stream(self.spark, self.topic), jobs.CLICK_SCHEMA)

    def drain(self, stream):
        return jobs.drain_to_files(stream, self.sink, self.checkpoint)

    def read(self, stream):
        return plain_times(self.spark.read.schema(stream.schema).parquet(self.sink))


def plain_times(df):
    """Timestamps without zone, as in the input tables."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def staged(t: Tables, label: str, events=None, value=None) -> Stage:
    stage = Stage(t, label)
    publish(t.events if events is None else events, stage.topic, value)
    return stage


def run(stage: Stage, stream):
    stage.drain(stream)
    return stage.read(stream)


VIEWS_SQL = """SELECT CAST(user_id AS VARCHAR) AS user_id, 's' || user_id AS session_id, event_type AS page,
                      CAST(json_extract(props, '$.k') AS VARCHAR) AS referrer, ts FROM events"""


def closed(size, delay, where="true"):
    """Tumbling windows emitted after the last batch, on whole-minute or hour sizes."""
    return f"""SELECT time_bucket(INTERVAL '{size}', ts, TIMESTAMP '1970-01-01') AS window_start,
                      time_bucket(INTERVAL '{size}', ts, TIMESTAMP '1970-01-01') + INTERVAL '{size}' AS window_end, event_type AS page, COUNT(*) AS count
               FROM events WHERE {where} GROUP BY 1, 2, 3
               HAVING time_bucket(INTERVAL '{size}', ts, TIMESTAMP '1970-01-01') + INTERVAL '{size}' <= (SELECT MAX(ts) FROM events) - INTERVAL '{delay}'"""


@query("stream_parse_json", VIEWS_SQL)
def stream_parse_json(t: Tables):
    stage = staged(t, "parse")
    return run(stage, stage.views())


@query("kafka_source", VIEWS_SQL)
def kafka_source(t: Tables):
    """The parser of the Kafka job over records of the same columns (the connector jar is not installed)."""
    stage = staged(t, "kafka-source")
    records = jobs.topic_stream(t.spark, stage.topic).filter("topic = 'events'")
    return run(stage, jobs.records(records, jobs.PAGEVIEW_SCHEMA))


@query("batch_read_stream_topic", "SELECT event_type AS page, COUNT(*) AS n FROM events GROUP BY 1")
def batch_read_stream_topic(t: Tables):
    stage = staged(t, "topic-batch")
    views = jobs.records(jobs.topic_batch(t.spark, stage.topic), jobs.PAGEVIEW_SCHEMA)
    return views.groupBy("page").agg(rows().alias("n"))


@query("stream_stateless_append", "SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS page, ts FROM events WHERE event_type <> 'view'")
def stream_stateless_append(t: Tables):
    stage = staged(t, "stateless")
    return run(stage, stage.views().filter("page <> 'view'").select("user_id", "page", "ts"))


@query("trigger_interval", "SELECT event_type AS page, COUNT(*) AS n FROM events GROUP BY 1")
def trigger_interval(t: Tables):
    """A five-second cadence, stopped once the log is read."""
    stage = staged(t, "trigger")
    views = stage.views()
    writer = views.writeStream.format("parquet").outputMode("append").option("checkpointLocation", stage.checkpoint)
    running = writer.trigger(processingTime="5 seconds").start(stage.sink)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return stage.read(views).groupBy("page").agg(rows().alias("n"))


@query("parquet_stream_sink", VIEWS_SQL)
def parquet_stream_sink(t: Tables):
    """Two rounds of data and a restart from the checkpoint: exactly N + M rows."""
    return two_rounds(t, "parquet-sink")


def two_rounds(t: Tables, label: str):
    early = col("ts") < lit("2024-01-16").cast("timestamp_ntz")
    stage = staged(t, label, t.events.filter(early))
    stage.drain(stage.views())
    publish(t.events.filter(~early), stage.topic)
    return run(stage, stage.views())


@query("checkpoint_recovery", "SELECT COUNT(*) AS n, COUNT(DISTINCT ts) AS times FROM events")
def checkpoint_recovery(t: Tables):
    """A restart without new data adds nothing either."""
    early = col("ts") < lit("2024-01-16").cast("timestamp_ntz")
    stage = staged(t, "recovery", t.events.filter(early))
    stage.drain(stage.views())
    stage.drain(stage.views())
    publish(t.events.filter(~early), stage.topic)
    return run(stage, stage.views()).agg(rows().alias("n"), F.countDistinct("ts").alias("times"))


@query("memory_console_sink", "SELECT event_type AS page, COUNT(*) AS n FROM events GROUP BY 1")
def memory_console_sink(t: Tables):
    """In-memory inspection table of a complete aggregation: one row per page type."""
    stage = staged(t, "memory")
    name = "inspect_" + stage.sink.rsplit("-", 1)[-1].split("/")[0]
    counts = stage.views().groupBy("page").agg(rows().alias("n"))
    writer = counts.writeStream.format("memory").queryName(name).outputMode("complete")
    writer.option("checkpointLocation", stage.checkpoint).trigger(availableNow=True).start().awaitTermination()
    return t.spark.table(name)


@query("window_tumbling", closed("1 hour", "2 hours"))
def window_tumbling(t: Tables):
    stage = staged(t, "tumbling")
    return run(stage, jobs.windowed_counts(stage.views(), "1 hour", "2 hours"))


@query(
    "window_sliding",
    """WITH e AS (SELECT event_type AS page, time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL (15 * i) MINUTE AS window_start
                  FROM events, range(4) s(i))
       SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, page, COUNT(*) AS count FROM e
       GROUP BY 1, 2, 3 HAVING window_start + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 2 HOUR""",
)
def window_sliding(t: Tables):
    """Each event is in four windows."""
    stage = staged(t, "sliding")
    return run(stage, jobs.windowed_counts(stage.views(), "1 hour", "2 hours", "15 minutes"))


SESSION_SQL = """WITH g AS (SELECT *, CASE WHEN LAG(ts) OVER w IS NULL OR ts >= LAG(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS is_new
                  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
            s AS (SELECT *, SUM(is_new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM g)
       SELECT CAST(user_id AS VARCHAR) AS user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 6 HOUR AS session_end, COUNT(*) AS page_count
       FROM s GROUP BY user_id, s.s HAVING MAX(ts) + INTERVAL 6 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR"""


@query("window_session", SESSION_SQL)
def window_session(t: Tables):
    stage = staged(t, "sessions")
    return run(stage, jobs.sessions(stage.views(), "6 hours", "1 hour"))


@query("watermark", "SELECT date_trunc('millisecond', MAX(ts)) - INTERVAL 2 HOUR AS watermark FROM events")
def watermark(t: Tables):
    """Greatest event time minus the delay, as reported by the query after its last batch."""
    stage = staged(t, "watermark")
    done = stage.drain(jobs.windowed_counts(stage.views(), "1 hour", "2 hours"))
    last = done.recentProgress[-1].eventTime["watermark"]
    return t.spark.createDataFrame([(last,)], "w STRING").select(
        F.to_timestamp("w").cast("timestamp_ntz").alias("watermark")
    )


@query("windowed_counts", closed("1 minute", "2 minutes"))
def windowed_counts(t: Tables):
    stage = staged(t, "windowed")
    return run(stage, jobs.windowed_counts(stage.views()))


# Held-back events arrive after the events up to the end of 2024-01-20.
CUT = "2024-01-21"
HELD = "event_id % 10 = 3"


def late_run(t: Tables, label: str, held: str, delay: str):
    """First all other events up to the cut, then the held ones, then the rest."""
    before = f"ts < TIMESTAMP_NTZ '{CUT}'"
    stage = staged(t, label, t.events.filter(before).filter(f"NOT ({held})"))
    counts = lambda: jobs.windowed_counts(stage.views(), "1 hour", delay)
    queries = [stage.drain(counts())]
    publish(t.events.filter(before).filter(held), stage.topic)
    queries.append(stage.drain(counts()))
    publish(t.events.filter(f"NOT ({before})"), stage.topic)
    queries.append(stage.drain(counts()))
    dropped = sum(int(s.numRowsDroppedByWatermark) for q in queries for p in q.recentProgress for s in p.stateOperators)
    return stage.read(counts()), dropped


@query("late_event_accept", closed("1 hour", "1 day"))
def late_event_accept(t: Tables):
    """Late by less than the tolerance: counted."""
    return late_run(t, "late-accept", f"{HELD} AND ts >= TIMESTAMP_NTZ '2024-01-20 01:00:00'", "1 day")[0]


DROPPED = f"{HELD} AND ts < TIMESTAMP '2024-01-18'"
LATE_SQL = closed("1 hour", "1 day", f"NOT ({DROPPED})")


@query("late_event_drop_count", f"SELECT *, true AS any_dropped FROM ({LATE_SQL})")
def late_event_drop_count(t: Tables):
    """Late by more than the tolerance: left out, and the progress metrics say so."""
    counts, dropped = late_run(t, "late-drop", DROPPED.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"), "1 day")
    return counts.withColumn("any_dropped", lit(dropped > 0))


@query(
    "late_reconciler",
    f"""SELECT b.window_start, b.page, COALESCE(s.count, 0) AS streamed, b.count AS recomputed, b.count - COALESCE(s.count, 0) AS lost
        FROM ({closed("1 hour", "1 day")}) b LEFT JOIN ({LATE_SQL}) s ON s.window_start = b.window_start AND s.page = b.page""",
)
def late_reconciler(t: Tables):
    """Streaming result against a batch recomputation: the difference is the loss by lateness."""
    streamed, _ = late_run(t, "reconcile", DROPPED.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"), "1 day")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    last = t.events.agg(F.max("ts") - F.expr("INTERVAL 1 DAY")).scalar()
    batch = t.events.groupBy(hour.alias("window_start"), col("event_type").alias("page")).agg(rows().alias("recomputed"))
    batch = batch.filter(col("window_start") + F.expr("INTERVAL 1 HOUR") <= last)
    both = batch.join(streamed.select("window_start", "page", "count"), ["window_start", "page"], "full")
    got, want = F.coalesce("count", lit(0)), F.coalesce("recomputed", lit(0))
    return both.select("window_start", "page", got.alias("streamed"), want.alias("recomputed"), (want - got).alias("lost"))


@query("output_append", f"SELECT *, true AS refused_without_watermark FROM ({closed('1 day', '1 hour')})")
def output_append(t: Tables):
    """Append emits a window once, after the watermark; without a watermark Spark refuses the query."""
    stage = staged(t, "append")
    unmarked = stage.views().groupBy(F.window("ts", "1 day"), "page").count()
    refused = False
    try:
        jobs.drain_to_files(unmarked, f"{stage.sink}-no", f"{stage.checkpoint}-no")
    except AnalysisException:
        refused = True
    counts = run(stage, jobs.windowed_counts(stage.views(), "1 day", "1 hour"))
    return counts.withColumn("refused_without_watermark", lit(refused))


DAILY_SQL = "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_start, event_type AS page, COUNT(*) AS n FROM events GROUP BY 1, 2"


def upserts(t: Tables, stage, stream, keys, every=16):
    return jobs.UpsertTable(t.spark, stage.sink, stream.schema, keys, every)


def two_part_update(t: Tables, label: str, stream_of, keys, value=None):
    """Process the log in two rounds of several batches, each upserted under its id; the sink is folded on the way."""
    half = col("event_id") % 2 == 0
    stage = staged(t, label, t.events.filter(half), value)
    table = upserts(t, stage, stream_of(stage), keys, every=2)
    jobs.drain_each_batch(stream_of(stage), table.write, stage.checkpoint, "update")
    publish(t.events.filter(~half), stage.topic, value)
    jobs.drain_each_batch(stream_of(stage), table.write, stage.checkpoint, "update")
    return plain_times(table.read()).drop("batch_id")


@query("output_update", DAILY_SQL)
def output_update(t: Tables):
    """Changed rows per batch replace the stored ones; no window is late with a 40-day tolerance."""

    def stream(stage):
        marked = stage.views().withWatermark("ts", "40 days").groupBy(F.window("ts", "1 day"), "page")
        return marked.agg(rows().alias("n")).select(col("window.start").alias("day_start"), "page", "n")

    return two_part_update(t, "update", stream, ["day_start", "page"])


@query("output_complete", "SELECT event_type AS page, COUNT(*) AS n FROM events GROUP BY 1")
def output_complete(t: Tables):
    """The whole result each batch; only for small key sets such as the page types."""
    stage = staged(t, "complete")
    counts = stage.views().groupBy("page").agg(rows().alias("n"))
    table = upserts(t, stage, counts, ["page"])
    jobs.drain_each_batch(counts, table.write, stage.checkpoint, "complete")
    return table.read().drop("batch_id")


CLICKS_SQL = """SELECT event_type AS product_id, time_bucket(INTERVAL 30 SECOND, ts) AS minute_window, COUNT(*) AS click_count
                FROM events WHERE event_type <> 'error' GROUP BY 1, 2"""


@query("clicks_aggregate", CLICKS_SQL)
def clicks_aggregate(t: Tables):
    """Thirty-second windows per product in update mode; the group without product is not stored."""
    stage = staged(t, "clicks", value=click_json())
    counts = jobs.click_counts(stage.clicks())
    table = upserts(t, stage, counts, ["product_id", "minute_window"])
    known = col("product_id") != jobs.BAD_PRODUCT
    jobs.drain_each_batch(counts, lambda df, batch_id: table.write(df.filter(known), batch_id), stage.checkpoint, "update")
    return plain_times(table.read()).drop("batch_id")


@query("foreach_batch_upsert_sink", CLICKS_SQL.replace("30 SECOND", "1 DAY"))
def foreach_batch_upsert_sink(t: Tables):
    """Running counts grow over two rounds; the later count of a key replaces the earlier one."""

    def stream(stage):
        return jobs.click_counts(stage.clicks(), "1 day", "40 days")

    kept = two_part_update(t, "upsert-sink", stream, ["product_id", "minute_window"], click_json())
    return kept.filter(col("product_id") != jobs.BAD_PRODUCT)


@query("foreach_batch_idempotent_sink", "SELECT event_type AS page, COUNT(*) AS n FROM events GROUP BY 1")
def foreach_batch_idempotent_sink(t: Tables):
    """Every batch is written twice under its id, as after a crash; no row doubles."""
    stage = staged(t, "idempotent")
    write = jobs.batch_partition_writer(stage.sink)

    def twice(df, batch_id):
        write(df, batch_id)
        write(df, batch_id)

    views = stage.views()
    jobs.drain_each_batch(views, twice, stage.checkpoint, "append")
    return stage.read(views).groupBy("page").agg(rows().alias("n"))


@query(
    "bad_record_count_per_batch",
    """SELECT COUNT(*) AS bad_total, COUNT(DISTINCT time_bucket(INTERVAL 1 DAY, ts)) AS open_windows FROM events WHERE event_type = 'error'""",
)
def bad_record_count_per_batch(t: Tables):
    """Running total of records without product over the windows a batch touched."""
    stage = staged(t, "bad", value=click_json())
    counts = jobs.click_counts(stage.clicks(), "1 day", "40 days")

    def report(df):
        bad = df.filter(col("product_id") == jobs.BAD_PRODUCT)
        return bad.agg(F.coalesce(F.sum("click_count"), lit(0)).alias("bad_total"), rows().alias("open_windows"))

    jobs.drain_each_batch(counts, jobs.batch_partition_writer(stage.sink, report), stage.checkpoint, "update")
    reports = t.spark.read.schema("bad_total BIGINT, open_windows BIGINT, batch_id BIGINT").parquet(stage.sink)
    return reports.orderBy(col("bad_total").desc()).limit(1).drop("batch_id")


@query(
    "kafka_sink",
    f"""SELECT strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') || '|' || page AS key,
               '{{"page":"' || page || '","count":' || count || '}}' AS value FROM ({closed("1 hour", "2 hours")})""",
)
def kafka_sink(t: Tables):
    """Key and value columns of the outgoing topic; written to JSON files here."""
    stage = staged(t, "kafka-sink")
    counts = jobs.windowed_counts(stage.views(), "1 hour", "2 hours")
    out = counts.select(
        F.concat_ws("|", F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "page").alias("key"),
        F.to_json(F.struct("page", "count")).alias("value"),
    )
    jobs.drain_to_files(out, stage.sink, stage.checkpoint, "json")
    return t.spark.read.schema(out.schema).json(stage.sink)


@query(
    "stream_bounded_state",
    """SELECT COUNT(*) AS state_rows FROM (SELECT DISTINCT user_id, date_trunc('hour', ts) AS h FROM events)
       WHERE h + INTERVAL 1 HOUR > (SELECT MAX(ts) FROM events) - INTERVAL 2 HOUR""",
)
def stream_bounded_state(t: Tables):
    """Window plus watermark per user: only open windows stay in the state store."""
    stage = staged(t, "bounded")
    marked = stage.views().withWatermark("ts", "2 hours").groupBy(F.window("ts", "1 hour"), "user_id")
    done = stage.drain(marked.agg(rows().alias("n")))
    kept = int(done.recentProgress[-1].stateOperators[0].numRowsTotal)
    return t.spark.createDataFrame([(kept,)], "state_rows BIGINT")


@query(
    "multiple_watermark_policy",
    """WITH m AS (SELECT MAX(CASE WHEN user_id % 2 = 0 THEN ts END) - INTERVAL 1 HOUR AS a, MAX(CASE WHEN user_id % 2 = 1 THEN ts END) - INTERVAL 5 DAY AS b FROM events),
            h AS (SELECT date_trunc('day', ts) AS d, COUNT(*) AS n FROM events GROUP BY 1)
       SELECT 'min' AS policy, CAST(d AS TIMESTAMP) AS day_start, n FROM h, m WHERE d + INTERVAL 1 DAY <= LEAST(a, b)
       UNION ALL SELECT 'max', CAST(d AS TIMESTAMP), n FROM h, m WHERE d + INTERVAL 1 DAY <= GREATEST(a, b)""",
)
def multiple_watermark_policy(t: Tables):
    """Two inputs with different delays: the slower one decides under min, the faster one under max."""
    out = []
    key = "spark.sql.streaming.multipleWatermarkPolicy"
    before = t.spark.conf.get(key)
    for policy in ("min", "max"):
        stage = staged(t, f"policy-{policy}")
        even = col("user_id").cast("bigint") % 2 == 0
        fast = stage.views().filter(even).withWatermark("ts", "1 hour")
        slow = stage.views().filter(~even).withWatermark("ts", "5 days")
        counts = fast.union(slow).groupBy(F.window("ts", "1 day")).agg(rows().alias("n"))
        counts = counts.select(col("window.start").alias("day_start"), "n")
        t.spark.conf.set(key, policy)
        try:
            out.append(run(stage, counts).withColumn("policy", lit(policy)))
        finally:
            t.spark.conf.set(key, before)
    return out[0].unionByName(out[1])


@query(
    "per_query_watermark",
    f"SELECT 'short' AS query, * FROM ({closed('1 day', '1 hour')}) UNION ALL SELECT 'long', * FROM ({closed('1 day', '5 days')})",
)
def per_query_watermark(t: Tables):
    """Two queries on one topic, each with its own delay."""
    stage = staged(t, "per-query")
    out = []
    for name, delay in (("short", "1 hour"), ("long", "5 days")):
        counts = jobs.windowed_counts(stage.views(), "1 day", delay)
        path = f"{stage.sink}-{name}"
        jobs.drain_to_files(counts, path, f"{stage.checkpoint}-{name}")
        out.append(plain_times(t.spark.read.schema(counts.schema).parquet(path)).withColumn("query", lit(name)))
    return out[0].unionByName(out[1])


@query(
    "stream_topn",
    f"""SELECT window_start, page, count, place FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start ORDER BY count DESC, page) AS place
        FROM ({closed("1 hour", "2 hours")})) WHERE place <= 2""",
)
def stream_topn(t: Tables):
    """Top pages of each closed window, ranked inside the batch that closes it."""
    stage = staged(t, "topn")
    counts = jobs.windowed_counts(stage.views(), "1 hour", "2 hours").select("window_start", "page", "count")

    def rank(df):
        return top_per_group(df, ["window_start"], [("count", "desc"), ("page", "asc")], 2, "place")

    jobs.drain_each_batch(counts, jobs.batch_partition_writer(stage.sink, rank), stage.checkpoint, "append")
    schema = counts.schema.add("place", LongType())
    return plain_times(t.spark.read.schema(schema).parquet(stage.sink)).drop("batch_id")


@query("stream_dedup", "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS page FROM events")
def stream_dedup(t: Tables):
    """Every third record is delivered twice; within the tolerance one survives."""
    value = F.to_json(F.struct(col("event_id").cast("string").alias("event_id"), col("event_type").alias("page"),
                               F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts")))
    stage = staged(t, "dedup", value=value)
    publish(t.events.filter("event_id % 3 = 0"), stage.topic, value)
    schema = "event_id STRING, page STRING, ts TIMESTAMP"
    parsed = jobs.topic_stream(t.spark, stage.topic).select(F.from_json("value", schema).alias("e")).select("e.*")
    unique = parsed.withWatermark("ts", "1 hour").dropDuplicatesWithinWatermark(["event_id"])
    return run(stage, unique.select("event_id", "page"))


@query(
    "compacted_topic_state",
    """SELECT CAST(user_id AS VARCHAR) AS key, arg_max(event_type, event_id) AS value, MAX(event_id) AS "offset" FROM events
       GROUP BY 1 HAVING arg_max(event_type, event_id) <> 'error'""",
)
def compacted_topic_state(t: Tables):
    """The last record of a key is current; a NULL value deletes the key."""
    path = shared_path(t.spark, "compacted")
    publish(t.events, path, F.nullif(col("event_type"), lit("error")))
    return jobs.compacted(jobs.topic_batch(t.spark, path))


@query(
    "per_key_order",
    "SELECT user_id, event_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events",
)
def per_key_order(t: Tables):
    """Position of each record within its key; a hot key is ordered across range partitions."""
    return with_row_number(t.events.select("user_id", "event_id", "ts"), ["user_id"], [("ts", "asc"), ("event_id", "asc")], "seq").drop("ts")


DELAY_SQL = "CASE WHEN event_id % 10 = 0 THEN 30 + event_id % 91 ELSE event_id % 5 END"


@query(
    "lateness_profile",
    f"""SELECT event_type, COUNT(*) AS n, round(quantile_cont({DELAY_SQL}, 0.5), 6) AS p50, round(quantile_cont({DELAY_SQL}, 0.99), 6) AS p99,
               round(quantile_cont({DELAY_SQL}, 0.999), 6) AS p999 FROM events GROUP BY 1""",
)
def lateness_profile(t: Tables):
    """Arrival minus event time: one record in ten is 30 to 120 seconds late."""
    delay = when(col("event_id") % 10 == 0, 30 + col("event_id") % 91).otherwise(col("event_id") % 5)
    arrived = t.events.select("event_type", delay.cast("double").alias("late"))
    points = {"p50": 0.5, "p99": 0.99, "p999": 0.999}
    profile = exact_percentiles(arrived, ["event_type"], "late", points)
    return profile.select("event_type", "n", *[F.round(p, 6).alias(p) for p in points])


@query(
    "latency_budget",
    """SELECT event_id, date_diff('second', date_trunc('second', ts), time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE) AS wait_s,
              date_diff('second', date_trunc('second', ts), time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE) + 120 + 10 + 2 + 1 AS emitted_after_s
       FROM events""",
)
def latency_budget(t: Tables, threshold: int = 120, trigger: int = 10, processing: int = 2, commit: int = 1):
    """Wait for the window end, then threshold, trigger, processing and commit."""
    wait = big(60 - F.second("ts"))
    total = wait + threshold + trigger + processing + commit
    return t.events.select("event_id", wait.alias("wait_s"), total.alias("emitted_after_s"))


@query(
    "delivery_semantics_audit",
    """SELECT CASE WHEN event_id % 5 = 0 THEN 'lost' WHEN event_id % 7 = 0 THEN 'duplicated' ELSE 'once' END AS outcome, COUNT(*) AS ids FROM events GROUP BY 1""",
)
def delivery_semantics_audit(t: Tables):
    """Sent against received ids: every 5th is lost, every 7th comes twice."""
    sent = t.events.select("event_id")
    received = sent.filter("event_id % 5 <> 0")
    received = received.unionByName(received.filter("event_id % 7 = 0"))
    got = received.groupBy(col("event_id").alias("got_id")).agg(rows().alias("n"))
    audit = sent.join(got, col("event_id") == col("got_id"), "full")
    outcome = (
        when(col("event_id").isNull(), "unexpected").when(col("n").isNull(), "lost").when(col("n") > 1, "duplicated").otherwise("once")
    )
    return audit.groupBy(outcome.alias("outcome")).agg(rows().alias("ids"))


@query("streaming_sql_view", closed("1 day", "1 hour"))
def streaming_sql_view(t: Tables):
    """SQL on a temporary view over the stream."""
    stage = staged(t, "sql-view")
    name = "views_" + stage.sink.rsplit("-", 1)[-1].split("/")[0]
    stage.views().withWatermark("ts", "1 hour").createOrReplaceTempView(name)
    counts = t.spark.sql(
        f"""SELECT window.start AS window_start, window.end AS window_end, page, count(*) AS count
            FROM {name} GROUP BY window(ts, '1 day'), page"""
    )
    return run(stage, counts)


@query("progress_listener_status", "SELECT COUNT(*) AS input_rows, 'stopped' AS state FROM events")
def progress_listener_status(t: Tables):
    """Input rows summed over the status table that a listener writes, a row for each micro-batch, and how the run ended."""
    stage = staged(t, "listener")
    status = f"{stage.sink}-status"
    with jobs.StatusLog(t.spark, status):
        done = jobs.drain_to_files(stage.views(1), stage.sink, stage.checkpoint)
    of_query = col("id") == str(done.id)
    ended = jobs.run_ends(t.spark, status).filter(of_query).agg(F.max("ended")).scalar()
    return jobs.batch_status(t.spark, status).filter(of_query).agg(F.sum("input_rows").alias("input_rows"), F.max(ended).alias("state"))


PAY_SQL = """WITH o AS (SELECT o_orderkey, o_orderdate AS ts FROM orders),
  p AS (SELECT o_orderkey AS pay_key, o_orderdate + INTERVAL 1 DAY * (o_orderkey % 8) - INTERVAL 1 HOUR AS pay_ts FROM orders WHERE o_orderkey % 4 <> 0),
  w AS (SELECT LEAST((SELECT MAX(ts) FROM o), (SELECT MAX(pay_ts) FROM p)) - INTERVAL 12 HOUR AS wm)
  SELECT o_orderkey, pay_key IS NOT NULL AS paid FROM o LEFT JOIN p ON o_orderkey = pay_key AND pay_ts >= ts - INTERVAL 1 DAY AND pay_ts <= ts + INTERVAL 5 DAY, w
  WHERE pay_key IS NOT NULL OR ts + INTERVAL 5 DAY < wm"""


@query("join_stream_stream", PAY_SQL)
def join_stream_stream(t: Tables):
    """Orders with their payment within five days (or up to a day early); unpaid ones follow the watermark."""
    root = shared_path(t.spark, "stream-join")
    ts = col("o_orderdate").cast("timestamp")
    t.orders.select("o_orderkey", ts.alias("ts")).write.parquet(f"{root}/orders")
    delay = F.make_dt_interval(days=(col("o_orderkey") % 8).cast("int")) - F.expr("INTERVAL 1 HOUR")
    pays = t.orders.filter("o_orderkey % 4 <> 0").select(col("o_orderkey").alias("pay_key"), (ts + delay).alias("pay_ts"))
    pays.write.parquet(f"{root}/payments")
    orders = t.spark.readStream.schema("o_orderkey BIGINT, ts TIMESTAMP").parquet(f"{root}/orders")
    payments = t.spark.readStream.schema("pay_key BIGINT, pay_ts TIMESTAMP").parquet(f"{root}/payments")
    cond = F.expr(
        "o_orderkey = pay_key AND pay_ts >= ts - INTERVAL 1 DAY AND pay_ts <= ts + INTERVAL 5 DAYS"
    )
    joined = orders.withWatermark("ts", "12 hours").join(payments.withWatermark("pay_ts", "12 hours"), cond, "left_outer")
    out = joined.select("o_orderkey", col("pay_key").isNotNull().alias("paid"))
    jobs.drain_to_files(out, f"{root}/sink", f"{root}/checkpoint")
    return t.spark.read.schema(out.schema).parquet(f"{root}/sink")


@query(
    "batch_stream_enrich",
    """SELECT event_type AS page, c_mktsegment AS segment, COUNT(*) AS n FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2""",
)
def batch_stream_enrich(t: Tables):
    """Stream of events joined with the customer file on their shared key."""
    stage = staged(t, "enrich")
    people = t.customer.select(col("c_custkey").cast("string").alias("user_id"), col("c_mktsegment").alias("segment"))
    enriched = stage.views().select("user_id", "page").join(people, "user_id").select("page", "segment")
    return run(stage, enriched).groupBy("page", "segment").agg(rows().alias("n"))
