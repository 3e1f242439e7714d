"""Metrics, logs and traces as tables: users are hosts, a value is a gauge, an error is a failed poll."""

from sparkwell.operators.metrics import bad_runs, increases, least_squares_slope
from sparkwell.operators.ordered import over_rows, top_per_group
from sparkwell.plans.common import F, Tables, Window, col, day, lit, query, rows, when


def counter(t: Tables):
    """A counter per host that resets now and then."""
    return t.events.select(
        col("user_id").alias("host"), day("ts").alias("d"), "ts", "event_id", (col("event_id") % 977 * 10).alias("c")
    )


COUNTER_SQL = """c AS (SELECT user_id AS host, CAST(ts AS DATE) AS d, event_id % 977 * 10 AS c,
  LAG(event_id % 977 * 10) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS p FROM events),
  i AS (SELECT host, d, SUM(CASE WHEN p IS NULL THEN NULL WHEN c >= p THEN c - p ELSE c END) AS inc FROM c GROUP BY 1, 2)"""


def daily_increase(t: Tables):
    steps = increases(counter(t), ["host", "d"], ["ts", "event_id"], "c")
    return steps.groupBy("host", "d").agg(F.sum("increase").alias("inc"))


@query("metric_rate", f"WITH {COUNTER_SQL} SELECT host, d, round(inc / 86400.0, 9) AS per_second FROM i WHERE inc IS NOT NULL")
def metric_rate(t: Tables):
    rate = F.round(col("inc") / 86400.0, 9)
    return daily_increase(t).filter("inc IS NOT NULL").select("host", "d", rate.alias("per_second"))


@query("metric_increase_live", f"WITH {COUNTER_SQL} SELECT d, COUNT(*) AS live_hosts FROM i WHERE inc > 0 GROUP BY 1")
def metric_increase_live(t: Tables):
    return daily_increase(t).filter("inc > 0").groupBy("d").agg(rows().alias("live_hosts"))


@query(
    "metric_deriv",
    """SELECT user_id AS host, CAST(ts AS DATE) AS d, round(regr_slope(value, epoch(date_trunc('second', ts)) - epoch(date_trunc('day', ts))), 6) AS slope
       FROM events GROUP BY 1, 2 HAVING COUNT(*) >= 2""",
)
def metric_deriv(t: Tables):
    """Least-squares slope per second within each day."""
    seconds = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    samples = t.events.select(col("user_id").alias("host"), day("ts").alias("d"), seconds.alias("x"), "value")
    slopes = least_squares_slope(samples, ["host", "d"], col("x").cast("double"), col("value"))
    return slopes.select("host", "d", F.round("slope", 6).alias("slope"))


@query(
    "metric_sum_by",
    "SELECT event_type, round(SUM(value), 2) AS total, MAX(value) AS peak, round(AVG(value), 6) AS mean FROM events GROUP BY 1",
)
def metric_sum_by(t: Tables):
    return t.events.groupBy("event_type").agg(
        F.round(F.sum("value"), 2).alias("total"), F.max("value").alias("peak"), F.round(F.avg("value"), 6).alias("mean")
    )


@query(
    "metric_topk",
    """SELECT d, event_type, n FROM (SELECT CAST(ts AS DATE) AS d, event_type, COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY CAST(ts AS DATE)
       ORDER BY COUNT(*) DESC, event_type) AS rn FROM events GROUP BY 1, 2) WHERE rn = 1""",
)
def metric_topk(t: Tables):
    counts = t.events.groupBy(day("ts").alias("d"), "event_type").agg(rows().alias("n"))
    return top_per_group(counts, ["d"], [("n", "desc"), ("event_type", "asc")], 1).drop("rn")


@query(
    "metric_safe_ratio",
    """SELECT user_id AS host, round(1 - SUM(CASE WHEN event_type = 'error' THEN value ELSE 0 END) / GREATEST(SUM(CASE WHEN event_type <> 'view' THEN value ELSE 0 END), 1), 9)
         AS hit_ratio FROM events GROUP BY 1""",
)
def metric_safe_ratio(t: Tables):
    disk = F.sum(when(col("event_type") == "error", col("value")).otherwise(0.0))
    total = F.sum(when(col("event_type") != "view", col("value")).otherwise(0.0))
    ratio = F.round(1 - disk / F.greatest(total, lit(1.0)), 9)
    return t.events.groupBy(col("user_id").alias("host")).agg(ratio.alias("hit_ratio"))


@query(
    "consumer_lag",
    """WITH p AS (SELECT user_id % 6 AS part, MAX(event_id) AS end_offset, MAX(CASE WHEN ts < TIMESTAMP '2024-01-28' - INTERVAL 1 DAY * (user_id % 6) THEN event_id END) AS committed
                  FROM events GROUP BY 1), l AS (SELECT *, end_offset - committed AS lag FROM p)
       SELECT part, end_offset, committed, lag, lag > 1.5 * (SELECT AVG(lag) FROM l) AS is_hot FROM l""",
)
def consumer_lag(t: Tables):
    """End offset minus committed offset per partition; far above the mean means a hot partition."""
    part = col("user_id") % 6
    done = lit("2024-01-28").cast("timestamp_ntz") - F.make_dt_interval(days=part.cast("int"))
    lags = t.events.groupBy(part.alias("part")).agg(
        F.max("event_id").alias("end_offset"), F.max(when(col("ts") < done, col("event_id"))).alias("committed")
    ).withColumn("lag", col("end_offset") - col("committed"))
    mean = lags.agg(F.avg("lag")).scalar()
    return lags.withColumn("is_hot", col("lag") > 1.5 * mean)


LINE_SQL = """CASE event_type WHEN 'error' THEN 'epoch failed batch_id=e-' || (event_id // 100) WHEN 'signup' THEN 'dropped ' || user_id || ' records missing product_id'
  WHEN 'click' THEN 'streaming progress batch_id=e-' || (event_id // 100) || ' dropped_by_watermark=' || (user_id % 4) ELSE 'epoch done batch_id=e-' || (event_id // 100) END"""


def log_lines(t: Tables):
    batch = F.concat(lit("batch_id=e-"), F.floor(col("event_id") / 100).cast("string"))
    user = col("user_id").cast("string")
    line = (
        when(col("event_type") == "error", F.concat(lit("epoch failed "), batch))
        .when(col("event_type") == "signup", F.concat(lit("dropped "), user, lit(" records missing product_id")))
        .when(
            col("event_type") == "click",
            F.concat(lit("streaming progress "), batch, lit(" dropped_by_watermark="), (col("user_id") % 4).cast("string")),
        ).otherwise(F.concat(lit("epoch done "), batch))
    )
    return t.events.select("event_id", "ts", "user_id", line.alias("line"))


def bucket(minutes):
    """Start of the time bucket of a row."""
    return F.window("ts", f"{minutes} minutes")["start"].cast("timestamp_ntz")


@query(
    "log_filter_count",
    f"""SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS bucket, COUNT(*) AS n FROM (SELECT ts, {LINE_SQL} AS line FROM events)
        WHERE contains(line, 'dropped') AND contains(line, 'missing') GROUP BY 1""",
)
def log_filter_count(t: Tables):
    both = F.contains(col("line"), lit("dropped")) & F.contains(col("line"), lit("missing"))
    return log_lines(t).filter(both).groupBy(bucket(30).alias("bucket")).agg(rows().alias("n"))


@query(
    "log_json_level",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'WARNING' END AS level, event_id // 100 AS batch FROM events WHERE event_type IN ('error', 'signup')""",
)
def log_json_level(t: Tables):
    level = when(col("event_type") == "error", "ERROR").when(col("event_type") == "signup", "WARNING").otherwise("INFO")
    text = F.to_json(F.struct(level.alias("level"), F.floor(col("event_id") / 100).alias("batch")))
    parsed = t.events.select("event_id", F.from_json(text, "level STRING, batch BIGINT").alias("e")).select("event_id", "e.*")
    return parsed.filter(col("level").rlike("^(WARNING|ERROR)$"))


@query(
    "log_rate",
    f"""SELECT time_bucket(INTERVAL 60 MINUTE, ts) AS bucket, round(COUNT(*) / 3600.0, 9) AS per_second FROM (SELECT ts, {LINE_SQL} AS line FROM events)
        WHERE contains(line, 'epoch done') GROUP BY 1""",
)
def log_rate(t: Tables):
    done = log_lines(t).filter(F.contains(col("line"), lit("epoch done")))
    return done.groupBy(bucket(60).alias("bucket")).agg(F.round(rows() / 3600.0, 9).alias("per_second"))


@query(
    "log_regex_metric",
    """SELECT CAST(ts AS DATE) AS d, COUNT(*) AS lines, CAST(SUM(user_id % 4) AS BIGINT) AS dropped FROM events WHERE event_type = 'click' AND user_id % 4 > 0 GROUP BY 1""",
)
def log_regex_metric(t: Tables):
    """Lines that report at least one dropped row, and the sum they report."""
    found = log_lines(t).filter(col("line").rlike(r"dropped_by_watermark=[1-9]\d*"))
    dropped = F.regexp_extract("line", r"dropped_by_watermark=(\d+)", 1).cast("bigint")
    return found.groupBy(day("ts").alias("d")).agg(rows().alias("lines"), F.sum(dropped).alias("dropped"))


def spans(t: Tables):
    return t.events.select(
        col("event_id").alias("span_id"), F.concat(lit("e-"), F.floor(col("event_id") / 100).cast("string")).alias("batch_id"),
        col("value").alias("duration_s"), when(col("event_type") == "error", "error").otherwise("ok").alias("status"),
    )


@query(
    "trace_filter",
    "SELECT event_id AS span_id, 'e-' || (event_id // 100) AS batch_id, value AS duration_s FROM events WHERE event_type = 'error' AND value > 10",
)
def trace_filter(t: Tables):
    return spans(t).filter("duration_s > 10 AND status = 'error'").drop("status")


@query(
    "correlate_log_trace",
    """WITH f AS (SELECT event_id // 100 AS b, COUNT(*) AS failed_lines FROM events WHERE event_type = 'error' GROUP BY 1),
            s AS (SELECT event_id // 100 AS b, COUNT(*) AS spans, MAX(value) AS slowest FROM events GROUP BY 1),
            r AS (SELECT event_id // 100 AS b, COUNT(*) AS stored FROM events WHERE event_type IN ('view', 'purchase') GROUP BY 1)
       SELECT 'e-' || b AS batch_id, failed_lines, spans, slowest, COALESCE(stored, 0) AS stored FROM f JOIN s USING (b) LEFT JOIN r USING (b)""",
)
def correlate_log_trace(t: Tables):
    """Batch id from failing log lines, its spans, and the rows it left in the target."""
    batch = F.regexp_extract("line", r"batch_id=([A-Za-z0-9\-]+)", 1)
    failed = log_lines(t).filter(F.contains(col("line"), lit("epoch failed"))).groupBy(batch.alias("batch_id"))
    failed = failed.agg(rows().alias("failed_lines"))
    traced = spans(t).groupBy("batch_id").agg(rows().alias("spans"), F.max("duration_s").alias("slowest"))
    target = t.events.filter(col("event_type").isin("view", "purchase"))
    stored = target.groupBy(F.concat(lit("e-"), F.floor(col("event_id") / 100).cast("string")).alias("batch_id")).agg(rows().alias("n"))
    joined = failed.join(traced, "batch_id").join(stored, "batch_id", "left")
    return joined.select("batch_id", "failed_lines", "spans", "slowest", F.coalesce("n", lit(0)).alias("stored"))


@query(
    "feed_health",
    """WITH b AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, COUNT(*) AS n, MAX(ts) AS last_delivery FROM events GROUP BY 1)
       SELECT bucket, n, last_delivery, CAST(SUM(n) OVER w AS BIGINT) AS trailing_hour, round(n / (SUM(n) OVER w / 12.0), 6) AS ratio FROM b
       WINDOW w AS (ORDER BY bucket RANGE BETWEEN INTERVAL 55 MINUTE PRECEDING AND CURRENT ROW)""",
)
def feed_health(t: Tables):
    """Deliveries per five minutes against the trailing hour."""
    buckets = t.events.groupBy(bucket(5).alias("bucket")).agg(rows().alias("n"), F.max("ts").alias("last_delivery"))
    seconds = F.unix_timestamp(col("bucket").cast("timestamp"))
    frame = Window.orderBy("_s").rangeBetween(-55 * 60, 0)  # one row per five minutes
    hour = F.sum("n").over(frame)
    return buckets.withColumn("_s", seconds).select(
        "bucket", "n", "last_delivery", hour.alias("trailing_hour"), F.round(col("n") / (hour / 12.0), 6).alias("ratio")
    )


@query(
    "outage_intervals",
    """WITH f AS (SELECT *, SUM(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events)
       SELECT MIN(ts) AS first_bad, MAX(ts) AS last_bad, COUNT(*) AS polls FROM f WHERE event_type = 'error' GROUP BY g HAVING COUNT(*) >= 2""",
)
def outage_intervals(t: Tables):
    """Runs of at least two failing polls."""
    polls = t.events.select("ts", "event_id", "event_type")
    return bad_runs(polls, ["ts", "event_id"], "ts", col("event_type") == "error").filter("polls >= 2")


@query(
    "poll_success_rate",
    """SELECT event_id, round(AVG(CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END) OVER w, 6) AS success, round(AVG(value) OVER w, 6) AS latency FROM events
       WINDOW w AS (ORDER BY ts, event_id ROWS 19 PRECEDING)""",
)
def poll_success_rate(t: Tables, polls: int = 20):
    """Success share and mean latency of the last twenty polls."""
    ok = when(col("event_type") == "error", 0.0).otherwise(1.0)
    frame = {
        "success": lambda w: F.round(F.avg(ok).over(w.rowsBetween(1 - polls, 0)), 6),
        "latency": lambda w: F.round(F.avg("value").over(w.rowsBetween(1 - polls, 0)), 6),
    }
    log = t.events.select("event_id", "ts", "event_type", "value")
    scanned = over_rows(log, [], [("ts", "asc"), ("event_id", "asc")], frame, before=polls - 1)
    return scanned.select("event_id", "success", "latency")


@query(
    "slice_lag",
    """WITH s AS (SELECT date_trunc('hour', ts) AS slice, COUNT(DISTINCT event_type) AS kinds FROM events GROUP BY 1)
       SELECT CAST(MAX(slice) AS TIMESTAMP) AS manifest_latest, CAST(MAX(CASE WHEN kinds = 5 THEN slice END) AS TIMESTAMP) AS loaded_latest,
              date_diff('minute', MAX(CASE WHEN kinds = 5 THEN slice END), MAX(slice)) AS lag_minutes FROM s""",
)
def slice_lag(t: Tables):
    """A slice is loaded once all of its file types are there."""
    slices = t.events.groupBy(bucket(60).alias("slice")).agg(F.countDistinct("event_type").alias("kinds"))
    latest = slices.agg(
        F.max("slice").alias("manifest_latest"), F.max(when(col("kinds") == 5, col("slice"))).alias("loaded_latest")
    )
    lag = F.timestamp_diff("MINUTE", col("loaded_latest"), col("manifest_latest"))
    return latest.withColumn("lag_minutes", lag)


@query(
    "ingest_rate_by_type",
    """WITH m AS (SELECT event_type, date_trunc('minute', ts) AS minute, COUNT(*) AS n FROM events GROUP BY 1, 2)
       SELECT event_type, CAST(minute AS TIMESTAMP) AS minute, CAST(SUM(n) OVER (PARTITION BY event_type ORDER BY minute RANGE BETWEEN INTERVAL 4 MINUTE PRECEDING AND CURRENT ROW) AS BIGINT) AS last_5_min
       FROM m""",
)
def ingest_rate_by_type(t: Tables):
    """Rolling five minutes per type, on counts per minute."""
    minutes = t.events.groupBy("event_type", bucket(1).alias("minute")).agg(rows().alias("n"))
    w = Window.partitionBy("event_type").orderBy(F.unix_timestamp(col("minute").cast("timestamp"))).rangeBetween(-240, 0)
    return minutes.select("event_type", "minute", F.sum("n").over(w).alias("last_5_min"))
