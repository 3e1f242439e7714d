"""Scalar functions over whole tables."""

from sparkwell.functions.hashing import md5_bucket
from sparkwell.plans.common import F, Tables, big, col, day, lit, query, rows, when

SEG = "NULLIF(c_mktsegment, 'BUILDING')"


@query(
    "fn_concat",
    f"SELECT c_custkey, c_name || {SEG} AS plus_concat, c_name || COALESCE({SEG}, '') AS null_as_empty FROM customer",
)
def fn_concat(t: Tables):
    segment = F.nullif(col("c_mktsegment"), lit("BUILDING"))
    return t.customer.select(
        "c_custkey", F.concat("c_name", segment).alias("plus_concat"),
        F.concat(col("c_name"), F.coalesce(segment, lit(""))).alias("null_as_empty"),
    )


@query("fn_upper_lower", "SELECT c_custkey, upper(c_name) AS up, lower(c_mktsegment) AS low FROM customer")
def fn_upper_lower(t: Tables):
    return t.customer.select("c_custkey", F.upper("c_name").alias("up"), F.lower("c_mktsegment").alias("low"))


@query("fn_replicate", "SELECT p_partkey, repeat('  ', p_size % 5) || p_name AS label FROM part")
def fn_replicate(t: Tables):
    return t.part.select("p_partkey", F.concat(F.repeat(lit("  "), col("p_size") % 5), "p_name").alias("label"))


@query("fn_cast_text", "SELECT CAST(o_orderkey AS VARCHAR) AS key_text, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day_text FROM orders")
def fn_cast_text(t: Tables):
    return t.orders.select(
        col("o_orderkey").cast("string").alias("key_text"), day("o_orderdate").cast("string").alias("day_text")
    )


LOG = "'level=INFO batch_id=e-' || (event_id // 100) || ' rows=' || user_id"


@query(
    "fn_regex_extract",
    f"SELECT event_id, regexp_extract({LOG}, 'batch_id=([A-Za-z0-9\\-]+)', 1) AS batch_id FROM events",
)
def fn_regex_extract(t: Tables):
    batch = F.floor(col("event_id") / 100).cast("string")
    line = F.concat(lit("level=INFO batch_id=e-"), batch, lit(" rows="), col("user_id").cast("string"))
    return t.events.select("event_id", F.regexp_extract(line, r"batch_id=([A-Za-z0-9\-]+)", 1).alias("batch_id"))


@query(
    "fn_substring_truncate",
    """SELECT doc_id, substring(text, 1, 300) AS snippet, CASE WHEN length(text) > 4000
         THEN substring(text, 1, 4000) || '... [truncated, ' || length(text) || ' chars]' ELSE text END AS shortened FROM documents""",
)
def fn_substring_truncate(t: Tables):
    size = F.length("text")
    note = F.concat(F.substring("text", 1, 4000), lit("... [truncated, "), size.cast("string"), lit(" chars]"))
    return t.documents.select(
        "doc_id", F.substring("text", 1, 300).alias("snippet"),
        when(size > 4000, note).otherwise(col("text")).alias("shortened"),
    )


@query(
    "fn_year_month_hour",
    "SELECT event_id, year(ts) AS y, month(ts) AS m, hour(ts) AS h FROM events",
)
def fn_year_month_hour(t: Tables):
    return t.events.select(
        "event_id", big(F.year("ts")).alias("y"), big(F.month("ts")).alias("m"), big(F.hour("ts")).alias("h")
    )


@query(
    "fn_day_of_week",
    """SELECT event_id, hour(ts) AS hour_of_day, dayofweek(ts) + 1 AS day_of_week,
              isodow(ts) <= 5 AND ((hour(ts) >= 7 AND hour(ts) < 10) OR (hour(ts) >= 16 AND hour(ts) < 19)) AS is_rush FROM events""",
)
def fn_day_of_week(t: Tables):
    """1 is Sunday; rush hours are 07-10 and 16-19 on weekdays."""
    hour, dow = F.hour("ts"), F.dayofweek("ts")
    rush = dow.between(2, 6) & (hour.between(7, 9) | hour.between(16, 18))
    return t.events.select("event_id", big(hour).alias("hour_of_day"), big(dow).alias("day_of_week"), rush.alias("is_rush"))


@query("fn_cast_date", "SELECT event_id, CAST(ts AS DATE) AS event_day FROM events")
def fn_cast_date(t: Tables):
    return t.events.select("event_id", day("ts").alias("event_day"))


@query("fn_format_month", "SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS n FROM orders GROUP BY 1")
def fn_format_month(t: Tables):
    return t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(rows().alias("n"))


@query("fn_date_add", "SELECT o_orderkey, CAST(o_orderdate AS DATE) + 30 AS due_day FROM orders")
def fn_date_add(t: Tables):
    return t.orders.select("o_orderkey", F.date_add(day("o_orderdate"), 30).alias("due_day"))


@query(
    "fn_date_diff",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date_diff('day', o_orderdate, l_shipdate) AS days
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def fn_date_diff(t: Tables):
    joined = t.lineitem.join(t.orders, col("l_orderkey") == col("o_orderkey"))
    days = big(F.datediff("l_shipdate", "o_orderdate"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", days.alias("days"))


@query(
    "fn_now",
    "SELECT c_custkey, TIMESTAMP '2024-02-01 00:00:00' AS modified_at, 'etl' AS modified_by FROM customer",
)
def fn_now(t: Tables, now: str = "2024-02-01 00:00:00"):
    """Audit stamps; the clock is a parameter so that a rerun gives the same rows."""
    return t.customer.select("c_custkey", lit(now).cast("timestamp_ntz").alias("modified_at"), lit("etl").alias("modified_by"))


@query(
    "fn_parse_iso_ts",
    """WITH x AS (SELECT event_id, CASE WHEN event_id % 10 = 3 THEN 'not a time' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS s FROM events)
       SELECT event_id, TRY_CAST(s AS TIMESTAMP) AS parsed FROM x WHERE TRY_CAST(s AS TIMESTAMP) IS NOT NULL""",
)
def fn_parse_iso_ts(t: Tables):
    text = when(col("event_id") % 10 == 3, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    parsed = F.try_to_timestamp(text).cast("timestamp_ntz")
    return t.events.select("event_id", parsed.alias("parsed")).filter("parsed IS NOT NULL")


@query(
    "fn_local_to_utc",
    """SELECT o_orderkey, timezone('UTC', timezone('Europe/London', CAST(o_orderdate AS TIMESTAMP) + INTERVAL 12 HOUR)) AS utc_time FROM orders""",
)
def fn_local_to_utc(t: Tables):
    local = (col("o_orderdate") + F.expr("INTERVAL 12 HOURS")).cast("timestamp")
    return t.orders.select("o_orderkey", F.to_utc_timestamp(local, "Europe/London").cast("timestamp_ntz").alias("utc_time"))


@query("fn_abs_round", "SELECT c_custkey, abs(c_acctbal) AS size, round(c_acctbal / 3, 4) AS third FROM customer")
def fn_abs_round(t: Tables):
    return t.customer.select("c_custkey", F.abs("c_acctbal").alias("size"), F.round(col("c_acctbal") / 3, 4).alias("third"))


@query(
    "fn_nullif_ratio",
    "SELECT p_partkey, round(p_retailprice / NULLIF(p_size % 4, 0), 6) AS ratio FROM part",
)
def fn_nullif_ratio(t: Tables):
    ratio = col("p_retailprice") / F.nullif(col("p_size") % 4, lit(0))
    return t.part.select("p_partkey", F.round(ratio, 6).alias("ratio"))


@query("fn_range_clamp", "SELECT event_id, value FROM events WHERE value BETWEEN 0 AND 50")
def fn_range_clamp(t: Tables):
    return t.events.filter(col("value").between(0, 50)).select("event_id", "value")


@query(
    "fn_geo_bucket",
    """SELECT CAST(floor(c_acctbal / 100) AS BIGINT) AS lat_cell, CAST(floor(c_acctbal / 37 - 90) AS BIGINT) AS lon_cell, COUNT(*) AS n
       FROM customer GROUP BY 1, 2""",
)
def fn_geo_bucket(t: Tables):
    """One-degree cells by floor, so -0.5 belongs to cell -1."""
    cell = lambda c: F.floor(c)
    lat, lon = col("c_acctbal") / 100, col("c_acctbal") / 37 - 90
    return t.customer.groupBy(cell(lat).alias("lat_cell"), cell(lon).alias("lon_cell")).agg(rows().alias("n"))


@query(
    "fn_coalesce_placeholder",
    "SELECT COALESCE(NULLIF(event_type, 'error'), '__BAD__') AS product_id, COUNT(*) AS n FROM events GROUP BY 1",
)
def fn_coalesce_placeholder(t: Tables):
    product = F.coalesce(F.nullif(col("event_type"), lit("error")), lit("__BAD__"))
    return t.events.groupBy(product.alias("product_id")).agg(rows().alias("n"))


@query(
    "fn_from_json",
    """SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k FROM events""",
)
def fn_from_json(t: Tables):
    """Every ninth document is cut short; malformed text gives NULL fields."""
    text = when(col("event_id") % 9 == 0, F.substring("props", 1, 4)).otherwise(col("props"))
    return t.events.select("event_id", F.from_json(text, "k INT").alias("e")).select("event_id", "e.k")


@query(
    "fn_array_contains",
    "SELECT p_partkey, p_name FROM part WHERE list_contains(string_split(p_name, ' '), 'red')",
)
def fn_array_contains(t: Tables):
    return t.part.filter(F.array_contains(F.split("p_name", " "), "red")).select("p_partkey", "p_name")


@query(
    "fn_array_pairs",
    """WITH x AS (SELECT p_partkey, unnest([p_type, p_brand, p_name]) AS tag FROM part)
       SELECT a.p_partkey, a.tag AS a, b.tag AS b FROM x a JOIN x b ON a.p_partkey = b.p_partkey AND a.tag < b.tag""",
)
def fn_array_pairs(t: Tables):
    """Unordered pairs of the three tags of a part; the array length is fixed."""
    tags = t.part.select("p_partkey", F.array("p_type", "p_brand", "p_name").alias("tags"))
    first = tags.select("p_partkey", "tags", F.explode("tags").alias("a"))
    return first.select("p_partkey", "a", F.explode("tags").alias("b")).filter("a < b")


@query(
    "fn_array_reduce",
    """SELECT p_partkey, round(1.0 / (p_size + 1) + 1.0 / (p_size % 7 + 1) + 1.0 / (p_partkey % 5 + 1), 9) AS cost FROM part""",
)
def fn_array_reduce(t: Tables):
    """Fold of 1 / familiarity over a path's scores."""
    scores = F.array(col("p_size") + 1, col("p_size") % 7 + 1, (col("p_partkey") % 5 + 1).cast("int"))
    return t.part.select("p_partkey", F.round(F.aggregate(scores, lit(0.0), lambda a, x: a + 1 / x), 9).alias("cost"))


@query(
    "fn_hash_bucket",
    """SELECT ('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT % 16 AS bucket, COUNT(*) AS n FROM customer GROUP BY 1""",
)
def fn_hash_bucket(t: Tables):
    return t.customer.groupBy(md5_bucket(col("c_custkey").cast("string"), 16).alias("bucket")).agg(rows().alias("n"))
