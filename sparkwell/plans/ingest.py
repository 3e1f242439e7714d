"""Sources, sinks and incremental loads. Files are written by Spark from the input tables."""

import uuid

from sparkwell.plans.common import F, Tables, big, col, day, lit, query, rows, when
from sparkwell.session import shared_path
from sparkwell.sources import archives, readers
from sparkwell.sources.ledger import FileLedger, missing_hours
from sparkwell.sources.sinks import append_missing_partitions, replace_partitions, spread_by


@query(
    "read_parquet_dir",
    "SELECT event_id, ts, value FROM events",
)
def read_parquet_dir(t: Tables):
    """Daily files in one directory are one table; three of its columns are read."""
    path = shared_path(t.spark, "daily")
    daily = t.events.withColumn("day", day("ts"))
    spread_by(daily, "day").write.partitionBy("day").parquet(path)
    return t.spark.read.schema("event_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE").parquet(path).select(
        "event_id", "ts", "value"
    )


@query(
    "read_csv_zone_lookup",
    """SELECT CAST(c_custkey AS INTEGER) AS "LocationID", n_name AS "Borough", c_name AS "Zone", c_mktsegment AS service_zone
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def read_csv_zone_lookup(t: Tables):
    path = shared_path(t.spark, "zones")
    zones = t.customer.join(t.nation, col("c_nationkey") == col("n_nationkey")).select(
        col("c_custkey").alias("LocationID"), col("n_name").alias("Borough"), col("c_name").alias("Zone"),
        col("c_mktsegment").alias("service_zone"),
    )
    zones.write.option("header", True).csv(path)
    return readers.read_csv_table(t.spark, path, readers.ZONE_SCHEMA)


CSV_ROWS = 1000
CUSTOMER_CHECKS_SQL = """CASE WHEN c_custkey % 7 = 0 OR c_custkey % 17 = 0 THEN 'id' END, CASE WHEN c_custkey % 11 = 0 THEN 'name' END, CASE WHEN c_custkey % 13 = 0 THEN 'email' END"""


def customer_files(t: Tables):
    """CSV files with a header and up to 1000 customers; every 7th id is zero, every 17th no number, every 11th has no name, every 13th no "@"."""
    k = col("c_custkey")
    ident = when(k % 7 == 0, lit("0")).when(k % 17 == 0, lit("x1")).otherwise(k.cast("string"))
    name = when(k % 11 == 0, lit(" ")).otherwise(col("c_name"))
    mail = F.concat(lit("c"), k.cast("string"), when(k % 13 == 0, lit(".")).otherwise(lit("@")), lit("example.org"))
    lines = t.customer.select(F.floor(k / CSV_ROWS).alias("slice"), k, ident.alias("id"), name.alias("name"), mail.alias("email"))
    path = shared_path(t.spark, "customers-csv")
    # each file is a delivery of its own, so it is written by one task
    lines.repartition("slice").sortWithinPartitions("slice", "c_custkey").drop("c_custkey").write.partitionBy("slice").option("header", True).option(
        "ignoreTrailingWhiteSpace", False
    ).option("ignoreLeadingWhiteSpace", False).csv(path)
    return path


@query(
    "read_csv_validated",
    f"""SELECT c_custkey // {CSV_ROWS} AS slice, 1 + ROW_NUMBER() OVER (PARTITION BY c_custkey // {CSV_ROWS} ORDER BY c_custkey) AS line_no,
              CASE WHEN c_custkey % 7 = 0 THEN 0 WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey END AS id,
              CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE c_name END AS name,
              'c' || c_custkey || CASE WHEN c_custkey % 13 = 0 THEN '.' ELSE '@' END || 'example.org' AS email,
              COALESCE(NULLIF(concat_ws(',', {CUSTOMER_CHECKS_SQL}), ''), 'ok') AS outcome FROM customer""",
)
def read_csv_validated(t: Tables):
    """Rows of files with a header, each with its line in its file (the header is line 1); bad rows keep theirs with the reasons."""
    lines = readers.numbered_lines(t.spark, customer_files(t)).filter("line_no > 1")
    slice_no = big(F.regexp_extract("file", r"/slice=(\d+)/", 1)).alias("slice")
    good, bad = readers.split_good_bad(readers.parse_customer_lines(lines))
    columns = [slice_no, "line_no", "id", "name", "email"]
    good = good.select(*columns, lit("ok").alias("outcome"))
    return good.unionByName(bad.select(*columns, F.array_join("reasons", ",").alias("outcome")))


STATUS_SQL = "CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'completed' ELSE 'lost' END"


@query(
    "read_json_array_validated",
    f"""SELECT o_orderkey AS id, o_custkey AS customer_id, o_totalprice AS amount, {STATUS_SQL} AS status,
               CASE WHEN o_custkey = 0 OR o_orderkey = 0 OR o_orderstatus = 'P' THEN 'bad' ELSE 'ok' END AS outcome FROM orders WHERE o_orderkey // 1000 % 10 <> 3
        UNION ALL SELECT NULL, NULL, NULL, NULL, 'unreadable' FROM (SELECT DISTINCT o_orderkey // 1000 AS f FROM orders) WHERE f % 10 = 3""",
)
def read_json_array_validated(t: Tables):
    """Files that hold an array of up to 1000 orders, or one order; in each tenth file the array is cut off."""
    k = col("o_orderkey")
    status = when(col("o_orderstatus") == "O", "pending").when(col("o_orderstatus") == "F", "completed").otherwise("lost")
    order = F.struct(k.alias("id"), col("o_custkey").alias("customer_id"), col("o_totalprice").alias("amount"), status.alias("status"))
    slice_no = F.floor(k / 1000)
    cut = slice_no % 10 == 3
    alone = (k % 1000 == 0) & ~cut
    file = F.concat(slice_no.cast("string"), when(alone, "-one").otherwise(""))
    files = t.orders.groupBy(file.alias("name"), cut.alias("cut"), alone.alias("alone")).agg(F.sort_array(F.collect_list(order)).alias("orders"))
    array = F.to_json("orders")
    text = when(col("alone"), F.to_json(col("orders")[0])).when(col("cut"), F.expr("substring(to_json(orders), 1, length(to_json(orders)) - 20)")).otherwise(array)
    path = shared_path(t.spark, "orders-json")
    files.select("name", text.alias("value")).write.partitionBy("name").text(path)
    checked = readers.read_order_files(t.spark, path)
    outcome = when(col("unreadable"), "unreadable").when(F.size("reasons") == 0, "ok").otherwise("bad")
    return checked.select("id", "customer_id", "amount", "status", outcome.alias("outcome"))


@query(
    "batched_table_load",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice <= 400000 AND o_custkey > 0",
)
def batched_table_load(t: Tables):
    """Failing rows are split off first; the others are appended in the files that Spark's tasks write."""
    path = shared_path(t.spark, "load")
    rules = {"price": col("o_totalprice") <= 400000, "customer": col("o_custkey") > 0}
    checked = readers.with_reasons(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), rules)
    good, _ = readers.split_good_bad(checked)
    good.write.mode("append").parquet(path)
    return t.spark.read.schema(good.schema).parquet(path)


def hourly_feed(t: Tables):
    """JSON event lines written as gzip text under one directory per hour."""
    path = shared_path(t.spark, "hourly")
    payload = F.from_json("props", "k INT")
    event = F.struct(
        col("event_id").alias("id"), col("event_type").alias("type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"), col("user_id").alias("actor"),
        (payload["k"] % 4).cast("bigint").alias("repo"), payload.alias("payload"),
    )
    hour = F.concat(F.date_format("ts", "yyyy-MM-dd"), lit("-"), F.hour("ts").cast("string"))
    feed = t.events.select(hour.alias("hour"), F.to_json(event).alias("value"))
    spread_by(feed, "hour").write.partitionBy("hour").option("compression", "gzip").text(path)
    return path


@query(
    "read_hourly_gz_jsonl",
    """SELECT strftime(ts, '%Y-%m-%d') || '-' || hour(ts) AS file_hour, event_id AS id, event_type AS type,
              strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at, user_id AS actor,
              CAST(CAST(json_extract(props, '$.k') AS INTEGER) % 4 AS BIGINT) AS repo,
              '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS payload FROM events""",
)
def read_hourly_gz_jsonl(t: Tables):
    return readers.read_event_envelopes(t.spark, hourly_feed(t)).select(
        "file_hour", "id", "type", "created_at", "actor", "repo", "payload"
    )


@query(
    "capture_unknown_types",
    """SELECT CASE WHEN event_type IN ('view', 'click') THEN event_type ELSE 'unknown' END AS route, event_type AS type, COUNT(*) AS n,
              CAST(SUM(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS payload_sum FROM events GROUP BY 1, 2""",
)
def capture_unknown_types(t: Tables):
    """Unknown types keep their raw payload and stay queryable."""
    event = F.struct(
        col("event_id").alias("id"), col("event_type").alias("type"),
        F.from_json("props", "map<string,int>").alias("payload"),
    )
    path = shared_path(t.spark, "types")
    t.events.select(F.to_json(event).alias("value")).write.text(path)
    routed = readers.route_by_type(readers.read_event_envelopes(t.spark, path), ["view", "click"])
    return routed.groupBy("route", "type").agg(
        rows().alias("n"), F.sum(F.get_json_object("payload", "$.k").cast("bigint")).alias("payload_sum")
    )


def slices(t: Tables):
    """Feed slices of 1000 event ids: (path, text) with a header and one CSV line per event."""
    line = F.concat_ws(",", "event_id", "event_type", "value")
    slice_no = F.floor(col("event_id") / 1000)
    grouped = t.events.groupBy(slice_no.alias("slice")).agg(
        F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("body")  # ids are unique: at most 1000 lines
    )
    path = F.concat(lit("s"), col("slice").cast("string"), lit(".events.csv.zip"))
    return grouped.select("slice", path.alias("path"), F.concat(lit("event_id,event_type,value\n"), "body").alias("text"))


def landed(t: Tables, label: str, files):
    """The files (path, content) as a landing folder holds them."""
    folder = shared_path(t.spark, label)
    archives.publish(files, folder)
    return archives.delivered(t.spark, folder)


@query(
    "read_zipped_csv_slices",
    "SELECT 's' || (event_id // 1000) || '.events.csv.zip' AS path, event_id, event_type, value FROM events",
)
def read_zipped_csv_slices(t: Tables):
    text = archives.unzip_csv(landed(t, "zips", archives.zip_text(slices(t))), ["event_id", "event_type", "value"])
    return text.select("path", col("event_id").cast("bigint").alias("event_id"), "event_type",
                       col("value").cast("double").alias("value"))


@query(
    "verify_file_checksum",
    "SELECT DISTINCT 's' || (event_id // 1000) || '.events.csv.zip' AS path, (event_id // 1000) % 3 <> 1 AS ok FROM events",
)
def verify_file_checksum(t: Tables):
    """Every third download lost its tail; digest and length tell."""
    sent = landed(t, "sent", archives.zip_text(slices(t)))
    manifest = sent.select("path", F.sha1("content").alias("sha1"), "length")
    broken = F.regexp_extract("path", r"s(\d+)", 1).cast("int") % 3 == 1
    # without its last byte, which the writer adds again
    size = F.octet_length("content") - 1 - when(broken, 5).otherwise(0)
    got = landed(t, "got", sent.select("path", F.substring(col("content"), lit(1), size).alias("content")))
    return archives.verify_checksums(got, manifest)


@query(
    "detect_truncated_file",
    """WITH f AS (SELECT event_id // 1000 AS s, COUNT(*) AS n FROM events GROUP BY 1)
       SELECT 's' || s || '.events.csv.zip' AS path, s % 4 <> 2 AS complete, CASE WHEN s % 4 <> 2 THEN n END AS rows_if_complete FROM f""",
)
def detect_truncated_file(t: Tables):
    """Every fourth gzip stream is cut at 70 percent of its bytes and marked for refetch."""
    sent = archives.gzip_text(slices(t))
    cut = F.regexp_extract("path", r"s(\d+)", 1).cast("int") % 4 == 2
    keep = F.floor(F.octet_length("content") * 0.7).cast("int")
    got = sent.withColumn("content", when(cut, F.substring(col("content"), lit(1), keep)).otherwise(col("content")))
    files = archives.gunzip_lines(landed(t, "gzips", got)).filter("complete IS NOT NULL")
    return files.select("path", "complete", when(col("complete"), col("line_no") - 1).alias("rows_if_complete"))


@query(
    "split_to_daily_partitions",
    """SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n, round(SUM(value), 2) AS total FROM events WHERE event_type <> 'signup'
         AND strftime(ts, '%Y-%m') = '2024-01' GROUP BY 1""",
)
def split_to_daily_partitions(t: Tables):
    """One pass into day partitions; a second pass writes only the days that are missing."""
    path = shared_path(t.spark, "days")
    pickup = when(col("event_type") != "signup", col("ts"))
    trips = t.events.select("event_id", pickup.alias("pickup"), "value").withColumn("d", F.to_date("pickup"))
    month = trips.filter(col("pickup").isNotNull() & (F.date_format("pickup", "yyyy-MM") == "2024-01"))
    append_missing_partitions(month.filter(F.day("d") <= 10), path, "d", None)
    schema = month.schema
    append_missing_partitions(month, path, "d", t.spark.read.schema(schema).parquet(path))
    append_missing_partitions(month, path, "d", t.spark.read.schema(schema).parquet(path))
    written = t.spark.read.schema(schema).parquet(path)
    return written.groupBy("d").agg(rows().alias("n"), F.round(F.sum("value"), 2).alias("total"))


DAY_FILES = "event_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE"


@query(
    "incremental_file_ingest",
    "SELECT CAST(ts AS DATE) AS day, hour(ts) AS hour, round(SUM(value), 2) AS revenue FROM events GROUP BY 1, 2",
)
def incremental_file_ingest(t: Tables):
    """Day files land in two rounds; one run dies before its commit, and one finds nothing new and opens nothing."""
    landing = shared_path(t.spark, "landing")
    ledger = FileLedger(t.spark, shared_path(t.spark, "ingest"))
    days = t.events.select(F.concat(lit("trips_"), day("ts").cast("string")).alias("name"), "event_id", "ts", "value")
    early = F.day("ts") <= 15
    spread_by(days.filter(early), "name").write.partitionBy("name").parquet(landing)
    ledger.ingest_folder(landing, DAY_FILES)
    spread_by(days.filter(~early), "name").write.mode("append").partitionBy("name").parquet(landing)
    ledger.ingest_folder(landing, DAY_FILES, crash_before_commit=True)
    ledger.ingest_folder(landing, DAY_FILES)
    if ledger.ingest_folder(landing, DAY_FILES):
        raise AssertionError("a run without new files must change nothing")
    return ledger.read(f"{DAY_FILES}, name STRING").groupBy(day("ts").alias("day"), big(F.hour("ts")).alias("hour")).agg(
        F.round(F.sum("value"), 2).alias("revenue")
    )


@query(
    "etag_incremental_ingest",
    """SELECT 'trips_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS name, COUNT(*) AS n,
              round(SUM(CASE WHEN day(ts) % 3 = 0 THEN value * 2 ELSE value END), 2) AS total FROM events GROUP BY 1""",
)
def etag_incremental_ingest(t: Tables):
    """Republished files have a new etag and replace their old rows; the others are not opened again."""
    landing = shared_path(t.spark, "landing")
    ledger = FileLedger(t.spark, shared_path(t.spark, "etag"))
    days = t.events.select(F.concat(lit("trips_"), day("ts").cast("string")).alias("name"), "event_id", "ts", "value")
    spread_by(days, "name").write.partitionBy("name").parquet(landing)
    ledger.ingest_folder(landing, DAY_FILES)
    fixed = days.filter(F.day("ts") % 3 == 0).withColumn("value", col("value") * 2)
    replace_partitions(fixed, landing, "name")
    ledger.ingest_folder(landing, DAY_FILES)
    return ledger.read(f"{DAY_FILES}, name STRING").groupBy("name").agg(rows().alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(
    "highwater_next_files",
    """WITH l AS (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events WHERE hour(ts) % 5 <> 0)
       SELECT strftime(h, '%Y-%m-%d') || '-' || hour(h) || '.json.gz' AS file_name
       FROM unnest(generate_series((SELECT MIN(h) FROM l), TIMESTAMP '2024-01-31 02:00:00', INTERVAL 1 HOUR)) AS s(h)
       WHERE h NOT IN (SELECT h FROM l)""",
)
def highwater_next_files(t: Tables, now: str = "2024-01-31 03:20:00"):
    """Names of all closed hours not loaded yet: gaps and the tail."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")
    ledger = t.events.filter(F.hour("ts") % 5 != 0).select(hour).distinct()
    name = F.concat(F.date_format("h", "yyyy-MM-dd"), lit("-"), F.hour("h").cast("string"), lit(".json.gz"))
    return missing_hours(ledger, "h", now).select(name.alias("file_name"))


@query("backfill_merge_live", "SELECT event_id, user_id, value FROM events")
def backfill_merge_live(t: Tables):
    """Archive pages and live pushes overlap; together they equal the uninterrupted feed."""
    readings = t.events.select("event_id", "user_id", "value", "ts")
    cut = lit("2024-01-16").cast("timestamp_ntz")
    archive = readings.filter(col("ts") < cut + F.expr("INTERVAL 2 DAYS"))
    live = readings.filter(col("ts") >= cut)
    pushed_twice = live.filter(col("event_id") % 5 == 0)
    both = archive.unionByName(live).unionByName(pushed_twice)
    return both.dropDuplicates(["event_id"]).drop("ts")


def sql_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


@query(
    "insert_select_append",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000",
)
def insert_select_append(t: Tables):
    """INSERT INTO ... SELECT in two batches."""
    name, path = sql_name("sales"), shared_path(t.spark, "insert")
    t.spark.sql(f"CREATE TABLE {name} (o_orderkey BIGINT, o_totalprice DOUBLE) USING parquet LOCATION '{path}'")
    t.orders.createOrReplaceTempView(f"staging_{name}")
    for low, high in ((100000, 300000), (300000, 10**12)):
        t.spark.sql(
            f"INSERT INTO {name} SELECT o_orderkey, o_totalprice FROM staging_{name} "
            f"WHERE o_totalprice > {low} AND o_totalprice <= {high}"
        )
    return t.spark.table(name)


@query(
    "insert_static_partition",
    "SELECT o_orderkey, o_totalprice, 1997 AS y, 3 AS m FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3",
)
def insert_static_partition(t: Tables):
    name, path = sql_name("sales_part"), shared_path(t.spark, "static")
    t.spark.sql(
        f"CREATE TABLE {name} (o_orderkey BIGINT, o_totalprice DOUBLE, y INT, m INT) USING parquet "
        f"PARTITIONED BY (y, m) LOCATION '{path}'"
    )
    t.orders.createOrReplaceTempView(f"staging_{name}")
    t.spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION (y = 1997, m = 3) SELECT o_orderkey, o_totalprice FROM staging_{name} "
        "WHERE o_orderdate >= TIMESTAMP_NTZ '1997-03-01' AND o_orderdate < TIMESTAMP_NTZ '1997-04-01'"
    )
    return t.spark.table(name)


@query("ctas", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0")
def ctas(t: Tables):
    name, path = sql_name("active"), shared_path(t.spark, "ctas")
    t.customer.createOrReplaceTempView(f"src_{name}")
    t.spark.sql(
        f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS SELECT c_custkey, c_name FROM src_{name} WHERE c_acctbal > 0"
    )
    return t.spark.table(name)


@query(
    "temp_result",
    "SELECT c_nationkey, COUNT(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1 HAVING COUNT(*) > 50",
)
def temp_result(t: Tables):
    """A session view over an intermediate result, then SQL on it."""
    name = sql_name("tmp")
    t.customer.filter("c_acctbal > 0").createOrReplaceTempView(name)
    return t.spark.sql(f"SELECT c_nationkey, count(*) AS n FROM {name} GROUP BY c_nationkey HAVING count(*) > 50")


def external_products(t: Tables):
    name, path = sql_name("products"), shared_path(t.spark, "external")
    parts = t.part.select("p_partkey", "p_name", "p_retailprice", "p_type")
    spread_by(parts, "p_type").write.partitionBy("p_type").parquet(path)
    t.spark.sql(
        f"CREATE TABLE {name} (p_partkey BIGINT, p_name STRING, p_retailprice DOUBLE, p_type STRING) "
        f"USING parquet PARTITIONED BY (p_type) LOCATION '{path}'"
    )
    return name, path


@query("partitioned_external_table", "SELECT p_partkey, p_name, p_type FROM part WHERE p_type IN ('PROMO', 'LARGE')")
def partitioned_external_table(t: Tables):
    """A table over existing directories; the filter reads two of them."""
    name, _ = external_products(t)
    t.spark.sql(f"MSCK REPAIR TABLE {name}")
    return t.spark.table(name).filter(col("p_type").isin("PROMO", "LARGE")).select("p_partkey", "p_name", "p_type")


@query("add_partition", "SELECT p_partkey, p_name, p_type FROM part WHERE p_type = 'PROMO'")
def add_partition(t: Tables):
    """Only registered directories are part of the table."""
    name, path = external_products(t)
    t.spark.sql(f"ALTER TABLE {name} ADD PARTITION (p_type = 'PROMO') LOCATION '{path}/p_type=PROMO'")
    return t.spark.table(name).select("p_partkey", "p_name", "p_type")


@query(
    "bucketed_table",
    """SELECT o_orderkey, COUNT(*) AS lines, round(SUM(l_extendedprice), 2) AS total FROM orders
       JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def bucketed_table(t: Tables):
    """Orders and lines bucketed on the order key: join and group need no further shuffle."""
    orders, lines = sql_name("orders_b"), sql_name("lines_b")

    def bucketed(df, name, key):
        writer = df.repartition(8, key).write.bucketBy(8, key).sortBy(key).format("parquet")
        writer.option("path", shared_path(t.spark, name)).saveAsTable(name)
        return t.spark.table(name)

    o = bucketed(t.orders.select("o_orderkey"), orders, "o_orderkey")
    li = bucketed(t.lineitem.select("l_orderkey", "l_extendedprice"), lines, "l_orderkey")
    joined = o.join(li, col("o_orderkey") == col("l_orderkey"))
    return joined.groupBy("o_orderkey").agg(
        rows().alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("total")
    )
