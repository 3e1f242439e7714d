"""Documents, wide rows and partition layout."""

from sparkwell.functions.hashing import md5_bucket
from sparkwell.operators.documents import order_snapshots, order_totals, term_hits, validation_rules, whole_quantities
from sparkwell.operators.ordered import with_row_number
from sparkwell.plans.common import F, Tables, Window, big, col, day, lit, query, rows, when
from sparkwell.session import shared_path
from sparkwell.sources.readers import with_reasons


def snapshots(t: Tables):
    return order_snapshots(t.orders, t.customer, t.lineitem)


ITEMS_SQL = """(SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, ROW_NUMBER() OVER (PARTITION BY l_orderkey
   ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS pos FROM lineitem)"""

DOCS_SQL = """(SELECT o_orderkey AS order_id, c_custkey, c_name, c_mktsegment AS segment, o_orderstatus AS status, o_orderdate,
   COUNT(*) AS n_items, SUM(l_extendedprice) AS amount, MAX(l_quantity) AS top_qty, list(l_partkey) AS parts FROM lineitem
   JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


@query(
    "doc_find",
    f"""SELECT order_id, c_name AS customer_name, status FROM {DOCS_SQL} WHERE segment = 'BUILDING' AND amount > 100000 AND amount <= 400000
          AND top_qty >= 40 AND len(list_filter(parts, lambda p: p % 10 = 3)) > 0""",
)
def doc_find(t: Tables):
    """Nested path, ranges and array membership, projected to three fields."""
    wanted = (
        (col("customer.segment") == "BUILDING") & (col("amount") > 100000) & (col("amount") <= 400000) & col("large") & col("listed")
    )
    facts = {"large": F.bool_or(col("l_quantity") >= 40), "listed": F.bool_or(col("l_partkey") % 10 == 3)}
    return order_totals(t.orders, t.customer, t.lineitem, **facts).filter(wanted).select("order_id", col("customer.name").alias("customer_name"), "status")


@query(
    "doc_update_set_inc",
    """WITH m AS (SELECT *, p_type = 'PROMO' AS hit, ROW_NUMBER() OVER (PARTITION BY p_type = 'PROMO' ORDER BY p_partkey) AS rn FROM part)
       SELECT 'many' AS mode, p_partkey, CASE WHEN hit THEN p_size + 5 ELSE p_size END AS stock, CASE WHEN hit THEN 'sale' ELSE p_type END AS tag FROM m
       UNION ALL SELECT 'one', p_partkey, CASE WHEN hit AND rn = 1 THEN p_size + 5 ELSE p_size END, CASE WHEN hit AND rn = 1 THEN 'sale' ELSE p_type END FROM m""",
)
def doc_update_set_inc(t: Tables):
    """$inc stock and $set tag, on every match and on the first match only."""
    hit = col("p_type") == "PROMO"
    first = t.part.filter(hit).agg(F.min("p_partkey")).scalar()

    def updated(mode, cond):
        return t.part.select(
            lit(mode).alias("mode"), "p_partkey", when(cond, col("p_size") + 5).otherwise(col("p_size")).alias("stock"),
            when(cond, "sale").otherwise(col("p_type")).alias("tag"),
        )

    return updated("many", hit).unionByName(updated("one", hit & (col("p_partkey") == first)))


@query(
    "doc_delete",
    """SELECT 'many' AS mode, p_partkey FROM part WHERE p_type <> 'PROMO'
       UNION ALL SELECT 'one', p_partkey FROM part WHERE p_partkey <> (SELECT MIN(p_partkey) FROM part WHERE p_type = 'PROMO')""",
)
def doc_delete(t: Tables):
    first = t.part.filter("p_type = 'PROMO'").agg(F.min("p_partkey")).scalar()
    many = t.part.filter("p_type <> 'PROMO'").select(lit("many").alias("mode"), "p_partkey")
    return many.unionByName(t.part.filter(col("p_partkey") != first).select(lit("one").alias("mode"), "p_partkey"))


@query(
    "doc_sort_filter",
    """SELECT p_partkey, p_name, p_size FROM part WHERE p_type = 'PROMO' AND p_brand IN ('Brand#1', 'Brand#2') AND p_size >= 40
       ORDER BY p_size DESC, p_partkey""",
)
def doc_sort_filter(t: Tables):
    kept = t.part.filter((col("p_type") == "PROMO") & col("p_brand").isin("Brand#1", "Brand#2") & (col("p_size") >= 40))
    return kept.select("p_partkey", "p_name", "p_size").orderBy(col("p_size").desc(), "p_partkey")


@query(
    "doc_embed_order",
    f"""SELECT o_orderkey AS order_id, (pos - 1) // 1000 AS page, c_name AS customer, COUNT(*) AS n_items, round(SUM(l_extendedprice), 2) AS amount,
               string_agg(l_partkey || 'x' || CAST(l_quantity AS BIGINT), ',' ORDER BY pos) AS items
        FROM {ITEMS_SQL} JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3""",
)
def doc_embed_order(t: Tables):
    """Items by page, with the number of items and the amount of the whole order."""
    item = lambda i: F.concat(i["product_id"].cast("string"), lit("x"), i["quantity"].cast("bigint").cast("string"))
    totals = t.lineitem.groupBy(col("l_orderkey").alias("order_id")).agg(rows().alias("n_items"), F.sum("l_extendedprice").alias("amount"))
    return snapshots(t).drop("amount").join(totals, "order_id").select(
        "order_id", "page", col("customer.name").alias("customer"), "n_items",
        F.round("amount", 2).alias("amount"), F.array_join(F.transform("items", item), ",").alias("items"),
    )


@query(
    "doc_unnest_items",
    f"SELECT l_orderkey AS order_id, pos, l_partkey AS product_id, l_quantity AS quantity, l_extendedprice AS line_amount FROM {ITEMS_SQL}",
)
def doc_unnest_items(t: Tables):
    return snapshots(t).select("order_id", F.inline("items")).drop("unit_price")


@query(
    "doc_variants",
    """SELECT p_partkey, p_size % 5 + p_size % 7 + p_size % 3 AS total_stock, round(p_retailprice - 10, 2) AS lo, round(p_retailprice + 25.5, 2) AS hi,
              CASE WHEN p_size % 5 > 0 THEN 1 ELSE 0 END + CASE WHEN p_size % 7 > 0 THEN 1 ELSE 0 END + CASE WHEN p_size % 3 > 0 THEN 1 ELSE 0 END AS available
       FROM part""",
)
def doc_variants(t: Tables):
    """Three variants per product with stock and price modifier, read by higher-order functions."""

    def variant(name, mod, price):
        return F.struct(lit(name).alias("size"), (col("p_size") % mod).alias("stock"), lit(price).alias("modifier"))

    variants = F.array(variant("S", 5, -10.0), variant("M", 7, 0.0), variant("L", 3, 25.5))
    docs = t.part.select("p_partkey", "p_retailprice", variants.alias("variants"))
    prices = F.transform("variants", lambda v: F.round(col("p_retailprice") + v["modifier"], 2))
    return docs.select(
        "p_partkey", F.aggregate("variants", lit(0), lambda a, v: a + v["stock"]).alias("total_stock"),
        F.array_min(prices).alias("lo"), F.array_max(prices).alias("hi"),
        F.size(F.filter("variants", lambda v: v["stock"] > 0)).alias("available"),
    )


@query(
    "order_history",
    """SELECT o_custkey AS customer_id, o_orderkey AS order_id, round(o_totalprice, 2) AS total,
              ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders""",
)
def order_history(t: Tables):
    """Every customer's orders, newest first."""
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    placed = with_row_number(orders, ["o_custkey"], [("o_orderdate", "desc"), ("o_orderkey", "desc")], "place")
    return placed.select(
        col("o_custkey").alias("customer_id"), col("o_orderkey").alias("order_id"),
        F.round("o_totalprice", 2).alias("total"), "place",
    )


@query(
    "doc_category_fields",
    """SELECT p_partkey, p_type AS category, CASE WHEN p_type = 'ECONOMY' THEN 'cpu' || p_size END AS cpu, CASE WHEN p_type = 'ECONOMY' THEN p_size * 2 END AS ram,
              CASE WHEN p_type <> 'ECONOMY' THEN 'S,M' || CASE WHEN p_size > 25 THEN ',L' ELSE '' END END AS sizes FROM part""",
)
def doc_category_fields(t: Tables):
    """Fields differ by category; they are kept as one VARIANT column and read per category."""
    tech = F.to_json(F.struct(F.concat(lit("cpu"), col("p_size").cast("string")).alias("cpu"), (col("p_size") * 2).alias("ram")))
    sizes = when(col("p_size") > 25, F.array(lit("S"), lit("M"), lit("L"))).otherwise(F.array(lit("S"), lit("M")))
    cloth = F.to_json(F.struct(sizes.alias("sizes")))
    docs = t.part.select(
        "p_partkey", col("p_type").alias("category"),
        F.parse_json(when(col("p_type") == "ECONOMY", tech).otherwise(cloth)).alias("fields"),
    )
    return docs.select(
        "p_partkey", "category", F.try_variant_get("fields", "$.cpu", "string").alias("cpu"),
        F.try_variant_get("fields", "$.ram", "int").alias("ram"),
        F.array_join(F.try_variant_get("fields", "$.sizes", "array<string>"), ",").alias("sizes"),
    )


@query(
    "doc_discriminator",
    """SELECT event_id, event_type AS type, CASE WHEN event_type = 'purchase' THEN value END AS amount,
              CASE WHEN event_type <> 'purchase' THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k FROM events""",
)
def doc_discriminator(t: Tables):
    """The type field selects the shape of the payload."""
    paid = F.to_json(F.struct(col("value").alias("amount")))
    docs = t.events.select("event_id", col("event_type").alias("type"), when(col("event_type") == "purchase", paid).otherwise(col("props")).alias("payload"))
    amount = when(col("type") == "purchase", F.from_json("payload", "amount DOUBLE")["amount"])
    k = when(col("type") != "purchase", F.from_json("payload", "k INT")["k"])
    return docs.select("event_id", "type", amount.alias("amount"), k.alias("k"))


@query(
    "doc_schema_validate",
    f"""SELECT order_id, CASE WHEN status = 'P' THEN 'error' ELSE 'ok' END AS outcome, CASE WHEN status = 'P' THEN 'status' ELSE '' END AS reasons FROM {DOCS_SQL}""",
)
def doc_schema_validate(t: Tables):
    checked = with_reasons(order_totals(t.orders, t.customer, t.lineitem, whole=whole_quantities()), validation_rules())
    outcome = when(F.size("reasons") > 0, "error").otherwise("ok")
    return checked.select("order_id", outcome.alias("outcome"), F.array_join("reasons", ",").alias("reasons"))


@query(
    "schema_on_read_default",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE CAST(json_extract(props, '$.k') AS DOUBLE) END AS total FROM events""",
)
def schema_on_read_default(t: Tables):
    """Documents without the field read the default."""
    doc = when(col("event_type") == "error", lit("{}")).otherwise(col("props"))
    total = F.coalesce(F.get_json_object(doc, "$.k").cast("double"), lit(0.0))
    return t.events.select("event_id", total.alias("total"))


@query(
    "text_search_terms",
    """WITH s AS (SELECT doc_id, len(list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda w: w IN ('the', 'with', 'for'))) AS score FROM documents)
       SELECT doc_id, CAST(score AS BIGINT) AS score FROM s WHERE score > 0""",
)
def text_search_terms(t: Tables):
    """Any term matches; the score is the number of hits in the whole text."""
    scored = t.documents.select("doc_id", term_hits(col("text"), ["the", "with", "for"]).alias("score"))
    return scored.filter("score > 0")


@query(
    "ttl_expire",
    "SELECT event_id FROM events WHERE ts + INTERVAL 1800 SECOND > TIMESTAMP '2024-01-20 12:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'",
)
def ttl_expire(t: Tables, now: str = "2024-01-20 12:00:00", ttl: int = 1800):
    """Documents alive at a given time."""
    at = lit(now).cast("timestamp_ntz")
    alive = (col("ts") + F.make_dt_interval(secs=lit(ttl).cast("decimal(18,6)")) > at) & (col("ts") <= at)
    return t.events.filter(alive).select("event_id")


@query(
    "query_table_per_access",
    """SELECT 'conversation' AS layout, COUNT(*) AS n, COUNT(DISTINCT conv_id) AS keys FROM conversations
       UNION ALL SELECT 'user', COUNT(*), COUNT(DISTINCT role) FROM conversations""",
)
def query_table_per_access(t: Tables):
    """The same messages written twice, each laid out for one access path."""
    path = shared_path(t.spark, "messages")
    messages = t.conversations
    by_conv = messages.withColumn("bucket", (col("conv_id") % 16).cast("int"))
    by_conv.repartitionByRange("bucket", "conv_id", "turn").sortWithinPartitions("bucket", "conv_id", "turn").write.partitionBy("bucket").parquet(f"{path}/conversation")
    messages.repartitionByRange("role", "conv_id", "turn").sortWithinPartitions("role", "conv_id", "turn").write.partitionBy("role").parquet(f"{path}/user")

    def report(layout, key, schema):
        table = t.spark.read.schema(schema).parquet(f"{path}/{layout}")
        return table.agg(lit(layout).alias("layout"), rows().alias("n"), F.countDistinct(key).alias("keys"))

    return report("conversation", "conv_id", by_conv.schema).unionByName(report("user", "role", messages.schema))


@query(
    "time_bucket_partition",
    """SELECT user_id AS sensor_id, CAST(ts AS DATE) AS day_bucket, COUNT(*) AS n, round(MAX(value), 2) AS peak FROM events
       WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13' GROUP BY 1, 2""",
)
def time_bucket_partition(t: Tables):
    """Readings partitioned by day and sorted by sensor and time; a range of days reads three directories."""
    path = shared_path(t.spark, "sensors")
    readings = t.events.select(col("user_id").alias("sensor_id"), "ts", "value", day("ts").alias("day_bucket"))
    laid = readings.repartitionByRange("day_bucket", "sensor_id", "ts").sortWithinPartitions("day_bucket", "sensor_id", "ts")
    laid.write.partitionBy("day_bucket").parquet(path)
    table = t.spark.read.schema(readings.schema).parquet(path)
    span = table.filter("day_bucket >= DATE '2024-01-10' AND day_bucket < DATE '2024-01-13'")
    return span.groupBy("sensor_id", "day_bucket").agg(rows().alias("n"), F.round(F.max("value"), 2).alias("peak"))


@query(
    "wide_row_pivot",
    """SELECT user_id, """ + ", ".join(
        f"CAST(NULLIF(COUNT(CASE WHEN dayofweek(ts) = {i} THEN 1 END), 0) AS BIGINT) AS d{i}" for i in range(7)
    ) + " FROM events GROUP BY 1",
)
def wide_row_pivot(t: Tables):
    """One sparse column per weekday; the column list is given, so no extra pass finds it."""
    names = [f"d{i}" for i in range(7)]
    tagged = t.events.select("user_id", F.concat(lit("d"), (F.dayofweek("ts") - 1).cast("string")).alias("d"))
    return tagged.groupBy("user_id").pivot("d", names).agg(rows())


@query(
    "partition_balance_report",
    """WITH k AS (SELECT c_custkey AS k, ('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT % 2 AS h,
                  CASE WHEN c_custkey < (SELECT MAX(c_custkey) FROM customer) * 0.8 THEN 0 ELSE 1 END AS r FROM customer)
       SELECT 'hashed' AS layout, h AS shard, COUNT(*) AS n, round(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM k), 4) AS pct FROM k GROUP BY 2
       UNION ALL SELECT 'ranged', r, COUNT(*), round(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM k), 4) FROM k GROUP BY 2""",
)
def partition_balance_report(t: Tables):
    """Share per shard for hashed keys and for a range cut at 80 percent of the key space."""
    top = t.customer.agg(F.max("c_custkey")).scalar()
    hashed = md5_bucket(col("c_custkey").cast("string"), 2)
    ranged = when(col("c_custkey") < top * 0.8, 0).otherwise(1).cast("bigint")
    placed = t.customer.select(F.inline(F.array(
        F.struct(lit("hashed").alias("layout"), hashed.alias("shard")),
        F.struct(lit("ranged").alias("layout"), ranged.alias("shard")),
    )))
    counts = placed.groupBy("layout", "shard").agg(rows().alias("n"))
    total = Window.partitionBy("layout")  # two rows per layout
    return counts.withColumn("pct", F.round(col("n") * 100.0 / F.sum("n").over(total), 4))
