"""Grouped and global aggregates."""

from sparkwell.operators.revenue import RevenueStore
from sparkwell.operators.rollups import hourly_revenue, merge_partials, partial_sums
from sparkwell.plans.common import F, Tables, big, col, day, lit, net, query, rows, when
from sparkwell.session import shared_path


@query(
    "agg_count_forms",
    """SELECT COUNT(*) AS all_rows, COUNT(NULLIF(c_mktsegment, 'BUILDING')) AS non_null,
              COUNT(DISTINCT c_nationkey) AS nations FROM customer""",
)
def agg_count_forms(t: Tables):
    return t.customer.agg(
        rows().alias("all_rows"), F.count(F.nullif(col("c_mktsegment"), lit("BUILDING"))).alias("non_null"),
        F.countDistinct("c_nationkey").alias("nations"),
    )


@query(
    "agg_sum",
    """SELECT CAST(SUM(p_size) AS BIGINT) AS stock, CAST(SUM(CASE WHEN p_size % 2 = 0 THEN p_size END) AS BIGINT) AS even_stock,
              CAST(SUM(CASE WHEN p_size < 0 THEN p_size END) AS BIGINT) AS all_null FROM part""",
)
def agg_sum(t: Tables):
    size = col("p_size")
    return t.part.agg(
        F.sum(size).alias("stock"), F.sum(when(size % 2 == 0, size)).alias("even_stock"),
        F.sum(when(size < 0, size)).alias("all_null"),
    )


@query(
    "agg_avg_null",
    """SELECT round(AVG(NULLIF(p_size, 13)), 6) AS skips_nulls, round(AVG(CASE WHEN p_size = 13 THEN 0 ELSE p_size END), 6) AS null_as_zero,
              CAST(trunc(AVG(p_size)) AS BIGINT) AS truncated FROM part""",
)
def agg_avg_null(t: Tables):
    known = F.nullif(col("p_size"), lit(13))
    return t.part.agg(
        F.round(F.avg(known), 6).alias("skips_nulls"),
        F.round(F.avg(F.coalesce(known, lit(0))), 6).alias("null_as_zero"),
        F.avg("p_size").cast("bigint").alias("truncated"),
    )


@query(
    "agg_min_max",
    """SELECT MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi, CAST(MIN(o_orderdate) AS DATE) AS first_day,
              CAST(MAX(o_orderdate) AS DATE) AS last_day FROM orders""",
)
def agg_min_max(t: Tables):
    return t.orders.agg(
        F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"),
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"),
    )


@query(
    "agg_multi",
    """SELECT COUNT(*) AS n, round(SUM(l_extendedprice), 2) AS total, round(AVG(l_extendedprice), 6) AS mean,
              MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem""",
)
def agg_multi(t: Tables):
    price = col("l_extendedprice")
    return t.lineitem.agg(
        rows().alias("n"), F.round(F.sum(price), 2).alias("total"), F.round(F.avg(price), 6).alias("mean"),
        F.min(price).alias("lo"), F.max(price).alias("hi"),
    )


@query(
    "agg_stddev_var",
    """SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(var_samp(l_quantity), 6) AS var
       FROM lineitem GROUP BY 1""",
)
def agg_stddev_var(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.stddev_samp("l_quantity"), 6).alias("sd"), F.round(F.var_samp("l_quantity"), 6).alias("var")
    )


@query(
    "agg_string",
    """SELECT p_brand, string_agg(p_type, ', ' ORDER BY p_type) AS types FROM (SELECT DISTINCT p_brand, p_type FROM part)
       GROUP BY 1""",
)
def agg_string(t: Tables):
    """The distinct types of each brand as text; distinct first, so a list has at most one entry per type."""
    types = t.part.select("p_brand", "p_type").distinct()
    return types.groupBy("p_brand").agg(F.expr("listagg(p_type, ', ') WITHIN GROUP (ORDER BY p_type)").alias("types"))


@query("groupby_count", "SELECT p_brand, COUNT(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand")
def groupby_count(t: Tables):
    return t.part.groupBy("p_brand").agg(rows().alias("n")).orderBy(col("n").desc(), "p_brand")


@query(
    "groupby_multi_expr",
    "SELECT o_custkey, year(o_orderdate) AS y, COUNT(*) AS n FROM orders GROUP BY 1, 2",
)
def groupby_multi_expr(t: Tables):
    return t.orders.groupBy("o_custkey", big(F.year("o_orderdate")).alias("y")).agg(rows().alias("n"))


@query("having", "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1 HAVING COUNT(*) > 10")
def having(t: Tables):
    return t.orders.groupBy("o_custkey").agg(rows().alias("n")).filter("n > 10")


@query(
    "where_then_having",
    """SELECT l_suppkey, COUNT(*) AS n, round(AVG(l_extendedprice), 6) AS mean FROM lineitem WHERE l_quantity > 25
       GROUP BY 1 HAVING COUNT(*) > 290 ORDER BY mean DESC""",
)
def where_then_having(t: Tables):
    big_lines = t.lineitem.filter("l_quantity > 25").groupBy("l_suppkey")
    grouped = big_lines.agg(rows().alias("n"), F.round(F.avg("l_extendedprice"), 6).alias("mean"))
    return grouped.filter("n > 290").orderBy(col("mean").desc())


@query(
    "join_then_aggregate",
    """SELECT p_brand, COUNT(DISTINCT p_partkey) AS parts, round(AVG(l_quantity), 6) AS mean_qty, SUM(l_quantity) AS qty,
              COUNT(l_orderkey) AS lines
       FROM part LEFT JOIN (SELECT * FROM lineitem WHERE l_discount > 0.08) ON p_partkey = l_partkey
       GROUP BY 1 HAVING SUM(l_quantity) > 10000""",
)
def join_then_aggregate(t: Tables):
    """Lines are combined per part before the join, so the fact table shuffles partial sums only."""
    per_part = t.lineitem.filter("l_discount > 0.08").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("q"), rows().alias("n")
    )
    joined = t.part.join(per_part, col("p_partkey") == col("l_partkey"), "left")
    grouped = joined.groupBy("p_brand").agg(
        F.countDistinct("p_partkey").alias("parts"), F.round(F.sum("q") / F.sum("n"), 6).alias("mean_qty"),
        F.sum("q").alias("qty"), F.coalesce(F.sum("n"), lit(0)).alias("lines"),
    )
    return grouped.filter("qty > 10000")


@query(
    "agg_rollup",
    """SELECT p_brand, p_type, GROUPING(p_brand, p_type) AS level, COUNT(*) AS n, CAST(SUM(p_size) AS BIGINT) AS stock
       FROM part GROUP BY ROLLUP (p_brand, p_type)""",
)
def agg_rollup(t: Tables):
    return t.part.rollup("p_brand", "p_type").agg(
        F.grouping_id().alias("level"), rows().alias("n"), F.sum("p_size").alias("stock")
    )


@query(
    "agg_cube",
    """SELECT l_returnflag, l_linestatus, GROUPING(l_returnflag, l_linestatus) AS level, COUNT(*) AS n,
              round(SUM(l_quantity), 2) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
)
def agg_cube(t: Tables):
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(
        F.grouping_id().alias("level"), rows().alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")
    )


@query(
    "revenue_by_category",
    """SELECT p_brand AS category, round(SUM(l_extendedprice * (1 - l_discount)), 4) AS total_revenue
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
       GROUP BY 1 ORDER BY total_revenue DESC""",
)
def revenue_by_category(t: Tables):
    year = t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '1997-01-01' AND o_orderdate < TIMESTAMP_NTZ '1998-01-01'")
    per_part = (
        t.lineitem.join(year.select("o_orderkey"), col("l_orderkey") == col("o_orderkey"))
        .groupBy("l_partkey").agg(F.sum(net()).alias("revenue"))
    )
    joined = per_part.join(t.part.select("p_partkey", "p_brand"), col("l_partkey") == col("p_partkey"))
    total = joined.groupBy(col("p_brand").alias("category")).agg(F.round(F.sum("revenue"), 4).alias("total_revenue"))
    return total.orderBy(col("total_revenue").desc())


@query(
    "top_categories_by_rentals",
    """SELECT p_brand AS category, COUNT(*) AS rentals FROM lineitem JOIN part ON l_partkey = p_partkey
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       GROUP BY 1 ORDER BY rentals DESC, category LIMIT 3""",
)
def top_categories_by_rentals(t: Tables):
    kept = (
        t.lineitem.join(t.orders, col("l_orderkey") == col("o_orderkey"))
        .join(t.customer, col("o_custkey") == col("c_custkey"))
        .join(t.part, col("l_partkey") == col("p_partkey"))
    )
    counts = kept.groupBy(col("p_brand").alias("category")).agg(rows().alias("rentals"))
    return counts.orderBy(col("rentals").desc(), "category").limit(3)


@query("rows_per_day", "SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY 1")
def rows_per_day(t: Tables):
    return t.events.groupBy(day("ts").alias("day")).agg(rows().alias("n")).orderBy("day")


@query(
    "total_revenue",
    """SELECT CAST(ts AS DATE) AS day, hour(ts) AS hour, round(SUM(value), 2) AS revenue FROM events GROUP BY 1, 2""",
)
def total_revenue(t: Tables):
    return hourly_revenue(t.events, "ts", "value").select("day", "hour", F.round("revenue", 2).alias("revenue"))


@query(
    "avg_revenue",
    """SELECT hour, round(AVG(revenue), 6) AS avg_revenue FROM
         (SELECT CAST(ts AS DATE) AS day, hour(ts) AS hour, SUM(value) AS revenue FROM events GROUP BY 1, 2) GROUP BY 1""",
)
def avg_revenue(t: Tables):
    """Mean over days of the hourly revenue, not the mean per trip."""
    hourly = hourly_revenue(t.events, "ts", "value")
    return hourly.groupBy("hour").agg(F.round(F.avg("revenue"), 6).alias("avg_revenue"))


def revenue_store(t: Tables):
    """The store after three runs of its load: two rounds of day files, and one that finds nothing new."""
    root = shared_path(t.spark, "revenue")
    trips = t.events.select(
        col("ts").cast("timestamp").alias("tpep_pickup_datetime"), col("user_id").cast("int").alias("PULocationID"), col("value").alias("total_amount")
    )
    store = RevenueStore(t.spark, f"{root}/store")
    for part in (F.day("tpep_pickup_datetime") <= 15, F.day("tpep_pickup_datetime") > 15):
        trips.filter(part).write.mode("append").parquet(f"{root}/landing")
        store.run_etl(f"{root}/landing")
    if store.run_etl(f"{root}/landing"):
        raise AssertionError("a run without new files must change nothing")
    return store


@query("run_etl", "SELECT CAST(ts AS DATE) AS day, hour(ts) AS hour, round(SUM(value), 2) AS revenue, COUNT(value) AS trips FROM events GROUP BY 1, 2")
def run_etl(t: Tables):
    """What the incremental load keeps: a row for each date and hour."""
    return revenue_store(t).hourly.read().select("day", "hour", F.round("total", 2).alias("revenue"), col("n").alias("trips"))


@query(
    "stored_revenue",
    """SELECT CAST(h AS BIGINT) AS hour, COALESCE(round(SUM(CASE WHEN day = DATE '2024-01-15' THEN revenue END), 2), 0.0) AS total_revenue, COALESCE(round(AVG(revenue), 6), 0.0) AS avg_revenue
       FROM range(24) s(h) LEFT JOIN (SELECT CAST(ts AS DATE) AS day, hour(ts) AS hour, SUM(value) AS revenue FROM events GROUP BY 1, 2) ON hour = h GROUP BY 1""",
)
def stored_revenue(t: Tables, on: str = "2024-01-15"):
    """Both stored answers for each hour of the day: the revenue of one date, and the mean over all dates."""
    store = revenue_store(t)
    answers = [(h, store.total_revenue(on, h), round(store.avg_revenue(h), 6)) for h in range(24)]
    return t.spark.createDataFrame(answers, "hour BIGINT, total_revenue DOUBLE, avg_revenue DOUBLE")


@query(
    "revenue_day_hour_zone",
    """SELECT CAST(ts AS DATE) AS day, hour(ts) AS hour, user_id AS zone, round(SUM(value), 2) AS revenue,
              COUNT(*) AS trips FROM events GROUP BY 1, 2, 3""",
)
def revenue_day_hour_zone(t: Tables):
    cube = hourly_revenue(t.events, "ts", "value", extra=["user_id"])
    return cube.withColumnRenamed("user_id", "zone").withColumn("revenue", F.round("revenue", 2))


@query(
    "maintain_sum_count",
    """SELECT hour(ts) AS hour, round(SUM(value), 2) AS total, COUNT(*) AS n, round(AVG(value), 6) AS mean
       FROM events GROUP BY 1""",
)
def maintain_sum_count(t: Tables):
    """Batches of one day each; the batches of even days arrive twice and still count once."""
    batch = day("ts")
    parts = partial_sums(t.events, batch, [big(F.hour("ts")).alias("hour")], col("value"))
    replayed = parts.filter(F.day("batch_id") % 2 == 0)
    merged = merge_partials(parts.unionByName(replayed), ["hour"])
    return merged.select("hour", F.round("total", 2).alias("total"), "n", F.round("mean", 6).alias("mean"))


@query(
    "filter_group_dedupe_count",
    """SELECT 'total' AS job, CAST(o_custkey AS VARCHAR) AS item, round(SUM(o_totalprice), 2) AS value FROM orders
         WHERE o_totalprice > 100 GROUP BY 2
       UNION ALL SELECT 'customers', 'all', COUNT(DISTINCT o_custkey) FROM orders WHERE o_totalprice > 100
       UNION ALL SELECT 'category', o_orderpriority, COUNT(*) FROM orders WHERE o_totalprice > 100 GROUP BY 2""",
)
def filter_group_dedupe_count(t: Tables):
    kept = t.orders.filter("o_totalprice > 100")
    total = kept.groupBy(col("o_custkey").cast("string").alias("item")).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    unique = kept.agg(lit("all").alias("item"), F.countDistinct("o_custkey").cast("double").alias("value"))
    category = kept.groupBy(col("o_orderpriority").alias("item")).agg(rows().cast("double").alias("value"))
    tag = lambda name, df: df.select(lit(name).alias("job"), "item", "value")
    return tag("total", total).unionByName(tag("customers", unique)).unionByName(tag("category", category))


@query(
    "unique_order_multimeasure",
    """SELECT p_name AS title, p_brand AS author, l_quantity AS qty, CAST(o_orderdate AS DATE) AS order_day,
              round(p_retailprice * l_quantity, 2) AS revenue
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
)
def unique_order_multimeasure(t: Tables):
    """One line per sale, newest first."""
    sold = t.lineitem.join(t.orders, col("l_orderkey") == col("o_orderkey")).join(
        t.part, col("l_partkey") == col("p_partkey")
    )
    return sold.select(
        col("p_name").alias("title"), col("p_brand").alias("author"), col("l_quantity").alias("qty"),
        day("o_orderdate").alias("order_day"), F.round(col("p_retailprice") * col("l_quantity"), 2).alias("revenue"),
    ).orderBy(col("order_day").desc(), "title", "author")
