"""Sorting, limits, top-k and set operations."""

from sparkwell.operators.ordered import with_peers
from sparkwell.plans.common import F, Tables, col, day, lit, query, rows, when
from sparkwell.session import shared_path
from sparkwell.sources.sinks import write_sorted_partitions


@query(
    "order_by",
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey",
)
def order_by(t: Tables):
    """A global order by range partitioning; no single task sorts everything."""
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").orderBy(
        "c_mktsegment", col("c_acctbal").desc(), "c_custkey"
    )


@query(
    "order_by_forms",
    "SELECT p_partkey, round(p_retailprice * p_size, 2) AS worth FROM part ORDER BY worth DESC, 1, p_size % 5",
)
def order_by_forms(t: Tables):
    worth = F.round(col("p_retailprice") * col("p_size"), 2).alias("worth")
    return t.part.orderBy(worth.desc(), "p_partkey", col("p_size") % 5).select("p_partkey", worth)


@query(
    "order_nulls_last",
    """SELECT c_custkey, NULLIF(c_mktsegment, 'FURNITURE') AS segment FROM customer ORDER BY segment ASC NULLS LAST, c_custkey""",
)
def order_nulls_last(t: Tables):
    segment = F.nullif(col("c_mktsegment"), lit("FURNITURE")).alias("segment")
    return t.customer.select("c_custkey", segment).orderBy(col("segment").asc_nulls_last(), "c_custkey")


@query(
    "order_collation",
    """WITH n AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS name FROM part)
       SELECT lower(name) AS name_key, COUNT(*) AS n, DENSE_RANK() OVER (ORDER BY lower(name)) AS place FROM n GROUP BY 1""",
)
def order_collation(t: Tables):
    """Names equal up to case are one group and one place in the order."""
    name = when(col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(col("p_name"))
    folded = F.collate(name, "UTF8_LCASE")
    groups = t.part.groupBy(folded.alias("name")).agg(rows().alias("n"))
    plain = groups.select(F.lower(F.collate(col("name"), "UTF8_BINARY")).alias("name_key"), "n")
    return with_peers(plain, [], [("name_key", "asc")], dense_rank="place")


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_n(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(col("o_totalprice").desc(), "o_orderkey").limit(10)


@query(
    "top_customers_by_orders",
    """SELECT c_custkey, c_name, COUNT(o_orderkey) AS orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey
       GROUP BY ALL ORDER BY orders DESC, c_custkey LIMIT 10""",
)
def top_customers_by_orders(t: Tables):
    counts = t.orders.groupBy("o_custkey").agg(rows().alias("n"))
    joined = t.customer.join(counts, col("c_custkey") == col("o_custkey"), "left")
    named = joined.select("c_custkey", "c_name", F.coalesce("n", lit(0)).alias("orders"))
    return named.orderBy(col("orders").desc(), "c_custkey").limit(10)


@query("sampled_top")
def sampled_top(t: Tables):
    """Dearest orders of a repeatable one-percent sample: the sample is the feature."""
    sample = t.orders.sample(fraction=0.01, seed=7).select("o_orderkey", "o_totalprice")
    return sample.orderBy(col("o_totalprice").desc(), "o_orderkey").limit(10)


@query(
    "presorted_partition_write",
    """SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n, MIN(ts) AS first_ts, MAX(ts) AS last_ts FROM events GROUP BY 1""",
)
def presorted_partition_write(t: Tables):
    """Files sorted inside date partitions, read back with their time range."""
    path = shared_path(t.spark, "presorted")
    write_sorted_partitions(t.events.withColumn("day", day("ts")), path, "day", ["ts", "event_id"])
    written = t.spark.read.parquet(path)
    return written.groupBy("day").agg(rows().alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query(
    "leaderboard",
    """WITH s AS (SELECT user_id, arg_max(value, event_id) AS score FROM events GROUP BY 1)
       SELECT user_id, score, RANK() OVER (ORDER BY score DESC) AS place FROM s""",
)
def leaderboard(t: Tables):
    """The last score of each player wins; place 1 is the top."""
    scores = t.events.groupBy("user_id").agg(F.max_by("value", "event_id").alias("score"))
    return with_peers(scores, [], [("score", "desc")], rank="place")


@query(
    "union_distinct",
    "SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000 UNION SELECT s_nationkey FROM supplier",
)
def union_distinct(t: Tables):
    a = t.customer.filter("c_acctbal > 9000").select(col("c_nationkey").alias("nation"))
    return a.union(t.supplier.select("s_nationkey")).distinct()


@query(
    "union_all_tagged",
    "SELECT 'customer' AS source, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_name FROM supplier",
)
def union_all_tagged(t: Tables):
    a = t.customer.select(lit("customer").alias("source"), col("c_name").alias("name"))
    return a.union(t.supplier.select(lit("supplier"), "s_name"))


@query(
    "union_by_name_years",
    """SELECT year(o_orderdate) AS y, o_orderkey, o_totalprice,
              CASE WHEN year(o_orderdate) = 1997 THEN o_orderpriority END AS priority
       FROM orders WHERE year(o_orderdate) IN (1995, 1996, 1997)""",
)
def union_by_name_years(t: Tables):
    """Yearly tables, the last with one more column; missing columns read NULL."""

    def year_table(y, *extra):
        span = f"o_orderdate >= TIMESTAMP_NTZ '{y}-01-01' AND o_orderdate < TIMESTAMP_NTZ '{y + 1}-01-01'"
        return t.orders.filter(span).select(lit(y).cast("bigint").alias("y"), "o_orderkey", "o_totalprice", *extra)

    last = year_table(1997, col("o_orderpriority").alias("priority"))
    return year_table(1995).unionByName(year_table(1996)).unionByName(last, allowMissingColumns=True)


@query(
    "contact_list_union",
    """SELECT 'Customer' AS kind, c_name AS name, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey
       UNION ALL SELECT 'Supplier', s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
       UNION ALL SELECT 'Product', p_name, NULL FROM part ORDER BY 1, 2""",
)
def contact_list_union(t: Tables):
    def people(df, kind, name, nation):
        joined = df.join(t.nation, col(nation) == col("n_nationkey"))
        return joined.select(lit(kind).alias("kind"), col(name).alias("name"), col("n_name").alias("country"))

    products = t.part.select(
        lit("Product").alias("kind"), col("p_name").alias("name"), lit(None).cast("string").alias("country")
    )
    return (
        people(t.customer, "Customer", "c_name", "c_nationkey")
        .unionByName(people(t.supplier, "Supplier", "s_name", "s_nationkey"))
        .unionByName(products).orderBy("kind", "name")
    )


A_SQL = "SELECT NULLIF(p_size, 20) AS v FROM part WHERE p_brand <= 'Brand#14'"
B_SQL = "SELECT NULLIF(p_size, 20) AS v FROM part WHERE p_brand > 'Brand#14' AND p_size <= 40"


def two_sets(t: Tables):
    v = F.nullif(col("p_size"), lit(20)).alias("v")
    a = t.part.filter("p_brand <= 'Brand#14'").select(v)
    b = t.part.filter("p_brand > 'Brand#14' AND p_size <= 40").select(v)
    return a, b


@query("intersect", f"{A_SQL} INTERSECT {B_SQL}")
def intersect(t: Tables):
    """NULL matches NULL."""
    a, b = two_sets(t)
    return a.intersect(b)


@query("except", f"{A_SQL} EXCEPT {B_SQL}")
def except_(t: Tables):
    a, b = two_sets(t)
    return a.subtract(b)


@query(
    "set_op_precedence",
    f"""SELECT 'left_to_right' AS rule, v FROM (({A_SQL} UNION {B_SQL}) EXCEPT SELECT p_size FROM part WHERE p_size > 30)
        UNION ALL SELECT 'intersect_first', v FROM ({A_SQL} UNION ({B_SQL} INTERSECT SELECT p_size FROM part WHERE p_size > 30))""",
)
def set_op_precedence(t: Tables):
    a, b = two_sets(t)
    c = t.part.filter("p_size > 30").select("p_size")
    first = a.union(b).distinct().subtract(c)
    second = a.union(b.intersect(c)).distinct()
    return first.select(lit("left_to_right").alias("rule"), "v").union(second.select(lit("intersect_first"), "v"))


@query(
    "set_op_order",
    "SELECT c_name AS name FROM customer UNION SELECT s_name FROM supplier ORDER BY name DESC",
)
def set_op_order(t: Tables):
    names = t.customer.select(col("c_name").alias("name")).union(t.supplier.select("s_name"))
    return names.distinct().orderBy(col("name").desc())


@query(
    "topn_each_union",
    """(SELECT 'dearest' AS list, p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5)
       UNION ALL (SELECT 'cheapest', p_partkey FROM part ORDER BY p_retailprice, p_partkey LIMIT 5)""",
)
def topn_each_union(t: Tables):
    top = t.part.orderBy(col("p_retailprice").desc(), "p_partkey").limit(5)
    low = t.part.orderBy("p_retailprice", "p_partkey").limit(5)
    return top.select(lit("dearest").alias("list"), "p_partkey").union(low.select(lit("cheapest"), "p_partkey"))


@query(
    "set_op_coercion",
    "SELECT CAST(p_partkey AS VARCHAR) AS item FROM part UNION SELECT p_name FROM part",
)
def set_op_coercion(t: Tables):
    return t.part.select(col("p_partkey").cast("string").alias("item")).union(t.part.select("p_name")).distinct()


@query("symmetric_difference", f"({A_SQL} EXCEPT {B_SQL}) UNION ALL ({B_SQL} EXCEPT {A_SQL})")
def symmetric_difference(t: Tables):
    """Members of exactly one set, from one tagged aggregation instead of two anti-joins."""
    a, b = two_sets(t)
    tagged = a.withColumn("bit", lit(1)).unionByName(b.withColumn("bit", lit(2)))
    return tagged.groupBy("v").agg(F.bit_or("bit").alias("sides")).filter("sides <> 3").select("v")
