"""Subqueries, common table expressions and hierarchies."""

from sparkwell.operators.hierarchy import expand_hierarchy, walk_until_repeat
from sparkwell.operators.ordered import join_back, with_group_stats, with_peers
from sparkwell.plans.common import F, Tables, big, col, day, lit, net, query, rows, when


@query(
    "scalar_subquery",
    """SELECT p_partkey, p_retailprice, p_size FROM part
       WHERE p_retailprice > (SELECT AVG(p_retailprice) FROM part) OR p_size = (SELECT MAX(p_size) FROM part)""",
)
def scalar_subquery(t: Tables):
    average = t.part.agg(F.avg("p_retailprice")).scalar()
    largest = t.part.agg(F.max("p_size")).scalar()
    kept = t.part.filter((col("p_retailprice") > average) | (col("p_size") == largest))
    return kept.select("p_partkey", "p_retailprice", "p_size")


@query(
    "correlated_subquery",
    """SELECT p_partkey, p_type, p_size FROM part a
       WHERE p_size > (SELECT AVG(p_size) FROM part b WHERE b.p_type = a.p_type)""",
)
def correlated_subquery(t: Tables):
    sized = t.part.select("p_partkey", "p_type", "p_size")
    return with_group_stats(sized, ["p_type"], mean=F.avg("p_size")).filter("p_size > mean").drop("mean")


@query(
    "correlated_count_compare",
    """SELECT c_custkey, n FROM customer JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey
       WHERE n > (SELECT COUNT(*) // COUNT(DISTINCT o_custkey) FROM orders)""",
)
def correlated_count_compare(t: Tables):
    """More orders than the truncated mean, taken from the per-customer counts."""
    counts = t.orders.groupBy("o_custkey").agg(rows().alias("n"))
    mean = counts.agg(F.expr("sum(n) div count(1)")).scalar()
    frequent = counts.filter(col("n") > mean)
    return t.customer.join(frequent, col("c_custkey") == col("o_custkey")).select("c_custkey", "n")


@query(
    "select_list_subquery",
    """SELECT c_custkey, (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000) AS large_orders
       FROM customer""",
)
def select_list_subquery(t: Tables):
    counts = t.orders.filter(col("o_totalprice") > 450000).groupBy("o_custkey").agg(rows().alias("n"))
    joined = t.customer.join(counts, col("c_custkey") == col("o_custkey"), "left")
    return joined.select("c_custkey", F.coalesce("n", lit(0)).alias("large_orders"))


@query(
    "derived_table",
    """SELECT o_orderkey, o_custkey, round(avg_freight, 6) AS avg_freight FROM orders
       JOIN (SELECT o_custkey AS k, AVG(o_totalprice) AS avg_freight FROM orders GROUP BY 1) ON k = o_custkey
       WHERE o_totalprice > avg_freight""",
)
def derived_table(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    stats = with_group_stats(orders, ["o_custkey"], avg_freight=F.avg("o_totalprice"))
    return stats.filter(col("o_totalprice") > col("avg_freight")).select(
        "o_orderkey", "o_custkey", F.round("avg_freight", 6).alias("avg_freight")
    )


@query(
    "quantified_any",
    "SELECT p_partkey FROM part WHERE p_retailprice > ANY (SELECT p_retailprice FROM part WHERE p_size = 50)",
)
def quantified_any(t: Tables):
    lowest = t.part.filter("p_size = 50").agg(F.min("p_retailprice")).scalar()
    return t.part.filter(col("p_retailprice") > lowest).select("p_partkey")


@query(
    "quantified_all",
    """SELECT 'values' AS set_kind, p_partkey FROM part
         WHERE p_retailprice > ALL (SELECT p_retailprice FROM part WHERE p_size = 50)
       UNION ALL SELECT 'empty', p_partkey FROM part WHERE p_retailprice > ALL (SELECT p_retailprice FROM part WHERE p_size < 0)
       UNION ALL SELECT 'with_null', p_partkey FROM part
         WHERE p_retailprice > ALL (SELECT NULLIF(p_retailprice, 900.0) FROM part WHERE p_retailprice < 901)""",
)
def quantified_all(t: Tables):
    """Empty set: true for every row. Set with a NULL: never true."""

    def beats_all(kind, values):
        facts = values.agg(F.max("v").alias("top"), rows().alias("n"), F.count("v").alias("known"))
        test = facts.select(F.struct("*")).scalar()
        picked = t.part.select("p_partkey", "p_retailprice", test.alias("s"))
        wins = (col("s.n") == 0) | ((col("s.known") == col("s.n")) & (col("p_retailprice") > col("s.top")))
        return picked.filter(wins).select(lit(kind).alias("set_kind"), "p_partkey")

    price = col("p_retailprice")
    sets = {
        "values": t.part.filter("p_size = 50").select(price.alias("v")),
        "empty": t.part.filter("p_size < 0").select(price.alias("v")),
        "with_null": t.part.filter(price < 901).select(F.nullif(price, lit(900.0)).alias("v")),
    }
    parts = [beats_all(k, v) for k, v in sets.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "topn_per_group_count",
    """SELECT p_partkey, p_brand, p_retailprice FROM part a
       WHERE (SELECT COUNT(*) FROM part b WHERE b.p_brand = a.p_brand AND b.p_retailprice >= a.p_retailprice) <= 3""",
)
def topn_per_group_count(t: Tables):
    priced = t.part.select("p_partkey", "p_brand", "p_retailprice")
    counted = with_peers(priced, ["p_brand"], [("p_retailprice", "desc")], sums={"at_least": lit(1)})
    return counted.filter("at_least <= 3").drop("at_least")


@query(
    "cte_single",
    """WITH a AS (SELECT AVG(p_retailprice) AS avg_price FROM part)
       SELECT p_partkey, p_retailprice, round(avg_price, 6) AS avg_price FROM part, a WHERE p_retailprice > avg_price""",
)
def cte_single(t: Tables):
    average = t.part.agg(F.avg("p_retailprice")).scalar()
    priced = t.part.select("p_partkey", "p_retailprice", average.alias("avg_price"))
    return priced.filter(col("p_retailprice") > col("avg_price")).withColumn("avg_price", F.round("avg_price", 6))


@query(
    "cte_multi",
    """WITH s AS (SELECT p_brand, COUNT(*) AS n, AVG(p_retailprice) AS mean FROM part GROUP BY 1),
            f AS (SELECT * FROM s WHERE n > 70)
       SELECT p_partkey, p_name, part.p_brand, n, round(mean, 6) AS mean FROM part JOIN f ON f.p_brand = part.p_brand
       WHERE p_retailprice > mean""",
)
def cte_multi(t: Tables):
    stats = t.part.groupBy("p_brand").agg(rows().alias("n"), F.avg("p_retailprice").alias("mean"))
    joined = join_back(t.part.select("p_partkey", "p_name", "p_brand", "p_retailprice"), stats.filter("n > 70"), ["p_brand"])
    return joined.filter("p_retailprice > mean").drop("p_retailprice").withColumn("mean", F.round("mean", 6))


@query(
    "cte_reuse_union",
    """WITH s AS (SELECT p_partkey, p_size FROM part)
       SELECT 'High' AS level, * FROM s WHERE p_size > 40 UNION ALL SELECT 'Low', * FROM s WHERE p_size < 20""",
)
def cte_reuse_union(t: Tables):
    """Both branches from one scan."""
    level = when(col("p_size") > 40, "High").when(col("p_size") < 20, "Low")
    return t.part.select(level.alias("level"), "p_partkey", "p_size").filter(col("level").isNotNull())


@query(
    "cte_order_revenue",
    """WITH r AS (SELECT l_orderkey, SUM(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem GROUP BY 1)
       SELECT o_orderkey, o_custkey, round(revenue, 4) AS revenue FROM orders JOIN r ON o_orderkey = l_orderkey
       WHERE revenue > 100000""",
)
def cte_order_revenue(t: Tables):
    revenue = t.lineitem.groupBy("l_orderkey").agg(F.sum(net()).alias("revenue")).filter("revenue > 100000")
    joined = t.orders.join(revenue, col("o_orderkey") == col("l_orderkey"))
    return joined.select("o_orderkey", "o_custkey", F.round("revenue", 4).alias("revenue"))


@query(
    "monthly_summary",
    """SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, COUNT(*) AS orders, round(SUM(o_totalprice), 2) AS freight
       FROM orders GROUP BY 1, 2 HAVING SUM(o_totalprice) > 1000""",
)
def monthly_summary(t: Tables):
    month = [big(F.year("o_orderdate")).alias("y"), big(F.month("o_orderdate")).alias("m")]
    totals = t.orders.groupBy(*month).agg(rows().alias("orders"), F.sum("o_totalprice").alias("freight"))
    return totals.filter("freight > 1000").withColumn("freight", F.round("freight", 2))


@query(
    "orphan_checks_union",
    """SELECT 'order without customer' AS issue, o_orderkey AS row_id, CAST(o_custkey AS VARCHAR) AS bad_key FROM orders
         WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > -900)
       UNION ALL SELECT 'line without part', l_orderkey, CAST(l_partkey AS VARCHAR) FROM lineitem
         WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 50)""",
)
def orphan_checks_union(t: Tables):
    customers = t.customer.filter("c_acctbal > -900")
    parts = t.part.filter("p_size < 50")
    no_customer = t.orders.join(customers, col("o_custkey") == col("c_custkey"), "left_anti").select(
        lit("order without customer").alias("issue"), col("o_orderkey").alias("row_id"),
        col("o_custkey").cast("string").alias("bad_key"),
    )
    no_part = t.lineitem.join(parts, col("l_partkey") == col("p_partkey"), "left_anti").select(
        lit("line without part").alias("issue"), col("l_orderkey").alias("row_id"),
        col("l_partkey").cast("string").alias("bad_key"),
    )
    return no_customer.unionByName(no_part)


STAFF_SQL = """WITH RECURSIVE e AS (SELECT c_custkey AS id, c_name AS name,
                 CASE WHEN c_custkey > 0 THEN c_custkey // 3 END AS boss FROM customer)"""


def staff_tree(t: Tables):
    boss = when(col("c_custkey") > 0, F.floor(col("c_custkey") / 3))
    return expand_hierarchy(t.customer.withColumn("boss", boss), "c_custkey", "boss", col("c_name"))


@query(
    "recursive_hierarchy",
    STAFF_SQL + """, r AS (SELECT id, name, CAST(0 AS BIGINT) AS level FROM e WHERE boss IS NULL
       UNION ALL SELECT e.id, e.name, level + 1 FROM e JOIN r ON e.boss = r.id)
       SELECT id, level, repeat('  ', level::INT) || name AS label FROM r""",
)
def recursive_hierarchy(t: Tables):
    label = F.concat(F.repeat(lit("  "), col("level").cast("int")), F.element_at("names", -1))
    return staff_tree(t).select("id", "level", label.alias("label"))


@query(
    "recursive_path_to_root",
    STAFF_SQL + """, r AS (SELECT id AS start, name AS path, boss AS next, CAST(0 AS BIGINT) AS depth FROM e
       UNION ALL SELECT start, path || ' -> ' || e.name, e.boss, depth + 1 FROM r JOIN e ON r.next = e.id)
       SELECT start, path, depth FROM r WHERE next IS NULL""",
)
def recursive_path_to_root(t: Tables):
    path = F.array_join(F.reverse("names"), " -> ")
    return staff_tree(t).select(col("id").alias("start"), path.alias("path"), col("level").alias("depth"))


@query(
    "recursive_full_path",
    """SELECT r_name AS path, CAST(0 AS BIGINT) AS level FROM region
       UNION ALL SELECT r_name || ' > ' || n_name, 1 FROM nation JOIN region ON n_regionkey = r_regionkey
       UNION ALL SELECT r_name || ' > ' || n_name || ' > ' || c_name, 2 FROM customer
         JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def recursive_full_path(t: Tables):
    """region > nation > customer as one parent-child table."""
    key = lambda kind, c: F.concat(lit(kind), col(c).cast("string"))
    nodes = (
        t.region.select(key("r", "r_regionkey").alias("node"), lit(None).cast("string").alias("parent"), col("r_name").alias("name"))
        .unionByName(t.nation.select(key("n", "n_nationkey").alias("node"), key("r", "n_regionkey").alias("parent"), col("n_name").alias("name")))
        .unionByName(t.customer.select(key("c", "c_custkey").alias("node"), key("n", "c_nationkey").alias("parent"), col("c_name").alias("name")))
    )
    tree = expand_hierarchy(nodes, "node", "parent", col("name"))
    return tree.select(F.array_join("names", " > ").alias("path"), "level")


@query(
    "recursive_cycle_guard",
    """WITH RECURSIVE r AS (SELECT c_custkey AS start, [c_custkey] AS path, (c_custkey * 2 + 1) % 12 AS nxt FROM customer
       UNION ALL SELECT start, list_append(path, nxt), (nxt * 2 + 1) % 12 FROM r WHERE NOT list_contains(path, nxt))
       SELECT start, array_to_string(path, '>') AS path, len(path) AS steps FROM r WHERE list_contains(path, nxt)""",
)
def recursive_cycle_guard(t: Tables):
    edges = t.customer.select(col("c_custkey").alias("src"), ((col("c_custkey") * 2 + 1) % 12).alias("dst"))
    walks = walk_until_repeat(t.customer.select(col("c_custkey").alias("start")), edges)
    return walks.select("start", F.array_join("path", ">").alias("path"), big(F.size("path")).alias("steps"))


@query(
    "number_sequence",
    """SELECT n, (SELECT COUNT(*) FROM part WHERE p_size = n AND p_type = 'PROMO' AND p_brand <> 'Brand#5') AS parts
       FROM range(1, (SELECT MAX(p_size) + 1 FROM part)) s(n)""",
)
def number_sequence(t: Tables):
    numbers = t.part.agg(F.max("p_size").alias("top")).select(F.explode(F.sequence(lit(1), "top")).alias("n"))
    promo = t.part.filter((col("p_type") == "PROMO") & (col("p_brand") != "Brand#5"))
    counts = promo.groupBy(col("p_size").alias("n")).agg(rows().alias("c"))
    return numbers.join(counts, "n", "left").select(big(col("n")).alias("n"), F.coalesce("c", lit(0)).alias("parts"))


@query(
    "date_sequence",
    """WITH d AS (SELECT CAST(unnest(generate_series((SELECT MIN(o_orderdate) FROM orders),
                  (SELECT MAX(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS day)
       SELECT day, COUNT(o_orderkey) AS orders FROM d LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day
         AND o_orderpriority = '1-URGENT' GROUP BY day""",
)
def date_sequence(t: Tables):
    span = t.orders.agg(F.min(day("o_orderdate")).alias("a"), F.max(day("o_orderdate")).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("day"))
    urgent = t.orders.filter(col("o_orderpriority") == "1-URGENT")
    counts = urgent.groupBy(day("o_orderdate").alias("day")).agg(rows().alias("n"))
    return days.join(counts, "day", "left").select("day", F.coalesce("n", lit(0)).alias("orders"))
