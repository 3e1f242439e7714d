"""Joins."""

from sparkwell.operators.joins import (
    as_of, band_counts, checked_broadcast, next_within, salted_join, tier_join,
)
from sparkwell.operators.ordered import over_rows, with_group_stats, with_peers
from sparkwell.operators.sketches import bloom_prefilter_join
from sparkwell.plans.common import F, Tables, col, day, lit, net, query, rows, when

EARLY = "o_orderdate < TIMESTAMP '1995-07-01'"
EARLY_ROWS = EARLY.replace("TIMESTAMP", "TIMESTAMP_NTZ")  # the column's own type, so the filter reaches the scan


@query(
    "join_inner",
    "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 5000",
)
def join_inner(t: Tables):
    rich = t.customer.filter(col("c_acctbal") > 5000)
    return t.orders.join(rich, col("o_custkey") == col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query(
    "join_using",
    """SELECT custkey, c_name, round(SUM(o_totalprice), 2) AS spend
       FROM (SELECT o_custkey AS custkey, o_totalprice FROM orders) JOIN
            (SELECT c_custkey AS custkey, c_name FROM customer) USING (custkey)
       GROUP BY custkey, c_name ORDER BY spend DESC, custkey LIMIT 3""",
)
def join_using(t: Tables):
    spend = t.orders.groupBy(col("o_custkey").alias("custkey")).agg(F.round(F.sum("o_totalprice"), 2).alias("spend"))
    names = t.customer.select(col("c_custkey").alias("custkey"), "c_name")
    return spend.join(names, "custkey").orderBy(col("spend").desc(), "custkey").limit(3)


@query(
    "join_left",
    f"""SELECT c_custkey, COUNT(o_orderkey) AS orders FROM customer
        LEFT JOIN (SELECT * FROM orders WHERE {EARLY}) ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def join_left(t: Tables):
    counts = t.orders.filter(EARLY_ROWS).groupBy("o_custkey").agg(F.count("o_orderkey").alias("orders"))
    joined = t.customer.join(counts, col("c_custkey") == col("o_custkey"), "left")
    return joined.select("c_custkey", F.coalesce("orders", lit(0)).alias("orders"))


@query(
    "join_right",
    f"""SELECT c_custkey, o_orderkey FROM (SELECT * FROM orders WHERE {EARLY})
        RIGHT JOIN customer ON o_custkey = c_custkey""",
)
def join_right(t: Tables):
    early = t.orders.filter(EARLY_ROWS)
    return early.join(t.customer, col("o_custkey") == col("c_custkey"), "right").select("c_custkey", "o_orderkey")


@query(
    "join_full",
    """SELECT a.c_custkey AS rich_key, b.o_custkey AS buyer_key FROM (SELECT * FROM customer WHERE c_acctbal > 5000) a
       FULL JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000) b ON c_custkey = o_custkey""",
)
def join_full(t: Tables):
    rich = t.customer.filter(col("c_acctbal") > 5000).select(col("c_custkey").alias("rich_key"))
    buyers = t.orders.filter(col("o_totalprice") > 400000).select(col("o_custkey").alias("buyer_key")).distinct()
    return rich.join(buyers, col("rich_key") == col("buyer_key"), "full")


@query(
    "full_join_mismatch",
    """SELECT COALESCE(a.p_partkey, b.p_partkey) AS part_key,
              CASE WHEN a.p_partkey IS NULL THEN 'new only' ELSE 'old only' END AS side
       FROM (SELECT p_partkey FROM part WHERE p_size <= 40) a FULL JOIN (SELECT p_partkey FROM part WHERE p_size >= 10) b
         ON a.p_partkey = b.p_partkey WHERE a.p_partkey IS NULL OR b.p_partkey IS NULL""",
)
def full_join_mismatch(t: Tables):
    old = t.part.filter(col("p_size") <= 40).select(col("p_partkey").alias("old_key"))
    new = t.part.filter(col("p_size") >= 10).select(col("p_partkey").alias("new_key"))
    diff = old.join(new, col("old_key") == col("new_key"), "full").filter(
        col("old_key").isNull() | col("new_key").isNull()
    )
    side = when(col("old_key").isNull(), "new only").otherwise("old only")
    return diff.select(F.coalesce("old_key", "new_key").alias("part_key"), side.alias("side"))


@query(
    "join_anti",
    f"SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND {EARLY})",
)
def join_anti(t: Tables):
    early = t.orders.filter(EARLY_ROWS)
    return t.customer.join(early, col("c_custkey") == col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query(
    "join_semi",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)",
)
def join_semi(t: Tables):
    large = t.orders.filter(col("o_totalprice") > 450000)
    return t.customer.join(large, col("c_custkey") == col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query(
    "not_in_null_safe",
    f"""WITH k AS (SELECT NULLIF(o_custkey, 7) AS k FROM orders WHERE {EARLY})
        SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT k FROM k WHERE k IS NOT NULL)""",
)
def not_in_null_safe(t: Tables):
    keys = t.orders.filter(EARLY_ROWS).select(F.nullif(col("o_custkey"), lit(7)).alias("k")).filter("k IS NOT NULL")
    return t.customer.join(keys, col("c_custkey") == col("k"), "left_anti").select("c_custkey")


@query("join_cross", "SELECT p_partkey, r_name FROM part CROSS JOIN region")
def join_cross(t: Tables):
    """All (part, region) pairs: the five region names travel as one array beside each part."""
    regions = t.region.agg(F.collect_list("r_name")).scalar()
    return t.part.select("p_partkey", F.explode(regions).alias("r_name"))


@query(
    "join_cross_grid",
    """SELECT c_custkey, CAST(d AS DATE) AS work_day
       FROM customer, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS s(d)""",
)
def join_cross_grid(t: Tables):
    days = F.expr("sequence(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)")
    return t.customer.select("c_custkey", F.explode(days).alias("work_day"))


@query(
    "join_self_hierarchy",
    """WITH e AS (SELECT c_custkey AS id, c_name AS name,
                         CASE WHEN c_custkey > 0 THEN c_custkey // 3 END AS boss FROM customer)
       SELECT e.id, e.name, m.name AS manager, g.name AS grandmanager
       FROM e LEFT JOIN e m ON e.boss = m.id LEFT JOIN e g ON m.boss = g.id""",
)
def join_self_hierarchy(t: Tables):
    boss = when(col("c_custkey") > 0, F.floor(col("c_custkey") / 3))
    e = t.customer.select(col("c_custkey").alias("id"), col("c_name").alias("name"), boss.alias("boss"))
    m, g = e.alias("m"), e.alias("g")
    return (
        e.alias("e").join(m, col("e.boss") == col("m.id"), "left").join(g, col("m.boss") == col("g.id"), "left")
        .select("e.id", "e.name", col("m.name").alias("manager"), col("g.name").alias("grandmanager"))
    )


SEED_SQL = "(SELECT * FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 1)"


def seed_product(t: Tables):
    """The dearest product; one row."""
    return t.part.orderBy(col("p_retailprice").desc(), "p_partkey").limit(1).select(
        col("p_partkey").alias("seed_key"), col("p_brand").alias("seed_brand"), col("p_retailprice").alias("seed_price")
    )


@query(
    "join_self_peers",
    f"""SELECT s.p_partkey AS seed_key, p.p_partkey AS peer_key, p.p_name AS peer_name, p.p_brand AS category
        FROM {SEED_SQL} s JOIN part p ON s.p_brand = p.p_brand AND s.p_partkey <> p.p_partkey""",
)
def join_self_peers(t: Tables):
    """Other products in the category of one product."""
    joined = t.part.join(F.broadcast(seed_product(t)), col("p_brand") == col("seed_brand"))
    return joined.filter(col("p_partkey") != col("seed_key")).select(
        "seed_key", col("p_partkey").alias("peer_key"), col("p_name").alias("peer_name"),
        col("p_brand").alias("category"),
    )


@query(
    "join_self_pairs",
    """SELECT * FROM (SELECT p_retailprice AS price, p_partkey AS product1,
              LEAD(p_partkey) OVER (PARTITION BY p_retailprice ORDER BY p_partkey) AS product2,
              COUNT(*) OVER (PARTITION BY p_retailprice) AS same_price,
              COUNT(*) OVER (PARTITION BY p_retailprice) * (COUNT(*) OVER (PARTITION BY p_retailprice) - 1) // 2 AS pairs
       FROM part) WHERE product2 IS NOT NULL""",
)
def join_self_pairs(t: Tables):
    """Equal-price products as a chain: each with the next id of its price, plus the pair count.

    The chain holds every group whole in n - 1 rows; n (n - 1) / 2 pair rows follow from it.
    """
    parts = t.part.select(col("p_retailprice").alias("price"), col("p_partkey").alias("product1"))
    chain = over_rows(
        parts, ["price"], [("product1", "asc")], {"product2": lambda w: F.lead("product1").over(w)}, after=1
    )
    sized = with_group_stats(chain, ["price"], same_price=rows())
    pairs = F.floor(col("same_price") * (col("same_price") - 1) / 2)
    return sized.withColumn("pairs", pairs).filter(col("product2").isNotNull())


@query(
    "join_band",
    """SELECT a.p_partkey, a.p_retailprice, COUNT(*) - 1 AS similar_products FROM part a
       JOIN part b ON abs(round(a.p_retailprice - b.p_retailprice, 6)) <= 5 GROUP BY ALL""",
)
def join_band(t: Tables):
    """Products within 5 of each product's price."""
    return band_counts(t.part.select("p_partkey", "p_retailprice"), "p_retailprice", 5.0, "similar_products")


@query(
    "join_theta",
    f"""SELECT s.p_partkey AS seed_key, p.p_partkey AS cheaper_key, round(s.p_retailprice - p.p_retailprice, 2) AS savings
        FROM {SEED_SQL} s JOIN part p ON s.p_brand = p.p_brand AND p.p_retailprice < s.p_retailprice""",
)
def join_theta(t: Tables):
    seed = F.broadcast(seed_product(t))
    cheaper = (col("p_brand") == col("seed_brand")) & (col("p_retailprice") < col("seed_price"))
    return t.part.join(seed, cheaper).select(
        "seed_key", col("p_partkey").alias("cheaper_key"),
        F.round(col("seed_price") - col("p_retailprice"), 2).alias("savings"),
    )


@query(
    "join_vs_group_avg",
    """SELECT p_partkey, p_brand, round(avg_price, 6) AS avg_price FROM part
       JOIN (SELECT p_brand AS b, AVG(p_retailprice) AS avg_price FROM part GROUP BY 1) ON b = p_brand
       WHERE p_retailprice > avg_price""",
)
def join_vs_group_avg(t: Tables):
    priced = t.part.select("p_partkey", "p_brand", "p_retailprice")
    stats = with_group_stats(priced, ["p_brand"], avg_price=F.avg("p_retailprice"))
    return stats.filter(col("p_retailprice") > col("avg_price")).select(
        "p_partkey", "p_brand", F.round("avg_price", 6).alias("avg_price")
    )


TIERS = [("Low", 0, 50000), ("Medium", 50000, 250000), ("High", 250000, 400000)]


@query(
    "join_range_tiers",
    """WITH tiers(tier, lo, hi) AS (VALUES ('Low', 0, 50000), ('Medium', 50000, 250000), ('High', 250000, 400000))
       SELECT o_orderkey, o_totalprice, tier FROM orders JOIN tiers ON o_totalprice >= lo AND o_totalprice < hi""",
)
def join_range_tiers(t: Tables):
    return tier_join(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", TIERS)


@query(
    "running_total_self_join",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day,
              round(SUM(o_totalprice) OVER (ORDER BY o_orderdate RANGE UNBOUNDED PRECEDING), 2) AS running_total FROM orders""",
)
def running_total_self_join(t: Tables):
    orders = t.orders.select("o_orderkey", day("o_orderdate").alias("order_day"), "o_totalprice")
    total = with_peers(orders, [], [("order_day", "asc")], sums={"running_total": col("o_totalprice")})
    return total.select("o_orderkey", "order_day", F.round("running_total", 2).alias("running_total"))


@query(
    "join_multiway",
    """SELECT o_orderkey, c_name, s_name, p_name, n_name AS country, l_linenumber, l_quantity,
              round(l_extendedprice * (1 - l_discount), 4) AS line_total
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
)
def join_multiway(t: Tables):
    return (
        t.lineitem.join(t.orders, col("l_orderkey") == col("o_orderkey"))
        .join(t.customer, col("o_custkey") == col("c_custkey"))
        .join(t.nation, col("c_nationkey") == col("n_nationkey"))
        .join(t.part, col("l_partkey") == col("p_partkey"))
        .join(t.supplier, col("l_suppkey") == col("s_suppkey"))
        .select(
            "o_orderkey", "c_name", "s_name", "p_name", col("n_name").alias("country"), "l_linenumber", "l_quantity",
            F.round(net(), 4).alias("line_total"),
        )
    )


@query(
    "join_outer_filter_placement",
    """SELECT 'on' AS placement, COUNT(*) AS n, COUNT(o_orderkey) AS matched FROM customer
       LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 450000
       UNION ALL SELECT 'where', COUNT(*), COUNT(o_orderkey) FROM customer
       LEFT JOIN orders ON o_custkey = c_custkey WHERE o_totalprice > 450000""",
)
def join_outer_filter_placement(t: Tables):
    keys = col("c_custkey") == col("o_custkey")
    high = col("o_totalprice") > 450000
    in_on = t.customer.join(t.orders, keys & high, "left")
    in_where = t.customer.join(t.orders, keys, "left").filter(high)
    count = [rows().alias("n"), F.count("o_orderkey").alias("matched")]
    return in_on.agg(lit("on").alias("placement"), *count).unionByName(
        in_where.agg(lit("where").alias("placement"), *count)
    )


@query(
    "join_cardinality_check",
    """SELECT (SELECT COUNT(*) FROM orders) AS one_side, (SELECT COUNT(DISTINCT o_orderkey) FROM orders) AS one_keys,
              (SELECT COUNT(*) FROM lineitem) AS expected,
              (SELECT COUNT(*) FROM orders JOIN lineitem ON o_orderkey = l_orderkey) AS actual""",
)
def join_cardinality_check(t: Tables):
    """Joined row count from key counts: no joined rows are built."""
    left = t.orders.groupBy(col("o_orderkey").alias("k")).agg(rows().alias("a"))
    right = t.lineitem.groupBy(col("l_orderkey").alias("k")).agg(rows().alias("b"))
    both = left.join(right, "k", "full")
    return both.agg(
        F.sum("a").alias("one_side"), F.count("a").alias("one_keys"), F.sum("b").alias("expected"),
        F.sum(col("a") * col("b")).alias("actual"),
    )


@query(
    "duplicate_key_check",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""",
)
def duplicate_key_check(t: Tables):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(rows().alias("copies")).filter(col("copies") > 1)


@query(
    "join_broadcast",
    """SELECT s_name, COUNT(*) AS lines, round(SUM(l_extendedprice), 2) AS revenue
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name""",
)
def join_broadcast(t: Tables):
    names = checked_broadcast(t.supplier.select("s_suppkey", "s_name"))
    joined = t.lineitem.join(names, col("l_suppkey") == col("s_suppkey"))
    return joined.groupBy("s_name").agg(rows().alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


@query(
    "join_bloom_prefilter",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_totalprice FROM lineitem
       JOIN orders ON l_orderkey = o_orderkey WHERE o_totalprice > 480000""",
)
def join_bloom_prefilter(t: Tables):
    lines = t.lineitem.select(col("l_orderkey"), "l_linenumber", "l_partkey", "l_suppkey")
    large = t.orders.filter(col("o_totalprice") > 480000)
    return bloom_prefilter_join(lines, large.select(col("o_orderkey").alias("l_orderkey"), "o_totalprice"), "l_orderkey")


@query(
    "join_salted",
    """SELECT p_brand, COUNT(*) AS lines, round(SUM(l_extendedprice), 2) AS revenue
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""",
)
def join_salted(t: Tables):
    lines = t.lineitem.select(col("l_partkey").alias("p_partkey"), "l_extendedprice", "l_orderkey", "l_linenumber")
    joined = salted_join(lines, t.part.select("p_partkey", "p_brand"), "p_partkey")
    return joined.groupBy("p_brand").agg(rows().alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


FUNNEL_SQL = """WITH e AS (SELECT user_id AS actor, json_extract(props, '$.k')::INT % 4 AS repo, event_type, ts FROM events),
  star AS (SELECT DISTINCT a.repo, a.actor, b.actor IS NOT NULL AS hit FROM (SELECT * FROM e WHERE event_type = 'view') a
    LEFT JOIN (SELECT * FROM e WHERE event_type = 'click') b
      ON a.actor = b.actor AND a.repo = b.repo AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 2 DAY),
  fork AS (SELECT DISTINCT a.repo, a.actor, b.actor IS NOT NULL AS hit FROM (SELECT * FROM e WHERE event_type = 'click') a
    LEFT JOIN (SELECT * FROM e WHERE event_type = 'purchase') b
      ON a.actor = b.actor AND a.repo = b.repo AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 5 DAY),
  s AS (SELECT repo, COUNT(DISTINCT actor) AS stargazers, COUNT(DISTINCT CASE WHEN hit THEN actor END) AS forked FROM star GROUP BY repo),
  f AS (SELECT repo, COUNT(DISTINCT actor) AS forkers, COUNT(DISTINCT CASE WHEN hit THEN actor END) AS opened FROM fork GROUP BY repo)"""


def funnel_events(t: Tables):
    repo = F.get_json_object("props", "$.k").cast("int") % 4
    return t.events.select(col("user_id").alias("actor"), repo.alias("repo"), "event_type", "ts")


def step_counts(events, first, second, interval, total, hit):
    a = events.filter(col("event_type") == first).select("actor", "repo", "ts")
    b = events.filter(col("event_type") == second).select("actor", "repo", "ts")
    flagged = next_within(a, b, ["actor", "repo"], "ts", F.expr(interval), "hit")
    per_actor = flagged.groupBy("repo", "actor").agg(F.max("hit").alias("hit"))
    return per_actor.groupBy("repo").agg(rows().alias(total), F.count_if("hit").alias(hit))


@query("join_interval_funnel", FUNNEL_SQL + " SELECT repo, stargazers, forked, forkers, opened FROM s JOIN f USING (repo)")
def join_interval_funnel(t: Tables):
    events = funnel_events(t)
    stars = step_counts(events, "view", "click", "INTERVAL 2 DAYS", "stargazers", "forked")
    forks = step_counts(events, "click", "purchase", "INTERVAL 5 DAYS", "forkers", "opened")
    return stars.join(forks, "repo")


@query(
    "join_point_in_time",
    """WITH p AS (SELECT l_partkey AS part_key, CAST(l_shipdate AS DATE) AS valid_from,
                         MAX(l_extendedprice / l_quantity) AS price FROM lineitem GROUP BY 1, 2),
            v AS (SELECT *, LEAD(valid_from) OVER (PARTITION BY part_key ORDER BY valid_from) AS next_from FROM p),
            f AS (SELECT l_partkey AS part_key, l_orderkey, l_linenumber, l_suppkey, CAST(o_orderdate AS DATE) AS order_day
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
       SELECT f.*, v.valid_from, v.price FROM f LEFT JOIN v ON f.part_key = v.part_key
         AND f.order_day >= v.valid_from AND (f.order_day < v.next_from OR v.next_from IS NULL)""",
)
def join_point_in_time(t: Tables):
    """Unit price of a part as of the order day, from the price history of its shipments."""
    unit = col("l_extendedprice") / col("l_quantity")
    history = t.lineitem.groupBy(col("l_partkey").alias("part_key"), day("l_shipdate").alias("valid_from")).agg(
        F.max(unit).alias("price")
    )
    facts = t.lineitem.join(t.orders, col("l_orderkey") == col("o_orderkey")).select(
        col("l_partkey").alias("part_key"), "l_orderkey", "l_linenumber", "l_suppkey",
        day("o_orderdate").alias("order_day"),
    )
    return as_of(facts, history, ["part_key"], "order_day", "valid_from", ["price"])
