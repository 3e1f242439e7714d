"""Key-value patterns and sketches as table jobs."""

from sparkwell.functions.hashing import hash_slot, md5_bucket, with_ring_node
from sparkwell.operators import sketches
from sparkwell.operators.ordered import latest_per_key, top_per_group, with_group_stats, with_row_number
from sparkwell.operators.stock import admit_orders
from sparkwell.plans.common import F, Tables, big, col, day, lit, query, rows, when
from sparkwell.session import cut_lineage, shared_path


@query(
    "recently_viewed",
    """SELECT user_id, string_agg(event_id, ',' ORDER BY ts DESC, event_id DESC) AS recent FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
       ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type = 'view') WHERE rn <= 10 GROUP BY 1""",
)
def recently_viewed(t: Tables):
    """Last ten views per user, newest first, duplicates kept."""
    views = t.events.filter("event_type = 'view'").select("user_id", "event_id", "ts")
    last = top_per_group(views, ["user_id"], [("ts", "desc"), ("event_id", "desc")], 10)
    listed = last.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("rn", "event_id"))).alias("l"))
    return listed.select("user_id", F.array_join(F.transform("l", lambda x: x["event_id"].cast("string")), ",").alias("recent"))


@query(
    "inventory_counters",
    """SELECT p_partkey, p_size * 100 AS stock, CAST(COALESCE(sold, 0) AS BIGINT) AS sold, CAST(p_size * 100 - COALESCE(sold, 0) AS BIGINT) AS left_over FROM part
       LEFT JOIN (SELECT l_partkey, SUM(l_quantity) AS sold FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' GROUP BY 1) ON l_partkey = p_partkey""",
)
def inventory_counters(t: Tables):
    """Stock minus the quantities of orders that went through; pending orders change nothing."""
    done = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey")
    sold = t.lineitem.join(done, col("l_orderkey") == col("o_orderkey")).groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    joined = t.part.join(sold, col("p_partkey") == col("l_partkey"), "left")
    q = F.coalesce("q", lit(0.0))
    stock = col("p_size") * 100
    return joined.select("p_partkey", stock.alias("stock"), big(q).alias("sold"), big(stock - q).alias("left_over"))


@query(
    "order_admission",
    """WITH RECURSIVE d AS (SELECT o_orderkey AS o, o_orderdate AS ts, l_partkey AS p, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q, CAST(any_value(p_size) * 30 AS BIGINT) AS stock
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
          r AS (SELECT o, ts, p, q, stock, 0 AS status, 0 AS round FROM d
            UNION ALL SELECT o, ts, p, q, stock, CASE WHEN status <> 0 THEN status WHEN fails THEN -1 WHEN fits THEN 1 ELSE 0 END, round + 1
            FROM (SELECT *, bool_or(least_taken + q > stock) OVER (PARTITION BY o) AS fails, bool_and(most_taken + q <= stock) OVER (PARTITION BY o) AS fits
                  FROM (SELECT *, COALESCE(SUM(CASE WHEN status = 1 THEN q ELSE 0 END) OVER before, 0) AS least_taken,
                               COALESCE(SUM(CASE WHEN status >= 0 THEN q ELSE 0 END) OVER before, 0) AS most_taken, bool_or(status = 0) OVER () AS any_open
                        FROM r WINDOW before AS (PARTITION BY p ORDER BY ts, o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE any_open)),
          v AS (SELECT o, MIN(status) AS status FROM r WHERE round = (SELECT MAX(round) FROM r) GROUP BY 1)
       SELECT o AS order_id, status = 1 AS accepted, round(total, 2) AS total FROM v
         JOIN (SELECT l_orderkey, SUM(l_quantity * p_retailprice) AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) ON l_orderkey = o""",
)
def order_admission(t: Tables):
    """Orders in date order against limited stock, all lines or none, with the total of quantity x price of each."""
    lines = t.lineitem.join(t.orders, col("l_orderkey") == col("o_orderkey")).select(
        col("o_orderkey").alias("order_id"), col("o_orderdate").alias("arrival"), col("l_partkey").alias("product_id"),
        big(col("l_quantity")).alias("quantity"),
    )
    lines = cut_lineage(lines, "admission-lines")
    stock = t.part.select(col("p_partkey").alias("product_id"), big(col("p_size") * 30).alias("stock"))
    price = t.part.select(col("p_partkey").alias("product_id"), "p_retailprice")
    totals = lines.join(price, "product_id").groupBy("order_id").agg(F.round(F.sum(col("quantity") * col("p_retailprice")), 2).alias("total"))
    return admit_orders(lines, stock).join(totals, "order_id")


@query(
    "reconcile_counter_drift",
    """WITH a AS (SELECT l_partkey AS k, COUNT(*) AS truth FROM lineitem GROUP BY 1), b AS (SELECT l_partkey AS k, COUNT(*) AS counter FROM lineitem WHERE l_discount < 0.1 GROUP BY 1)
       SELECT k AS part_key, truth, COALESCE(counter, 0) AS counter, truth - COALESCE(counter, 0) AS drift FROM a LEFT JOIN b USING (k) WHERE truth <> COALESCE(counter, 0)""",
)
def reconcile_counter_drift(t: Tables):
    """A counter that missed the lines of one discount, against the table of record."""
    truth = t.lineitem.groupBy("l_partkey").agg(rows().alias("truth"))
    counter = t.lineitem.filter("l_discount < 0.1").groupBy(col("l_partkey").alias("k")).agg(rows().alias("c"))
    both = truth.join(counter, col("l_partkey") == col("k"), "full")
    a, b = F.coalesce("truth", lit(0)), F.coalesce("c", lit(0))
    return both.select(F.coalesce("l_partkey", "k").alias("part_key"), a.alias("truth"), b.alias("counter"), (a - b).alias("drift")).filter("drift <> 0")


@query(
    "rate_limit_fixed_window",
    """SELECT event_id, user_id, ROW_NUMBER() OVER (PARTITION BY user_id, epoch_ms(ts) // 86400000 ORDER BY ts, event_id) > 3 AS blocked FROM events""",
)
def rate_limit_fixed_window(t: Tables, limit: int = 3, window: int = 86400):
    """Requests beyond the limit within a fixed window are blocked (typically 5 per 60 s)."""
    bucket = F.floor(F.unix_timestamp(col("ts").cast("timestamp")) / window)
    calls = t.events.select("event_id", "user_id", "ts", bucket.alias("bucket"))
    counted = with_row_number(calls, ["user_id", "bucket"], [("ts", "asc"), ("event_id", "asc")], "n")
    return counted.select("event_id", "user_id", (col("n") > limit).alias("blocked"))


@query(
    "session_expiry",
    """SELECT user_id, MAX(ts) AS last_seen FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00' GROUP BY 1
       HAVING MAX(ts) + INTERVAL 3600 SECOND > TIMESTAMP '2024-01-20 12:00:00'""",
)
def session_expiry(t: Tables, now: str = "2024-01-20 12:00:00"):
    """Sessions touched within the last hour before a given time."""
    at = lit(now).cast("timestamp_ntz")
    last = t.events.filter(col("ts") <= at).groupBy("user_id").agg(F.max("ts").alias("last_seen"))
    return last.filter(col("last_seen") + F.expr("INTERVAL 1 HOUR") > at)


@query(
    "event_log_range",
    "SELECT strftime(ts, '%Y%m%d%H%M%S') || '-' || event_id AS msg_id, event_type FROM events ORDER BY ts, event_id",
)
def event_log_range(t: Tables):
    """The log from its first to its last id, in order."""
    ident = F.concat(F.date_format("ts", "yyyyMMddHHmmss"), lit("-"), col("event_id").cast("string"))
    return t.events.orderBy("ts", "event_id").select(ident.alias("msg_id"), "event_type")


@query(
    "feature_flag_table",
    """SELECT c_custkey, c_acctbal > 0 AS plan_ok, ('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 20 AS in_rollout FROM customer""",
)
def feature_flag_table(t: Tables, rollout_pct: int = 20):
    """A flag is the text 'true'; the rollout share is a stable hash bucket."""
    flag = when(col("c_acctbal") > 0, "true").otherwise("false")
    return t.customer.select(
        "c_custkey", (flag == "true").alias("plan_ok"),
        (md5_bucket(col("c_custkey").cast("string"), 100) < rollout_pct).alias("in_rollout"),
    )


@query(
    "kv_export",
    """SELECT 'product:' || p_partkey AS key, '{"name":"' || p_name || '","category":"' || p_brand || '","stock":' || p_size || '}' AS value FROM part""",
)
def kv_export(t: Tables):
    value = F.to_json(F.struct(col("p_name").alias("name"), col("p_brand").alias("category"), col("p_size").alias("stock")))
    return t.part.select(F.concat(lit("product:"), col("p_partkey").cast("string")).alias("key"), value.alias("value"))


NODES = ("node-a", "node-b", "node-c")


def ring_sql(nodes, name):
    listed = ", ".join(f"'{n}'" for n in nodes)
    return f"""{name}_ring AS MATERIALIZED (SELECT md5(n || ':' || i) AS p, n FROM unnest([{listed}]) a(n), range(150) b(i)),
      {name} AS (SELECT k, COALESCE(arg_min(n, p), (SELECT arg_min(n, p) FROM {name}_ring)) AS node FROM keys LEFT JOIN {name}_ring ON p > h GROUP BY k)"""


@query(
    "consistent_hash_assign",
    f"""WITH keys AS (SELECT 'user:' || c_custkey AS k, md5('user:' || c_custkey) AS h FROM customer), {ring_sql(NODES, 'a')}, {ring_sql((*NODES, 'node-d'), 'b')}
        SELECT k AS key, a.node AS node, b.node AS node_after, a.node <> b.node AS moved FROM a JOIN b USING (k)""",
)
def consistent_hash_assign(t: Tables):
    """Owner of each key on a ring of three nodes, and after a fourth joins."""
    key = F.concat(lit("user:"), col("c_custkey").cast("string"))
    placed = with_ring_node(t.customer.select(key.alias("key")), "key", NODES, "node")
    placed = with_ring_node(placed, "key", (*NODES, "node-d"), "node_after")
    return placed.withColumn("moved", col("node") != col("node_after"))


SLOT_OWNERS = (("A", 0, 5460), ("B", 5461, 10922), ("C", 10923, 16383))  # fixed slot ranges


@query(
    "hash_slot_assign",
    """WITH k AS (SELECT o_orderkey, '{user:' || o_custkey || '}.order.' || o_orderkey AS key, 'user:' || o_custkey AS tag FROM orders),
            s AS (SELECT key, ('0x' || substr(md5(tag), 1, 8))::BIGINT % 16384 AS slot FROM k)
       SELECT key, slot, CASE WHEN slot <= 5460 THEN 'A' WHEN slot <= 10922 THEN 'B' ELSE 'C' END AS node FROM s""",
)
def hash_slot_assign(t: Tables):
    """All keys with one tag share a slot."""
    key = F.concat(lit("{user:"), col("o_custkey").cast("string"), lit("}.order."), col("o_orderkey").cast("string"))
    slots = t.orders.select(key.alias("key"), hash_slot(key).alias("slot"))
    node = F.coalesce(*[when(col("slot").between(lo, hi), name) for name, lo, hi in SLOT_OWNERS])
    return slots.withColumn("node", node)


@query(
    "lsm_compaction",
    """SELECT user_id AS key, arg_max(value, event_id) AS value FROM events GROUP BY 1 HAVING arg_max(event_type, event_id) <> 'signup'""",
)
def lsm_compaction(t: Tables):
    """Four sorted runs merged: the newest value of a key wins and a tombstone removes it."""
    run = lambda i: t.events.filter(col("event_id") % 4 == i).select(
        col("user_id").alias("key"), col("event_id").alias("seq"), when(col("event_type") != "signup", col("value")).alias("value")
    )
    runs = run(0).unionByName(run(1)).unionByName(run(2)).unionByName(run(3))
    return latest_per_key(runs, ["key"], ["seq"]).filter("value IS NOT NULL").select("key", "value")


@query(
    "quorum_read_repair",
    """WITH r AS (SELECT user_id AS key, event_id % 3 AS replica, MAX(event_id) AS version, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2),
            n AS (SELECT key, MAX(version) AS newest, arg_max(value, version) AS value FROM r GROUP BY 1)
       SELECT r.key, r.replica, r.version, n.newest, n.value AS repaired_value FROM r JOIN n USING (key) WHERE r.version < n.newest""",
)
def quorum_read_repair(t: Tables):
    """Replicas that lag behind the newest version, with the value to write back."""
    replicas = t.events.groupBy(col("user_id").alias("key"), (col("event_id") % 3).alias("replica")).agg(
        F.max("event_id").alias("version"), F.max_by("value", "event_id").alias("value")
    )
    stats = with_group_stats(replicas, ["key"], newest=F.max("version"), repaired_value=F.max_by("value", "version"))
    return stats.filter("version < newest").drop("value")


def daily_sketches(t: Tables):
    """The state of each day and event type; the middle days come in a second load, and one day is loaded again."""
    kept = sketches.DailySketches(t.spark, shared_path(t.spark, "sketches"), "event_type STRING")
    middle = F.day("ts").between(11, 20)
    for part in (~middle, middle, F.day("ts") == 15):
        kept.load(t.events.filter(part), day("ts"), "user_id", "value")
    return kept


@query("approx_distinct", "SELECT event_type, COUNT(DISTINCT user_id) AS distinct_users FROM events GROUP BY 1")
def approx_distinct(t: Tables):
    """Users of each event type from the kept sketches alone; equal to the exact count while users are few."""
    return daily_sketches(t).distinct("event_type").select("event_type", col("distinct_values").alias("distinct_users"))


@query("hll_merge_days", "SELECT COUNT(DISTINCT user_id) AS distinct_users, COUNT(DISTINCT CAST(ts AS DATE)) AS days FROM events")
def hll_merge_days(t: Tables):
    """Users of the whole span from the union of the sketches of all days and types."""
    return daily_sketches(t).distinct().select(col("distinct_values").alias("distinct_users"), "days")


@query(
    "bloom_membership",
    """SELECT COUNT(*) AS customers, COUNT(CASE WHEN is_member THEN 1 END) AS members, true AS no_false_negative, true AS few_false_positives
       FROM (SELECT c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000) AS is_member FROM customer)""",
)
def bloom_membership(t: Tables):
    """A fixed-size filter of big spenders' keys, probed with all customers."""
    keys = t.orders.filter("o_totalprice > 450000").select(col("o_custkey").alias("k"))
    bloom = sketches.bloom_array(keys, "k", bits=1 << 20).scalar()
    truth = keys.distinct().withColumn("is_member", lit(True))
    probe = t.customer.join(truth, col("c_custkey") == col("k"), "left").withColumn("bloom", bloom)
    probe = probe.select(
        F.coalesce("is_member", lit(False)).alias("truth"),
        sketches.bloom_might_contain(col("bloom"), col("c_custkey"), bits=1 << 20).alias("maybe"),
    )
    return probe.agg(
        rows().alias("customers"), F.count_if("truth").alias("members"),
        (F.count_if(col("truth") & ~col("maybe")) == 0).alias("no_false_negative"),
        (F.count_if(~col("truth") & col("maybe")) <= 0.02 * rows()).alias("few_false_positives"),
    )


@query(
    "count_min_sketch",
    "SELECT l_partkey AS part_key, COUNT(*) AS exact, true AS never_under, true AS close FROM lineitem GROUP BY 1",
)
def count_min_sketch(t: Tables, width: int = 1 << 14, depth: int = 5):
    """Estimates never fall below the exact count and rarely exceed it by more than 0.1 percent of all rows."""
    cells = sketches.count_min_cells(t.lineitem, "l_partkey", width, depth)
    exact = t.lineitem.groupBy("l_partkey").agg(rows().alias("exact"))
    estimates = sketches.count_min_estimates(exact.select("l_partkey"), "l_partkey", cells, width, depth)
    total = t.lineitem.agg(rows()).scalar()
    both = exact.join(estimates, "l_partkey")
    return both.select(
        col("l_partkey").alias("part_key"), "exact", (col("estimate") >= col("exact")).alias("never_under"),
        (col("estimate") - col("exact") <= 0.001 * total).alias("close"),
    )


@query(
    "approx_percentile",
    "SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY 1",
)
def approx_percentile(t: Tables):
    """Percentiles of each event type from the kept sketches alone."""
    return daily_sketches(t).quantiles(["event_type"], {"p50": 0.5, "p99": 0.99})
