"""Graph queries.

Accounts are customers; order k is a transfer from its customer to the customer
of order k + 1. Its status is the edge type, urgent orders are the critical edges.
"""

from sparkwell.functions.hashing import md5_bucket
from sparkwell.operators import graph
from sparkwell.operators.ordered import top_per_group
from sparkwell.session import cut_lineage
from sparkwell.plans.common import F, Tables, col, lit, query, rows

EDGES_SQL = """edges AS MATERIALIZED (SELECT a.o_orderkey AS id, a.o_custkey AS src, b.o_custkey AS dst, a.o_orderstatus AS type, a.o_totalprice AS amount,
    a.o_orderpriority = '1-URGENT' AS critical FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1 WHERE a.o_custkey <> b.o_custkey)"""
SEEDS_SQL = """seeds AS (SELECT o_custkey AS node, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, o_custkey) AS rn FROM orders GROUP BY 1)"""


def transfers(t: Tables):
    a = t.orders
    b = t.orders.select((col("o_orderkey") - 1).alias("prev"), col("o_custkey").alias("dst"))
    return a.join(b, col("o_orderkey") == col("prev")).filter("o_custkey <> dst").select(
        col("o_orderkey").alias("id"), col("o_custkey").alias("src"), "dst", col("o_orderstatus").alias("type"),
        col("o_totalprice").alias("amount"), (col("o_orderpriority") == "1-URGENT").alias("critical"),
    )


def accounts(t: Tables):
    return t.customer.select(col("c_custkey").alias("node"))


def busiest(t: Tables, places: int, skip: int = 0):
    """The accounts with most orders: a few rows, found on the whole table."""
    counts = t.orders.groupBy(col("o_custkey").alias("node")).agg(rows().alias("n"))
    top = counts.orderBy(col("n").desc(), "node")
    return top.offset(skip).limit(places).select("node")


@query(
    "graph_build_copurchase",
    """WITH m AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
       SELECT a.l_partkey AS a, b.l_partkey AS b, COUNT(*) AS weight FROM m a JOIN m b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey GROUP BY 1, 2""",
)
def graph_build_copurchase(t: Tables):
    return graph.copurchase_edges(t.lineitem, "l_orderkey", "l_partkey")


@query(
    "recommend_products",
    """WITH m AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
         w AS (SELECT a.l_partkey AS seed, b.l_partkey AS item, COUNT(*) AS weight FROM m a JOIN m b ON a.l_orderkey = b.l_orderkey AND b.l_partkey <> a.l_partkey GROUP BY 1, 2)
       SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY seed ORDER BY weight DESC, item) AS place FROM w) WHERE place <= 5""",
)
def recommend_products(t: Tables, limit: int = 5):
    """Top items bought together with each item, from the pair weights in both directions."""
    pairs = cut_lineage(graph.copurchase_edges(t.lineitem, "l_orderkey", "l_partkey"), "pairs")
    near = pairs.select(col("a").alias("seed"), col("b").alias("item"), "weight")
    near = near.unionByName(pairs.select(col("b").alias("seed"), col("a").alias("item"), "weight"))
    return top_per_group(near, ["seed"], [("weight", "desc"), ("item", "asc")], limit, "place")


@query(
    "recommend_two_hop",
    """WITH m AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS i FROM lineitem),
         s AS (SELECT l_partkey AS seed FROM lineitem GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1),
         d AS (SELECT DISTINCT b.i FROM s JOIN m a ON a.i = seed JOIN m b ON a.o = b.o WHERE b.i <> seed),
         o2 AS (SELECT DISTINCT o FROM m JOIN d USING (i))
       SELECT i AS item, COUNT(*) AS orders FROM m JOIN o2 USING (o) WHERE i NOT IN (SELECT i FROM d) AND i <> (SELECT seed FROM s) GROUP BY 1""",
)
def recommend_two_hop(t: Tables):
    """Items bought with what was bought with the overall best seller; by shared orders."""
    member = t.lineitem.select(col("l_orderkey").alias("o"), col("l_partkey").alias("i")).distinct()
    sold = t.lineitem.groupBy(col("l_partkey").alias("seed")).agg(rows().alias("n"))
    seed = sold.orderBy(col("n").desc(), "seed").limit(1).select("seed")
    direct = graph.bought_together(t.lineitem, "l_orderkey", "l_partkey", seed).select(col("item").alias("i"))
    orders = member.join(direct, "i", "left_semi").select("o").distinct()
    second = member.join(orders, "o", "left_semi").join(direct, "i", "left_anti")
    second = second.join(seed, col("i") == col("seed"), "left_anti")
    return second.groupBy(col("i").alias("item")).agg(rows().alias("orders"))


@query(
    "graph_one_hop",
    f"""WITH {EDGES_SQL}, {SEEDS_SQL}, s AS (SELECT node FROM seeds WHERE rn = 1)
        SELECT 'out' AS direction, type, dst AS neighbour FROM edges JOIN s ON src = node
        UNION ALL SELECT 'in', type, src FROM edges JOIN s ON dst = node""",
)
def graph_one_hop(t: Tables):
    seed = F.broadcast(busiest(t, 1))
    edges = transfers(t)
    out = edges.join(seed, col("src") == col("node")).select(lit("out").alias("direction"), "type", col("dst").alias("neighbour"))
    back = edges.join(seed, col("dst") == col("node")).select(lit("in").alias("direction"), "type", col("src").alias("neighbour"))
    return out.unionByName(back)


def reach_sql(where, hops):
    return f"""WITH RECURSIVE {EDGES_SQL}, {SEEDS_SQL},
      r AS (SELECT DISTINCT dst AS node, 1 AS h FROM edges JOIN seeds ON src = node AND rn = 1 WHERE {where}
            UNION SELECT e.dst, h + 1 FROM r JOIN edges e ON e.src = r.node WHERE h < {hops} AND {where})
      SELECT node, CAST(MIN(h) AS BIGINT) AS hops FROM r GROUP BY 1"""


@query("graph_khop_reach", reach_sql("type = 'F'", 3))
def graph_khop_reach(t: Tables):
    starts = busiest(t, 1).select(lit(0).alias("start"), "node")
    return graph.k_hop(transfers(t).filter("type = 'F'"), starts, 3).select("node", "hops")


@query("graph_filtered_reach", reach_sql("critical", 4))
def graph_filtered_reach(t: Tables):
    """Every edge of the path is critical: filter the edges, then walk."""
    starts = busiest(t, 1).select(lit(0).alias("start"), "node")
    return graph.k_hop(transfers(t).filter("critical"), starts, 4).select("node", "hops")


def gateways(t: Tables):
    """Accounts of nation 0 are the gateways; their segment is the app."""
    return t.customer.filter("c_nationkey = 0").select(col("c_mktsegment").alias("start"), col("c_custkey").alias("node"))


@query(
    "graph_blast_radius",
    f"""WITH RECURSIVE {EDGES_SQL}, e AS (SELECT DISTINCT src, dst FROM edges WHERE critical),
         one AS (SELECT DISTINCT c_mktsegment AS app, dst AS node FROM e JOIN customer ON src = c_custkey WHERE c_nationkey = 0),
         r AS (SELECT app, dst AS node FROM one JOIN e ON src = node UNION SELECT app, dst FROM r JOIN e ON src = node)
        SELECT node AS dependency, COUNT(*) AS apps_at_risk, string_agg(app, ',' ORDER BY app) AS apps FROM r GROUP BY 1""",
)
def graph_blast_radius(t: Tables):
    """Apps whose gateways reach an account over two or more critical edges."""
    reach = graph.reach_in_two_or_more(transfers(t).filter("critical"), gateways(t))
    return reach.groupBy(col("node").alias("dependency")).agg(
        rows().alias("apps_at_risk"), F.array_join(F.array_sort(F.collect_set("start")), ",").alias("apps")
    )


@query(
    "graph_diamond",
    f"""WITH RECURSIVE {EDGES_SQL}, e AS (SELECT DISTINCT src, dst FROM edges WHERE critical),
         r AS (SELECT DISTINCT c_mktsegment AS app, dst AS node, 1 AS h FROM e JOIN customer ON src = c_custkey WHERE c_mktsegment <> 'FURNITURE'
               UNION SELECT app, dst, h + 1 FROM r JOIN e ON src = node WHERE h < 3), d AS (SELECT DISTINCT app, node FROM r)
        SELECT a.app AS app_a, b.app AS app_b, a.node AS shared_dep FROM d a JOIN d b ON a.node = b.node AND a.app < b.app""",
)
def graph_diamond(t: Tables):
    """App pairs with a common dependency within three critical edges; there are five apps."""
    edges = transfers(t).filter("critical")
    starts = t.customer.filter("c_mktsegment <> 'FURNITURE'").select(
        col("c_mktsegment").alias("start"), col("c_custkey").alias("node")
    )
    apps = graph.k_hop(edges, starts, 3).groupBy("node").agg(F.collect_set("start").alias("apps"))
    first = apps.select("node", "apps", F.explode("apps").alias("app_a"))
    pairs = first.select(col("node").alias("shared_dep"), "app_a", F.explode("apps").alias("app_b"))
    return pairs.filter("app_a < app_b")


def paths_sql(edges, hops):
    return f"""p AS (SELECT [s.node, e.dst] AS nodes, [e.id] AS ids, 1.0::DOUBLE / e.cost AS c, 1 AS hops, e.dst AS here FROM {edges} e JOIN src_nodes s ON e.src = s.node
       UNION ALL SELECT list_append(nodes, e.dst), list_append(ids, e.id), c + 1.0::DOUBLE / e.cost, hops + 1, e.dst FROM p JOIN {edges} e ON e.src = p.here
         WHERE hops < {hops} AND NOT list_contains(ids, e.id))"""


@query(
    "graph_all_paths_cost",
    f"""WITH RECURSIVE {EDGES_SQL}, {SEEDS_SQL}, src_nodes AS (SELECT node FROM seeds WHERE rn = 1),
          w AS MATERIALIZED (SELECT id, src, dst, id % 10 + 1 AS cost FROM edges), {paths_sql('w', 4)}
        SELECT array_to_string(nodes, '>') AS route, array_to_string(ids, '>') AS ties, CAST(hops AS BIGINT) AS hops, round(c, 3) AS coldness FROM p
        WHERE here NOT IN (SELECT node FROM src_nodes)""",
)
def graph_all_paths_cost(t: Tables, hops: int = 4):
    """Paths of up to four ties from the busiest account to every other; a tie costs 1 / familiarity, and parallel ties are paths of their own.

    The result has one row per path, so its size is the number of paths.
    """
    ties = transfers(t).select("id", "src", "dst", (1.0 / (col("id") % 10 + 1)).alias("cost"))
    source = cut_lineage(busiest(t, 1))
    others = accounts(t).join(source, "node", "left_anti")
    found = graph.paths_between(ties, source, others, hops)
    cost = F.aggregate("costs", lit(0.0), lambda a, x: a + x)
    return found.select(F.array_join("nodes", ">").alias("route"), F.array_join(col("ids").cast("array<string>"), ">").alias("ties"), "hops", F.round(cost, 3).alias("coldness"))


@query(
    "graph_shortest_path",
    f"""WITH RECURSIVE {EDGES_SQL}, {SEEDS_SQL}, e AS MATERIALIZED (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
          r AS (SELECT node, 0 AS h FROM seeds WHERE rn = 1 UNION SELECT e.dst, h + 1 FROM r JOIN e ON e.src = r.node WHERE h < 8),
          d AS MATERIALIZED (SELECT node, MIN(h) AS h FROM r GROUP BY 1),
          b AS (SELECT node, h, CAST(node AS VARCHAR) AS path FROM d WHERE node = (SELECT node FROM seeds WHERE rn = 2)
                UNION ALL SELECT x.node, x.h, x.node || '>' || path FROM (SELECT b.path, MIN(d.node) AS node, MIN(d.h) AS h FROM b JOIN e ON e.dst = b.node
                  JOIN d ON d.node = e.src AND d.h = b.h - 1 GROUP BY b.path) x)
        SELECT path, CAST((SELECT h FROM d WHERE node = (SELECT node FROM seeds WHERE rn = 2)) AS BIGINT) AS hops FROM b WHERE h = 0""",
)
def graph_shortest_path(t: Tables):
    """Fewest hops between the two busiest accounts, direction ignored."""
    found = graph.shortest_path(transfers(t), busiest(t, 1), busiest(t, 1, skip=1))
    return found.select(F.array_join("path", ">").alias("path"), "hops")


def distance_sql(rounds):
    steps = "".join(
        f""", d{i} AS MATERIALIZED (SELECT node, MIN(dist) AS dist FROM (SELECT * FROM d{i - 1} UNION ALL
             SELECT w.dst, dist + w.weight FROM d{i - 1} JOIN w ON w.src = node) GROUP BY 1)""" for i in range(1, rounds + 1)
    )
    return f"""WITH {EDGES_SQL}, {SEEDS_SQL}, w AS MATERIALIZED (SELECT src, dst, MIN(id % 10 + 1) AS weight FROM edges GROUP BY 1, 2),
      d0 AS (SELECT node, CAST(0 AS BIGINT) AS dist FROM seeds WHERE rn = 1){steps} SELECT * FROM d{rounds}"""


@query("graph_weighted_shortest", distance_sql(30))
def graph_weighted_shortest(t: Tables):
    """Least total weight from the busiest account."""
    edges = transfers(t).select("src", "dst", (col("id") % 10 + 1).alias("weight"))
    return graph.weighted_distances(edges, busiest(t, 1))


@query(
    "graph_attack_paths",
    """WITH h AS (SELECT DISTINCT l_suppkey AS s, o_custkey AS c FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
       SELECT r_name || ' > ' || n_name || ' > ' || c_name AS attack_path, CAST(2 AS BIGINT) AS steps FROM region JOIN nation ON n_regionkey = r_regionkey
         JOIN customer ON c_nationkey = n_nationkey WHERE r_regionkey = 0 AND c_acctbal > 9000
       UNION ALL SELECT r_name || ' > ' || n_name || ' > ' || s_name || ' > ' || c_name, 3 FROM region JOIN nation ON n_regionkey = r_regionkey
         JOIN supplier ON s_nationkey = n_nationkey JOIN h ON s = s_suppkey JOIN customer ON c_custkey = c WHERE r_regionkey = 0 AND c_acctbal > 9000""",
)
def graph_attack_paths(t: Tables):
    """From zone 0 over nations and suppliers to the sensitive hosts (rich accounts), any edge type."""
    held = t.lineitem.join(t.orders, col("l_orderkey") == col("o_orderkey"))

    def edge(df, src, dst):
        return df.select(src.alias("src"), dst.alias("dst")).distinct()

    edges = (
        edge(t.nation, F.concat(lit("r"), col("n_regionkey")), F.concat(lit("n"), col("n_nationkey")))
        .unionByName(edge(t.supplier, F.concat(lit("n"), col("s_nationkey")), F.concat(lit("s"), col("s_suppkey"))))
        .unionByName(edge(t.customer, F.concat(lit("n"), col("c_nationkey")), F.concat(lit("c"), col("c_custkey"))))
        .unionByName(edge(held, F.concat(lit("s"), col("l_suppkey")), F.concat(lit("c"), col("o_custkey"))))
    )
    edges = edges.select("src", "dst", F.xxhash64("src", "dst").alias("id"), lit(1.0).alias("cost"))
    zone = t.region.filter("r_regionkey = 0").select(F.concat(lit("r"), col("r_regionkey")).alias("node"))
    rich = t.customer.filter("c_acctbal > 9000").select(F.concat(lit("c"), col("c_custkey")).alias("node"))
    found = graph.paths_between(edges, zone, rich, 4)
    names = (
        t.region.select(F.concat(lit("r"), col("r_regionkey")).alias("k"), col("r_name").alias("name"))
        .unionByName(t.nation.select(F.concat(lit("n"), col("n_nationkey")).alias("k"), col("n_name").alias("name")))
        .unionByName(t.supplier.select(F.concat(lit("s"), col("s_suppkey")).alias("k"), col("s_name").alias("name")))
        .unionByName(t.customer.select(F.concat(lit("c"), col("c_custkey")).alias("k"), col("c_name").alias("name")))
    )
    spread = found.select(F.array_join("nodes", ">").alias("key"), "hops", F.posexplode("nodes").alias("pos", "k"))
    named = spread.join(names, "k").groupBy("key", "hops").agg(
        F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("steps")  # at most five nodes per path
    )
    text = F.array_join(F.transform("steps", lambda x: x["name"]), " > ")
    return named.select(text.alias("attack_path"), col("hops").alias("steps"))


@query(
    "graph_degree",
    f"""WITH {EDGES_SQL}, e AS (SELECT src AS node, 1 AS o, 0 AS i FROM edges UNION ALL SELECT dst, 0, 1 FROM edges)
        SELECT c_custkey AS node, CAST(COALESCE(SUM(o), 0) AS BIGINT) AS outgoing, CAST(COALESCE(SUM(i), 0) AS BIGINT) AS incoming, COUNT(o) AS total
        FROM customer LEFT JOIN e ON node = c_custkey GROUP BY 1""",
)
def graph_degree(t: Tables):
    return graph.degrees(accounts(t), transfers(t))


def pagerank_sql(rounds):
    steps = "".join(
        f""", r{i} AS MATERIALIZED (SELECT c_custkey AS node, 0.15 / (SELECT COUNT(*) FROM customer) + 0.85 * COALESCE(got, 0) AS rank FROM customer
             LEFT JOIN (SELECT dst, SUM(rank / n) AS got FROM edges JOIN o USING (src) JOIN r{i - 1} ON node = edges.src GROUP BY 1) ON dst = c_custkey)"""
        for i in range(1, rounds + 1)
    )
    return f"""WITH {EDGES_SQL}, o AS (SELECT src, COUNT(*) AS n FROM edges GROUP BY 1),
      r0 AS (SELECT c_custkey AS node, 1.0::DOUBLE / (SELECT COUNT(*) FROM customer) AS rank FROM customer){steps}
      SELECT node, round(rank, 9) AS rank FROM r{rounds}"""


@query("graph_pagerank", pagerank_sql(10))
def graph_pagerank(t: Tables):
    return graph.pagerank(accounts(t), transfers(t), 10).select("node", F.round("rank", 9).alias("rank"))


def components_sql(rounds):
    """Least label of the neighbourhood, as many rounds as no component is wide; a wider one would leave two labels side by side."""
    steps = "".join(
        f""", l{i} AS MATERIALIZED (SELECT node, MIN(label) AS label FROM (SELECT * FROM l{i - 1} UNION ALL SELECT e.dst, label FROM l{i - 1} JOIN e ON e.src = node) GROUP BY 1)"""
        for i in range(1, rounds + 1)
    )
    return f"""WITH {EDGES_SQL}, e AS MATERIALIZED (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
      l0 AS (SELECT c_custkey AS node, c_custkey AS label FROM customer){steps}
      SELECT node, label AS component, COUNT(*) OVER (PARTITION BY label) AS size FROM l{rounds}"""


@query("graph_wcc", components_sql(20))
def graph_wcc(t: Tables):
    labels = graph.components(accounts(t), transfers(t))
    sizes = labels.groupBy("component").agg(rows().alias("size"))
    return labels.join(sizes, "component").select("node", "component", "size")


@query(
    "graph_triangle_cycle",
    f"""WITH {EDGES_SQL}, e AS MATERIALIZED (SELECT DISTINCT src, dst FROM edges)
        SELECT x.src AS a, y.src AS b, z.src AS c FROM e x JOIN e y ON x.dst = y.src JOIN e z ON y.dst = z.src AND z.dst = x.src
        WHERE x.src < y.src AND x.src < z.src""",
)
def graph_triangle_cycle(t: Tables):
    return graph.directed_triangles(transfers(t))


def propagation_sql(rounds):
    steps = "".join(
        f""", l{i} AS MATERIALIZED (SELECT c_custkey AS node, COALESCE(new, old.label) AS label FROM customer JOIN l{i - 1} old ON old.node = c_custkey
             LEFT JOIN (SELECT dst, arg_max(label, votes * 1000000000 - label) AS new FROM (SELECT dst, label, COUNT(*) AS votes FROM e JOIN l{i - 1} ON node = src GROUP BY 1, 2)
             GROUP BY 1) ON dst = c_custkey)""" for i in range(1, rounds + 1)
    )
    return f"""WITH {EDGES_SQL}, e AS MATERIALIZED (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
      l0 AS (SELECT c_custkey AS node, c_custkey AS label FROM customer){steps} SELECT * FROM l{rounds}"""


@query("graph_label_propagation", propagation_sql(5))
def graph_label_propagation(t: Tables):
    return graph.label_propagation(accounts(t), transfers(t), 5)


@query(
    "graph_supernode_report",
    f"""WITH {EDGES_SQL}, d AS (SELECT node, COUNT(*) AS total FROM (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges) GROUP BY 1)
        SELECT node, total FROM d WHERE total > 1.6 * (SELECT AVG(total) FROM d)""",
)
def graph_supernode_report(t: Tables, factor: float = 1.6):
    """Accounts whose degree is far above the mean degree."""
    edges = transfers(t)
    ends = edges.select(col("src").alias("node")).unionByName(edges.select(col("dst").alias("node")))
    degree = ends.groupBy("node").agg(rows().alias("total"))
    return degree.filter(col("total") > factor * degree.agg(F.avg("total")).scalar())


BUCKET_SQL = "('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 8))::BIGINT % 4"


@query(
    "graph_partition_cut",
    f"""WITH {EDGES_SQL} SELECT {BUCKET_SQL.format('src')} AS src_part, {BUCKET_SQL.format('dst')} AS dst_part, COUNT(*) AS edges,
          {BUCKET_SQL.format('src')} <> {BUCKET_SQL.format('dst')} AS is_cut FROM edges GROUP BY 1, 2, 4""",
)
def graph_partition_cut(t: Tables):
    """Edges within and across the four parts of a hash placement."""
    a, b = md5_bucket(col("src").cast("string"), 4), md5_bucket(col("dst").cast("string"), 4)
    counts = transfers(t).groupBy(a.alias("src_part"), b.alias("dst_part")).agg(rows().alias("edges"))
    return counts.withColumn("is_cut", col("src_part") != col("dst_part"))
