"""Graph jobs over a nodes table and an edges table.

Frontiers, ranks and labels hold one row per node (or per start and node), so
each round is an equi-join of the edges with a table of unique keys: adaptive
execution splits a hot node's edges, and sums over neighbours combine map-side.
Loop state is written to the shared folder every round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwell.operators.joins import checked_broadcast
from sparkwell.session import cut_lineage


def both_ways(edges: DataFrame) -> DataFrame:
    """Undirected view: every edge in both directions, once."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.select("src", "dst").unionByName(back).distinct()


def k_hop(edges: DataFrame, starts: DataFrame, hops: int | None) -> DataFrame:
    """(start, node, hops): nodes reached from (start, node) rows, with the fewest hops.

    A start is part of its own reach only when a cycle leads back to it.
    ``hops=None`` runs until nothing new is found.
    """
    links = cut_lineage(edges.select("src", "dst").distinct())
    frontier = starts.select("start", F.col("node").alias("src")).distinct()
    seen = None
    depth = 0
    while hops is None or depth < hops:
        depth += 1
        reached = frontier.join(links, "src").select("start", F.col("dst").alias("node")).distinct()
        if seen is not None:
            reached = reached.join(seen, ["start", "node"], "left_anti")
        reached = cut_lineage(reached.withColumn("hops", F.lit(depth).cast("bigint")))
        seen = reached if seen is None else seen.unionByName(reached)
        if reached.isEmpty():
            break
        frontier = reached.select("start", F.col("node").alias("src"))
    return seen


def reach_in_two_or_more(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(start, node) reachable by at least two edges."""
    first = edges.join(starts.select("start", F.col("node").alias("src")), "src")
    first = cut_lineage(first.select("start", F.col("dst").alias("node")).distinct())
    return k_hop(edges, first, None).select("start", "node")


def paths_between(edges: DataFrame, sources: DataFrame, targets: DataFrame, max_hops: int) -> DataFrame:
    """All paths (nodes, edge ids, costs) of up to ``max_hops`` edges without a repeated edge.

    Distances to the targets are found first by walking backwards; the forward
    expansion then only enters nodes from which a target is still within reach.
    ``edges``: src, dst, id, cost. ``sources`` and ``targets``: node.
    """
    backwards = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    toward = k_hop(backwards, targets.select(F.lit(0).alias("start"), "node"), max_hops).groupBy("node").agg(F.min("hops").alias("left"))
    ends = targets.select("node", F.lit(0).cast("bigint").alias("left"))
    left = cut_lineage(toward.unionByName(ends).groupBy("node").agg(F.min("left").alias("left")))
    steps = edges.join(left, F.col("dst") == F.col("node")).drop("node")
    paths = sources.select(
        F.col("node").alias("at"), F.array("node").alias("nodes"),
        F.array().cast("array<bigint>").alias("ids"), F.array().cast("array<double>").alias("costs"),
    )
    found = None
    for depth in range(1, max_hops + 1):
        near = steps.filter(F.col("left") <= max_hops - depth)
        grown = paths.join(near, F.col("at") == F.col("src")).filter(~F.array_contains("ids", F.col("id")))
        paths = cut_lineage(
            grown.select(
                F.col("dst").alias("at"), F.array_append("nodes", F.col("dst")).alias("nodes"),
                F.array_append("ids", F.col("id")).alias("ids"),
                F.array_append("costs", F.col("cost").cast("double")).alias("costs"),
            )
        )
        arrived = paths.join(targets.select(F.col("node").alias("at")), "at", "left_semi")
        found = arrived if found is None else found.unionByName(arrived)
    return found.select("nodes", "ids", "costs", F.size("ids").cast("bigint").alias("hops"))


class _Side:
    """One end of a two-sided search: the nodes reached so far with their distance, a written table for each distance."""

    def __init__(self, start: DataFrame):
        self.layers = [cut_lineage(start.select("node"))]

    def grow(self, links: DataFrame) -> DataFrame:
        """The next layer: neighbours of the last one that are in none; of earlier ones only the last two can be neighbours."""
        near = links.join(self.layers[-1], F.col("src") == F.col("node"), "left_semi").select(F.col("dst").alias("node")).distinct()
        for layer in self.layers[-2:]:
            near = near.join(layer, "node", "left_anti")
        self.layers.append(cut_lineage(near))
        return self.layers[-1]


def shortest_path(edges: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """(path, hops) with the fewest hops, undirected; among equals the smallest previous node wins, from the target backwards.

    Both ends search at once, the one with the smaller frontier first, so two balls of half the radius are read instead of one of the
    whole. Where they meet, the nodes on shortest paths are marked towards the target, and the path is walked back, a row a step.
    """
    links = cut_lineage(both_ways(edges))
    ends = [_Side(source), _Side(target)]
    first = [side.layers[0].head() for side in ends]
    path_of = lambda nodes: edges.sparkSession.createDataFrame([(nodes, len(nodes) - 1)], T.StructType([T.StructField("path", T.ArrayType(links.schema["src"].dataType)), T.StructField("hops", T.LongType())]))
    if None in first:
        return path_of([]).limit(0)
    if first[0] == first[1]:
        return path_of([first[0]["node"]])
    sizes = [1, 1]
    while True:
        side = 0 if sizes[0] <= sizes[1] else 1
        fresh = ends[side].grow(links)
        sizes[side] = fresh.count()
        if not sizes[side]:
            return path_of([]).limit(0)
        met = fresh.join(ends[1 - side].layers[-1], "node", "left_semi")
        if not met.isEmpty():
            break
    near, far = ends[0].layers, ends[1].layers
    # of the target's layers, what lies on shortest paths: neighbours of the meeting nodes, and so on
    marked = {len(far) - 1: cut_lineage(met)}
    for depth in range(len(far) - 2, 0, -1):
        beyond = links.join(marked[depth + 1], F.col("src") == F.col("node"), "left_semi").select(F.col("dst").alias("node")).distinct()
        marked[depth] = cut_lineage(beyond.join(far[depth], "node", "left_semi"))
    steps = [marked[depth] for depth in range(1, len(far))] + near[-2::-1]
    path = [first[1]["node"]]
    for layer in steps:
        beside = links.filter(F.col("src") == path[-1]).select(F.col("dst").alias("node"))
        path.append(beside.join(layer, "node", "left_semi").agg(F.min("node")).head()[0])
    return path_of(path[::-1])


MAX_PARTS = 16


def weighted_distances(edges: DataFrame, source: DataFrame, width: float | None = None) -> DataFrame:
    """(node, dist): least total weight from the source, for weights of at least 0, by delta-stepping.

    Distances are settled in bands of ``width`` (the greatest weight, if not given). Within a band edges lighter than the width are followed until no
    node of the band improves; heavier ones lead beyond it and are followed once. A round writes the nodes that it
    improved and no others; the distance of a node is the least that was written.
    """
    links = cut_lineage(edges.groupBy("src", "dst").agg(F.min("weight").alias("weight")))
    most = links.agg(F.max("weight")).head()[0] or 1
    width = width or most
    light, heavy = links.filter(F.col("weight") <= width), links.filter(F.col("weight") > width)
    kind = links.schema["weight"].dataType
    written = [cut_lineage(source.select("node", F.lit(0).cast(kind).alias("dist")))]

    def known() -> DataFrame:
        return reduce(DataFrame.unionByName, written).groupBy("node").agg(F.min("dist").alias("dist"))

    def push(nodes: DataFrame, along: DataFrame) -> DataFrame | None:
        """Write the nodes that are better reached from ``nodes``."""
        offers = along.join(nodes, F.col("src") == F.col("node")).groupBy("dst").agg(F.min(F.col("dist") + F.col("weight")).cast(kind).alias("offer"))
        better = offers.join(known(), F.col("dst") == F.col("node"), "left").filter("dist IS NULL OR offer < dist")
        better = cut_lineage(better.select(F.col("dst").alias("node"), F.col("offer").alias("dist")))
        if better.isEmpty():
            return None
        written.append(better)
        if len(written) > MAX_PARTS:
            written[:] = [cut_lineage(known())]
        return better

    low = 0
    while low is not None:
        high = (low // width + 1) * width
        in_band = (F.col("dist") >= low) & (F.col("dist") < high)
        front = known().filter(in_band)
        while front is not None:
            better = push(front, light)
            front = None if better is None else better.filter(in_band)
            if front is not None and front.isEmpty():
                break
        if width < most:
            push(known().filter(in_band), heavy)
        low = known().filter(F.col("dist") >= high).agg(F.min("dist")).head()[0]
    return known()


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, outgoing, incoming, total); nodes without edges have zeros."""
    ends = edges.select(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(
        edges.select(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"))
    )
    counts = ends.groupBy("node").agg(F.sum("o").alias("outgoing"), F.sum("i").alias("incoming"))
    filled = nodes.select("node").join(counts, "node", "left").fillna(0, ["outgoing", "incoming"])
    return filled.withColumn("total", F.col("outgoing") + F.col("incoming"))


def pagerank(nodes: DataFrame, edges: DataFrame, rounds: int = 10, damping: float = 0.85) -> DataFrame:
    """Synchronous rounds of (1 - d) / N + d * sum(rank / out-degree); dangling rank is not spread."""
    n = nodes.count()
    out = edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))
    multi = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("times"))
    links = cut_lineage(multi.join(out, "src").select("src", "dst", (F.col("times") / F.col("out_degree")).alias("part")))
    ids = cut_lineage(nodes.select("node"))
    ranks = ids.withColumn("rank", F.lit(1.0 / n))
    for i in range(1, rounds + 1):
        sent = links.join(ranks, F.col("src") == F.col("node")).groupBy("dst").agg(
            F.sum(F.col("rank") * F.col("part")).alias("got")
        )
        new = F.lit((1 - damping) / n) + F.lit(damping) * F.coalesce("got", F.lit(0.0))
        ranks = ids.join(sent, F.col("node") == F.col("dst"), "left").select("node", new.alias("rank"))
        if i % 5 == 0 and i < rounds:
            ranks = cut_lineage(ranks)
    return ranks


#: Parts in which the links of one node are dealt out.
SALTS = 64


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest node of a neighbourhood: the larger ones (large star) or the smaller ones.

    The links of a node are dealt out by (node, salt), so that the centre of a star is no single task; a node
    has a row for each salt it has links in, and these are combined a second time.
    """
    sides = links if large else links.filter("v <= u")
    sides = sides.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    parts = sides.groupBy("u", "salt").agg(F.min("v").alias("low"))
    whole = parts.groupBy("u").agg(F.collect_list("salt").alias("salts"), F.least(F.min("low"), "u").alias("low"))
    pairs = sides.join(whole.select("u", "low", F.explode("salts").alias("salt")), ["u", "salt"])
    if large:
        return pairs.filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v")
    own = whole.select("u", F.col("low").alias("v"))
    return pairs.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(own).filter("u <> v").distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): smallest node id of each weakly connected component.

    Alternating large and small stars: every round re-links each neighbourhood to
    its smallest node, until every node hangs on the smallest of its component.
    The rounds grow with the logarithm of the size, not with the longest path.
    """

    def two_way(df):
        return df.unionByName(df.select(F.col("v").alias("u"), F.col("u").alias("v")))

    links = cut_lineage(edges.filter("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    before = None
    while True:
        links = cut_lineage(_star(two_way(_star(two_way(links), large=True)), large=False))
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    found = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low"))
    return nodes.select("node").join(found, "node", "left").select("node", F.coalesce("low", "node").alias("component"))


def directed_triangles(edges: DataFrame) -> DataFrame:
    """(a, b, c) with a -> b -> c -> a and a the smallest id.

    Wedges are built at the corner of least degree, where at most sqrt(2 m)
    neighbours have a higher one; a hub therefore never pairs up its neighbours.
    """
    links = edges.select("src", "dst").filter("src <> dst").distinct()
    ends = links.select(F.col("src").alias("n")).unionByName(links.select(F.col("dst").alias("n")))
    degree = ends.groupBy("n").agg(F.count(F.lit(1)).alias("d"))
    by_src = degree.select(F.col("n").alias("src"), F.struct("d", "n").alias("rank_src"))
    by_dst = degree.select(F.col("n").alias("dst"), F.struct("d", "n").alias("rank_dst"))
    ranked = cut_lineage(links.join(by_src, "src").join(by_dst, "dst"))
    into = ranked.filter("rank_src > rank_dst").select(F.col("src").alias("u"), F.col("dst").alias("v"))
    out = ranked.filter("rank_dst > rank_src").select(F.col("src").alias("v"), F.col("dst").alias("w"))
    closing = ranked.select(F.col("src").alias("w"), F.col("dst").alias("u"))
    found = into.join(out, "v").join(closing, ["w", "u"], "left_semi")
    low = F.least("u", "v", "w")
    second = F.when(low == F.col("u"), F.col("v")).when(low == F.col("v"), F.col("w")).otherwise(F.col("u"))
    third = F.when(low == F.col("u"), F.col("w")).when(low == F.col("v"), F.col("u")).otherwise(F.col("v"))
    return found.select(low.alias("a"), second.alias("b"), third.alias("c"))


def label_propagation(nodes: DataFrame, edges: DataFrame, rounds: int = 5) -> DataFrame:
    """Synchronous rounds: each node takes its neighbours' commonest label, the smallest on ties."""
    links = cut_lineage(both_ways(edges.filter("src <> dst")))
    labels = cut_lineage(nodes.select("node", F.col("node").alias("label")))
    for _ in range(rounds):
        votes = links.join(labels, F.col("src") == F.col("node")).groupBy("dst", "label").agg(F.count(F.lit(1)).alias("votes"))
        best = votes.groupBy("dst").agg(F.max_by("label", F.struct("votes", -F.col("label"))).alias("new"))
        moved = labels.join(best, F.col("node") == F.col("dst"), "left")
        labels = cut_lineage(moved.select("node", F.coalesce("new", "label").alias("label")))
    return labels


#: Rows of the incidence table that one task pairs up.
MEMBERS_PER_TASK = 500_000


def copurchase_edges(lines: DataFrame, order: str, item: str, block: int = 100) -> DataFrame:
    """(a, b, weight), a < b: how many orders hold both items, whatever the size of an order.

    The incidence table (order, item) is cut into blocks of about ``block`` items of one order, and blocks of an
    order meet in pairs, so a task gets two blocks at a time and never a whole large order. Each order that holds a pair adds
    one to it before the exchange on the pair.
    """
    member = cut_lineage(lines.select(F.col(order).alias("o"), F.col(item).alias("i")).filter("o IS NOT NULL AND i IS NOT NULL").distinct(), "incidence")
    large = member.groupBy("o").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).filter("blocks > 1")
    sized = member.join(large, "o", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    # small orders are one block; the two exchanges on the order are one
    sized = cut_lineage(sized.withColumn("k", F.pmod(F.xxhash64("i"), F.col("blocks")).cast("int")), "blocks")
    before = sized.select("o", F.col("i").alias("a"), F.col("k").alias("ka"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("kb"))
    after = sized.select("o", F.col("i").alias("b"), F.col("k").alias("kb"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("ka"))
    # by counted rows, not by the number of cores: what a task pairs up does not grow with the input
    tasks = max(int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sized.count() // MEMBERS_PER_TASK))
    before, after = (side.repartition(tasks, "o", "ka", "kb") for side in (before, after))
    return before.join(after, ["o", "ka", "kb"]).filter("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("weight"))


def bought_together(lines: DataFrame, order: str, item: str, seeds: DataFrame) -> DataFrame:
    """(seed, item, weight) for a short list of seeds: walk seed -> orders -> items, no pair table."""
    member = lines.select(F.col(order).alias("o"), F.col(item).alias("i")).distinct()
    baskets = member.join(checked_broadcast(seeds), F.col("i") == F.col("seed")).select("seed", "o")
    return member.join(baskets, "o").filter("i <> seed").groupBy("seed", F.col("i").alias("item")).agg(
        F.count(F.lit(1)).alias("weight")
    )
