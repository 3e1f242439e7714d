"""Pairs with a minimum overlap, without pairing up the members of popular groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwell.operators.ordered import top_per_group
from sparkwell.session import cut_lineage


#: Members of a group above which it may be set aside, members of a block of a group, and pairs of a member that one task counts.
HEAVY, BLOCK, PAIRS = 10_000, 1000, 1_000_000


def overlapping_pairs(membership: DataFrame, member: str, group: str, weight: str, at_least: int, heavy: int = HEAVY, block: int = BLOCK) -> DataFrame:
    """(a, b, shared, combined) for every pair a < b sharing at least ``at_least`` groups. Exact.

    ``membership``: one row per (member, group) with a weight. A member gets the others of its groups as lists, block by
    block of a group, and a pair is made and counted only in the task of its smaller member, so neither the pairs nor their
    counts are shuffled. A member of very many pairs is dealt over tasks by its partners.

    Two members that share k groups share at least one outside the k - 1 most popular groups of
    either. So each member sets up to k - 1 groups of more than ``heavy`` members aside, the largest first; a group is
    paired only where at least one side has it among its other groups, and the
    set-aside groups that both hold are added from two short arrays per member.
    A group that nearly everybody is in is set aside by nearly everybody.
    """
    base = membership.select(F.col(member).alias("m"), F.col(group).alias("g"), F.col(weight).cast("bigint").alias("w"))
    base = cut_lineage(base.filter("m IS NOT NULL AND g IS NOT NULL"), "members")
    size = base.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    large = cut_lineage(size.filter(F.col("n") > min(block, heavy)), "large-groups")
    popular = base.join(large.filter(F.col("n") > heavy), "g")
    order = [("n", "desc"), ("g", "asc")]
    aside = cut_lineage(top_per_group(popular, ["m"], order, at_least - 1).select("m", "g", "w"), "aside")
    none_aside = aside.isEmpty()

    blocks = large.select("g", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    sized = base if none_aside else base.join(aside.select("m", "g", F.lit(True).alias("out")), ["m", "g"], "left")
    sized = sized.join(blocks, "g", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    entry = F.struct("m", "w", (F.lit(False) if none_aside else F.coalesce("out", F.lit(False))).alias("out"))
    sized = sized.select("g", "blocks", F.pmod(F.xxhash64("m"), F.col("blocks")).cast("int").alias("k"), entry.alias("own"))
    lists = cut_lineage(sized.groupBy("g", "blocks", "k").agg(F.sort_array(F.collect_list("own")).alias("l")), "group-lists")  # at most about a block each
    each = lambda rows: rows.select("*", F.posexplode("l").alias("at", "own"))
    after = F.slice("l", F.col("at") + 2, F.size("l"))
    within = each(lists).select("own", after.alias("l"))
    # members of a group of several blocks meet its other blocks
    several = lists.filter("blocks > 1")
    across = each(several).select("g", "k", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).filter("other <> k").drop("k")
    across = across.join(several.select("g", F.col("k").alias("other"), "l"), ["g", "other"])
    across = across.select("own", F.filter("l", lambda x: x["m"] > F.col("own.m")).alias("l"))
    met = within.unionByName(across)
    if not none_aside:
        met = met.select("own", F.filter("l", lambda x: ~(x["out"] & F.col("own.out"))).alias("l"))
    met = met.filter(F.size("l") > 0).select(
        F.col("own.m").alias("a"), F.col("own.w").alias("wa"), F.transform("l", lambda x: x["m"]).alias("b"), F.transform("l", lambda x: x["w"]).alias("wb")
    )
    pairs = cut_lineage(met.groupBy("a").agg(F.sum(F.size("b")).alias("pairs")), "pair-counts")
    total = pairs.agg(F.sum("pairs")).first()[0] or 0
    # members of more than PAIRS pairs are at most a thousand, or each has a thousandth of all
    share = max(PAIRS, total // 1000)
    busy = pairs.filter(F.col("pairs") > share).select("a", F.ceil(F.col("pairs") / PAIRS).cast("int").alias("slots"))
    dealt = met.join(F.broadcast(busy), "a", "left").withColumn("slot", F.explode(F.sequence(F.lit(0), F.coalesce("slots", F.lit(1)) - 1)))
    zipped = F.arrays_zip("b", "wb")
    own_slot = F.filter(zipped, lambda x: F.pmod(F.xxhash64(x["b"]), F.col("slots")) == F.col("slot"))
    dealt = dealt.withColumn("z", F.when(F.col("slots").isNull(), zipped).otherwise(own_slot)).filter(F.size("z") > 0)
    dealt = dealt.select("a", "slot", "wa", F.col("z.b").alias("b"), F.col("z.wb").alias("wb"))
    tasks = max(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PAIRS))
    dealt = dealt.repartition(tasks, "a", "slot")
    seen = dealt.select("a", "slot", "wa", F.explode(F.arrays_zip("b", "wb")).alias("x")).select("a", "slot", F.col("x.b").alias("b"), (F.col("wa") + F.col("x.wb")).alias("w"))
    seen = seen.groupBy("a", "slot", "b").agg(F.count(F.lit(1)).alias("s"), F.sum("w").alias("w"))  # the same partitions: no exchange
    if none_aside:
        return seen.filter(F.col("s") >= at_least).select("a", "b", F.col("s").alias("shared"), F.col("w").alias("combined"))
    kept = aside.groupBy("m").agg(F.collect_list(F.struct("g", "w")).alias("l"))  # at most k - 1 entries
    left, right = kept.select(F.col("m").alias("a"), F.col("l").alias("la")), kept.select(F.col("m").alias("b"), F.col("l").alias("lb"))
    joined = seen.join(left, "a", "left").join(right, "b", "left")
    match = F.filter("la", lambda x: F.exists("lb", lambda y: x["g"] == y["g"]))
    back = F.filter("lb", lambda y: F.exists("la", lambda x: x["g"] == y["g"]))
    weight_of = lambda arr: F.coalesce(F.aggregate(arr, F.lit(0).cast("bigint"), lambda s, x: s + x["w"]), F.lit(0))
    shared = F.col("s") + F.coalesce(F.when(F.col("la").isNotNull() & F.col("lb").isNotNull(), F.size(match)), F.lit(0))
    combined = F.col("w") + weight_of(match) + weight_of(back)
    return joined.select("a", "b", shared.cast("bigint").alias("shared"), combined.cast("bigint").alias("combined")).filter(
        F.col("shared") >= at_least
    )
