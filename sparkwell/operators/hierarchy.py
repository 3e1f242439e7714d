"""Trees and chains by level-wise equi-joins, one join per level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwell.session import cut_lineage


def expand_hierarchy(nodes: DataFrame, id_col: str, parent_col: str, name: Column) -> DataFrame:
    """(id, level, path of ids, path of names) for every node below the roots.

    ``nodes`` has one row per id. A node already on its own path is not entered
    again, so cyclic input ends too. Each level joins the frontier (unique ids)
    with the nodes on their parent; adaptive execution splits a hot parent.
    """
    base = nodes.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent"), name.alias("name"))
    frontier = base.filter("parent IS NULL").select(
        "id", F.lit(0).cast("long").alias("level"), F.array("id").alias("ids"), F.array("name").alias("names")
    )
    frontier = cut_lineage(frontier)
    levels = frontier
    while not frontier.isEmpty():
        up = frontier.select(F.col("id").alias("parent"), F.col("level"), "ids", "names")
        step = base.filter("parent IS NOT NULL").join(up, "parent").filter(~F.array_contains("ids", F.col("id")))
        frontier = cut_lineage(
            step.select(
                "id", (F.col("level") + 1).alias("level"), F.array_append("ids", F.col("id")).alias("ids"),
                F.array_append("names", F.col("name")).alias("names"),
            )
        )
        levels = levels.unionByName(frontier)
    return levels


def walk_until_repeat(starts: DataFrame, edges: DataFrame) -> DataFrame:
    """Follow ``edges`` (src, dst; one per src) from each start until an id repeats or the chain ends.

    Paths are id arrays, so 1 is never mistaken for a part of 10.
    """
    walk = cut_lineage(starts.select("start", F.array("start").alias("path"), F.col("start").alias("at")))
    done = None
    while not walk.isEmpty():
        step = walk.join(edges, F.col("at") == F.col("src"), "left")
        step = cut_lineage(
            step.withColumn("_more", F.col("dst").isNotNull() & ~F.array_contains("path", F.col("dst")))
        )
        closed = step.filter("NOT coalesce(_more, false)").select(
            "start", "path", F.col("dst").isNotNull().alias("cyclic")
        )
        done = closed if done is None else done.unionByName(closed)
        walk = step.filter("_more").select(
            "start", F.array_append("path", F.col("dst")).alias("path"), F.col("dst").alias("at")
        )
    return done
