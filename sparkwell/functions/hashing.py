"""Stable placement of keys: buckets, slots and a hash ring."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 16384
VIRTUAL_NODES = 150


def md5_bucket(key: Column, buckets: int) -> Column:
    """First 32 bits of the MD5 modulo ``buckets``: the same on every engine."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % buckets


def slot_key(key: Column) -> Column:
    """Only the part inside the first braces is hashed, so that tagged keys share a slot."""
    tag = F.regexp_extract(key, r"\{([^{}]+)\}", 1)
    return F.when(tag != "", tag).otherwise(key)


def hash_slot(key: Column) -> Column:
    return md5_bucket(slot_key(key), SLOTS)


def ring_positions(nodes: Sequence[str], virtual: int = VIRTUAL_NODES) -> list[tuple[str, str]]:
    """(position, node) in ring order; positions are MD5 hex strings, so text order is ring order."""
    return sorted((hashlib.md5(f"{n}:{i}".encode()).hexdigest(), n) for n in nodes for i in range(virtual))


def ring_table(spark: SparkSession, nodes: Sequence[str], virtual: int = VIRTUAL_NODES) -> DataFrame:
    """(bucket, entries): the ring cut into 256 buckets by the first byte of the position.

    Each bucket lists its own positions and, last, the owner of what follows them.
    The ring is a parameter of ``virtual`` x ``nodes`` entries, whatever the key count.
    """
    ring = ring_positions(nodes, virtual)
    rows = []
    for b in range(256):
        prefix = f"{b:02x}"
        own = [e for e in ring if e[0][:2] == prefix]
        after = next((n for p, n in ring if p[:2] > prefix), ring[0][1])
        rows.append((prefix, [*own, ("~", after)]))
    return spark.createDataFrame(rows, "bucket STRING, entries ARRAY<STRUCT<p: STRING, n: STRING>>")


def with_ring_node(df: DataFrame, key: str, nodes: Sequence[str], name: str, virtual: int = VIRTUAL_NODES) -> DataFrame:
    """Adds the first node clockwise after each key."""
    ring = ring_table(df.sparkSession, nodes, virtual)
    position = F.md5(key)
    owner = F.filter("entries", lambda e: e["p"] > position)[0]["n"]
    joined = df.withColumn("bucket", F.substring(position, 1, 2)).join(F.broadcast(ring), "bucket")
    return joined.select(*df.columns, owner.alias(name))
