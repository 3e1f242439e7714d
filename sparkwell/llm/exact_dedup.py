"""Exact dedup with an extendible-hash index on shared files, in DataFrame operations only.

* Rows are combined to distinct texts by (hash key, text): the hash aggregate chains texts
  that share a key and compares their bytes. Copies meet in the map tasks, so a group of
  any size moves one row per task.
* The directory starts with one bucket. A bucket of more entries than its capacity is split by
  the next bit of the key; when that bit is beyond the directory's depth, the directory doubles.
  Splits read a histogram of the next ``cell_bits`` key bits, never the entries; buckets
  that outgrow one histogram get the next one.
* Owner tasks then take ranges of the buckets' keys, number the chain of each key, and
  write the index to the shared folder. A row is looked up by key and digest; only texts
  that occur twice or more have to be looked up at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkwell.llm.common import small_side, stored

#: Entries of a bucket before it splits.
CAPACITY = 1 << 16
#: Key bits per histogram: bounds its rows, and the broadcast, to 4096 for each bucket still too full.
CELL_BITS = 12
#: Rows up to which the texts that repeat are broadcast: about 120 bytes each.
REPEATED_ROWS = 50_000


def _keyed(docs: DataFrame, key_bits: int) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.xxhash64(text)
    if key_bits < 64:  # tests use few bits to make texts collide
        key = F.shiftleft(key, 64 - key_bits)
    return docs.withColumns({"_text": text, "_key": key})


def _prefix(bits: int) -> Column:
    """The first ``bits`` bits of the key as a number."""
    return F.lit(0).cast("bigint") if bits == 0 else F.shiftrightunsigned("key", 64 - bits)


def directory(entries: DataFrame, capacity: int = CAPACITY, cell_bits: int = CELL_BITS) -> DataFrame:
    """(depth, prefix, entries): the buckets of an extendible-hash directory over ``entries.key``.

    A bucket holds the keys that begin with the ``depth`` bits of ``prefix``. No bucket exceeds
    the capacity unless equal keys alone do. An empty table gives one empty bucket.
    """
    spark = entries.sparkSession
    found = None
    full = spark.range(1, numPartitions=1).select(F.lit(0).alias("depth"), F.col("id").alias("prefix"))
    base = 0
    while base < 64:
        deep = min(base + cell_bits, 64)
        inside = entries if base == 0 else entries.join(F.broadcast(full), _prefix(base) == F.col("prefix"), "left_semi")
        cells = inside.groupBy(_prefix(deep).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
        # every depth of the histogram at once; a bucket is the first prefix within the capacity
        levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(base), F.lit(deep))).alias("depth"))
        levels = levels.withColumn("prefix", F.expr(f"IF(depth = 0, 0, shiftrightunsigned(cell, {deep} - depth))"))
        sums = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("entries"))
        above = sums.filter((F.col("entries") > capacity) & (F.col("depth") < deep)).select((F.col("depth") + 1).alias("depth"), "prefix")
        halves = above.select("depth", F.explode(F.array(F.shiftleft("prefix", 1), F.shiftleft("prefix", 1).bitwiseOR(F.lit(1)))).alias("prefix"))
        start = full.select(F.col("depth"), "prefix") if base == 0 else full
        alive = start.unionByName(halves.select(F.col("depth").cast("int").alias("depth"), "prefix"))
        state = stored(
            alive.join(sums, ["depth", "prefix"], "left").select("depth", "prefix", F.coalesce("entries", F.lit(0)).alias("entries")), "directory"
        )
        closed = state.filter((F.col("entries") <= capacity) | (F.col("depth") == 64))
        found = closed if found is None else found.unionByName(closed)
        full = state.filter((F.col("entries") > capacity) & (F.col("depth") == deep)).select("depth", "prefix")
        if deep == 64 or full.isEmpty():
            return found
        base = deep


def build_index(docs: DataFrame, key_bits: int = 64, capacity: int = CAPACITY, cell_bits: int = CELL_BITS) -> DataFrame:
    """One entry for each distinct text: (depth, bucket, key, chain, text_sha256, keep_id, group_size), on shared files."""
    rows = _keyed(docs.select("doc_id", "text"), key_bits)
    texts = rows.groupBy(F.col("_key").alias("key"), "_text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    entries = stored(texts.select("key", F.sha2("_text", 256).alias("text_sha256"), "keep_id", "group_size"), "entries")
    buckets = directory(entries, capacity, cell_bits)
    # the prefix of a bucket, moved to the front of the key's range, orders buckets like their keys
    depths = [r["depth"] for r in buckets.select("depth").distinct().collect()]  # at most 65 numbers
    dealt = None
    for depth in sorted(depths):
        own = buckets.filter(F.col("depth") == depth).select("depth", F.col("prefix").alias("bucket"))
        part = entries.join(small_side(own), _prefix(depth) == F.col("bucket"))
        dealt = part if dealt is None else dealt.unionByName(part)
    order = F.col("key").bitwiseXOR(F.lit(-(2**63)).cast("bigint"))  # unsigned order of the keys
    owned = dealt.withColumn("place", order).repartitionByRange("place")
    chain = F.row_number().over(Window.partitionBy("place").orderBy("text_sha256"))
    return stored(owned.withColumn("chain", chain).select("depth", "bucket", "key", "chain", "text_sha256", "keep_id", "group_size"), "index")


def find_copies(docs: DataFrame, key_bits: int = 64, capacity: int = CAPACITY, cell_bits: int = CELL_BITS) -> DataFrame:
    """The rows of ``docs`` with keep_id, group_size, kept and text_sha256 of their exact text.

    Null counts as empty text; an empty table gives an empty result. Of equal texts the row with
    the largest doc_id is kept; null ids lose against any other. Rows that repeat that very doc_id
    and text are one document and are all kept. Columns of these names in ``docs`` are replaced.
    """
    made = ["keep_id", "group_size", "kept", "text_sha256"]
    docs = docs.drop(*made, "_key", "_text")
    index = build_index(docs, key_bits, capacity, cell_bits)
    again = index.filter("group_size > 1").select(F.col("key").alias("_key"), "text_sha256", F.col("keep_id").alias("_keep"), F.col("group_size").alias("_size"))
    rows = _keyed(docs, key_bits).withColumn("text_sha256", F.sha2("_text", 256)).drop("_text")
    out = rows.join(small_side(again, REPEATED_ROWS), ["_key", "text_sha256"], "left")
    size = F.coalesce("_size", F.lit(1)).cast("bigint")
    keep = F.when(F.col("_size").isNull(), F.col("doc_id")).otherwise(F.col("_keep"))
    return out.withColumns({"keep_id": keep, "group_size": size, "kept": F.col("doc_id").eqNullSafe(keep)}).select(*docs.columns, *made)


def exact_copies_removed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``."""
    return find_copies(docs).filter("kept").select(docs.columns)
