"""Join strategies beyond a plain equi-join.

Band, tier, as-of and salted joins are stated as equi-joins, running scans or
array look-ups, so none of them falls back to a nested loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwell.operators.ordered import running
from sparkwell.session import cut_lineage, plan_bytes

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only while Catalyst's size estimate stays below ``limit``."""
    return F.broadcast(df) if plan_bytes(df) <= limit else df


def tier_join(df: DataFrame, value: str, tiers: Sequence[tuple[str, float, float]], name: str = "tier") -> DataFrame:
    """Half-open range look-up into a short parameter list; unmatched values drop out."""
    table = F.array(
        *[
            F.struct(F.lit(t).alias("tier"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"))
            for t, lo, hi in tiers
        ]
    )
    hits = F.filter(table, lambda x: (F.col(value) >= x["lo"]) & (F.col(value) < x["hi"]))
    return df.select("*", F.explode(hits).alias("_t")).select(*df.columns, F.col("_t.tier").alias(name))


def band_counts(df: DataFrame, value: str, width: float, name: str = "in_band") -> DataFrame:
    """Per row, how many other rows have a value within ``width`` (inclusive); values and bounds are rounded to 6 places.

    The count between two bounds is a difference of running counts. Distinct values with their number of
    rows and the bounds of each value are merged into one sorted scan: a lower bound takes the count of what stands before it, an
    upper bound that of what stands up to it. No values are paired, whatever their density. Null values have no count.
    """
    at = F.round(F.col(value).cast("double"), 6)
    values = cut_lineage(df.filter(F.col(value).isNotNull()).groupBy(at.alias("_v")).agg(F.count(F.lit(1)).alias("_n")), "band-values")
    place = lambda v, kind, own, n: values.select(v.alias("_at"), F.lit(kind).alias("_kind"), own.alias("_own"), n.alias("_n"))
    nobody, none = F.lit(None).cast("double"), F.lit(0).cast("bigint")
    # at one place: lower bounds, then the value itself, then upper bounds
    merged = place(F.round(F.col("_v") - width, 6), 0, F.col("_v"), none)
    merged = merged.unionByName(place(F.col("_v"), 1, nobody, F.col("_n"))).unionByName(place(F.round(F.col("_v") + width, 6), 2, F.col("_v"), none))
    scanned = running(merged.withColumn("_all", F.lit(0)), ["_all"], [("_at", "asc"), ("_kind", "asc"), ("_own", "asc")], {"_upto": ("sum", F.col("_n"))})
    bounds = scanned.filter("_kind <> 1").groupBy("_own").agg(F.sum(F.when(F.col("_kind") == 2, F.col("_upto")).otherwise(-F.col("_upto"))).alias("_within"))
    counted = df.join(bounds, at == F.col("_own"), "left")
    return counted.withColumn(name, F.col("_within") - 1).drop("_own", "_within")


#: Tasks a key may be spread over; one that held every row would be read by so many.
MOST_SALTS = 4096


def salted_join(big: DataFrame, small: DataFrame, key: str, share: float = 0.001, how: str = "inner") -> DataFrame:
    """Equi-join that spreads each key of more than ``share`` of all rows over tasks in proportion to its counted weight.

    A key of weight w gets ceil(w / share) salts, so no task reads more than about ``share`` of all rows of one key.
    At most ``1 / share`` keys can pass, which bounds the broadcast, and their salts together are at most 2 / share, which
    bounds the copies of the small side. ``how`` is inner or left. Null keys match nothing and are never salted.
    """
    if how not in ("inner", "left"):
        raise ValueError("rows of the small side are copied: only inner and left joins count them once")
    counts = cut_lineage(big.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "salt-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    salts = F.least(F.ceil(F.col("_n") / F.lit(max(1.0, total * share))), F.lit(MOST_SALTS)).cast("int")
    hot = counts.filter((F.col("_n") > total * share) & F.col(key).isNotNull()).select(F.col(key).alias("_hot"), salts.alias("_salts"))
    mark = F.broadcast(hot)
    salt = F.coalesce(F.pmod(F.xxhash64(*big.columns), F.col("_salts")).cast("int"), F.lit(0))
    left = big.join(mark, F.col(key) == F.col("_hot"), "left").withColumn("_salt", salt).drop("_hot", "_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = small.join(mark, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(copies)).drop("_hot", "_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    fact_time: str,
    version_time: str,
    payload: Sequence[str],
) -> DataFrame:
    """Each fact with the payload of the latest version at or before its time.

    Facts and versions are merged into one ordered scan whose running maximum
    carries the last version, so a hot key costs a sort, not fact x version pairs.
    """
    version = F.struct(F.col(version_time).alias("at"), *[F.col(c) for c in payload])
    right = versions.select(
        *keys, F.col(version_time).alias("_at"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_seq"),
        version.alias("_version"), F.lit(None).cast(facts.select(F.struct("*")).schema[0].dataType).alias("_fact"),
    )
    left = facts.select(
        *keys, F.col(fact_time).alias("_at"), F.lit(1).alias("_kind"), F.xxhash64(*facts.columns).alias("_seq"),
        F.lit(None).cast(right.schema["_version"].dataType).alias("_version"), F.struct("*").alias("_fact"),
    )
    order = [("_at", "asc"), ("_kind", "asc"), ("_seq", "asc")]
    scanned = running(left.unionByName(right), keys, order, {"_last": ("max", F.col("_version"))})
    return scanned.filter("_kind = 1").select(
        "_fact.*", F.col("_last.at").alias(version_time), *[F.col(f"_last.{c}").alias(c) for c in payload]
    )


def next_within(
    firsts: DataFrame, seconds: DataFrame, keys: Sequence[str], time: str, within: Column, name: str
) -> DataFrame:
    """``firsts`` plus a flag: does an event of ``seconds`` with equal keys follow within the interval?

    Only the nearest following event matters, so one reverse ordered scan answers it.
    """
    left = firsts.select(*firsts.columns, F.lit(1).alias("_kind"), F.lit(None).cast("timestamp_ntz").alias("_b"))
    right = seconds.select(
        *[F.col(c) if c in (*keys, time) else F.lit(None).cast(dict(firsts.dtypes)[c]).alias(c) for c in firsts.columns],
        F.lit(0).alias("_kind"), F.col(time).alias("_b"),
    )
    both = left.unionByName(right).withColumn("_seq", F.xxhash64(*firsts.columns))
    order = [(time, "desc"), ("_kind", "asc"), ("_seq", "asc")]
    scanned = running(both, keys, order, {"_next": ("min", F.col("_b"))}).filter("_kind = 1")
    hit = F.coalesce(F.col("_next") <= F.col(time) + within, F.lit(False))
    return scanned.select(*firsts.columns, hit.alias(name))
