"""Row changes as new table versions: updates, deletes, merges and dimension history.

Without a transactional table format a change is a DataFrame from the old rows
and the changes; ``sources.versioned`` swaps it in. Keys must be unique on both
sides (``duplicate_keys`` reports offenders), so these joins cannot multiply rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwell.operators.ordered import with_row_number

OPEN_END = "9999-12-31"


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def update_where(df: DataFrame, cond: Column, **sets: Column) -> DataFrame:
    """SET columns where ``cond`` is true; NULL conditions leave a row alone."""
    return df.withColumns({c: F.when(cond, v).otherwise(F.col(c)) for c, v in sets.items()})


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """UPDATE ... FROM: matched rows take the source columns."""
    src = source.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(src, list(keys), "left")
    taken = {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(taken).select(*target.columns)


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Keep every row for which ``cond`` is not true, also where it is NULL."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def differs(columns: Sequence[str], left: str = "_t", right: str = "_s") -> Column:
    """Null-safe inequality of any column."""
    parts = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a | b, parts)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    only_changed: bool = False,
    delete_missing: bool = False,
) -> DataFrame:
    """MERGE as one full outer join. Returns (action, _t, _s): the old and the new row as structs.

    action is INSERT, UPDATE, DELETE or KEEP. With ``only_changed`` matched rows
    whose common columns are all equal (NULL equals NULL) stay KEEP.
    """
    common = [c for c in source.columns if c not in keys and c in target.columns]
    t = target.select(*[F.col(k).alias(f"_tk_{k}") for k in keys], F.struct(*target.columns).alias("_t"))
    s = source.select(*[F.col(k).alias(f"_sk_{k}") for k in keys], F.struct(*source.columns).alias("_s"))
    cond = reduce(lambda a, b: a & b, [F.col(f"_tk_{k}") == F.col(f"_sk_{k}") for k in keys])
    joined = t.join(s, cond, "full").select("_t", "_s")
    matched = F.when(differs(common), "UPDATE").otherwise("KEEP") if only_changed and common else F.lit("UPDATE")
    action = (
        F.when(F.col("_t").isNull(), "INSERT")
        .when(F.col("_s").isNull(), F.lit("DELETE" if delete_missing else "KEEP"))
        .otherwise(matched)
    )
    return joined.withColumn("action", action)


def merged_rows(merged: DataFrame, stamps: dict[str, Column] | None = None) -> DataFrame:
    """The table after a merge. ``stamps`` are set on inserted and updated rows only."""
    columns = merged.schema["_t"].dataType.names
    given = set(merged.schema["_s"].dataType.names)
    written = F.col("action").isin("INSERT", "UPDATE")
    out = []
    for c in columns:
        old = F.col(f"_t.{c}")
        if stamps and c in stamps:
            out.append(F.when(written, stamps[c]).otherwise(old).alias(c))
        elif c in given:
            out.append(F.when(written, F.col(f"_s.{c}")).otherwise(old).alias(c))
        else:
            out.append(old.alias(c))
    return merged.filter("action <> 'DELETE'").select(*out)


def scd2(dim: DataFrame, updates: DataFrame, keys: Sequence[str], attrs: Sequence[str], as_of: str) -> DataFrame:
    """Type-2 history: changed current rows are closed the day before, new versions open.

    ``dim``: keys, attrs, valid_from, valid_to, is_current. ``updates``: keys, attrs.
    """
    as_of_day = F.lit(as_of).cast("date")
    current, past = dim.filter("is_current"), dim.filter("NOT is_current")
    joined = merge(current, updates.select(*keys, *attrs), keys, only_changed=True)
    kept = joined.filter("action = 'KEEP'").select("_t.*")
    closed = joined.filter("action = 'UPDATE'").select("_t.*").withColumns(
        {"valid_to": F.date_sub(as_of_day, 1), "is_current": F.lit(False)}
    )
    opened = joined.filter("action IN ('INSERT', 'UPDATE')").select("_s.*").select(
        *keys, *attrs, as_of_day.alias("valid_from"), F.lit(OPEN_END).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    return past.unionByName(kept).unionByName(closed).unionByName(opened)


def scd3(dim: DataFrame, updates: DataFrame, key: str, attr: str) -> DataFrame:
    """Type-3: the old value moves to ``previous_<attr>`` when it changes."""
    new = updates.select(F.col(key).alias("_k"), F.col(attr).alias("_new"))
    changed = F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col(attr))
    joined = dim.join(new, F.col(key) == F.col("_k"), "left")
    out = joined.withColumns(
        {
            f"previous_{attr}": F.when(changed, F.col(attr)),
            attr: F.when(changed, F.col("_new")).otherwise(F.col(attr)),
        }
    )
    return out.drop("_k", "_new")


def surrogate_keys(new: DataFrame, order: str, name: str, start: Column | int = 0) -> DataFrame:
    """Dense keys start + 1 .. start + n in the order of a unique column."""
    numbered = with_row_number(new, [], [(order, "asc")], "_rn")
    offset = start if isinstance(start, Column) else F.lit(start)
    return numbered.withColumn(name, (F.col("_rn") + offset).cast("bigint")).drop("_rn")
