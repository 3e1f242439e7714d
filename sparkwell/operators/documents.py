"""Nested documents: snapshots, unnesting, validation and text match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwell.operators.ordered import with_row_number

PAGE_ITEMS = 1000


def order_snapshots(orders: DataFrame, customers: DataFrame, lines: DataFrame, page: int = PAGE_ITEMS) -> DataFrame:
    """One document per order: customer struct and array of item structs, prices as of the order.

    An order of more than ``page`` items continues on further pages of the same
    shape, so no array grows without bound and no item is left out. ``amount`` is that of
    the page; what holds for the whole order comes from ``order_totals``.
    """
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    numbered = with_row_number(lines, ["l_orderkey"], [(c, "asc") for c in order], "_rn")
    item = F.struct(
        F.col("_rn").alias("pos"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity"),
        F.round(F.col("l_extendedprice") / F.col("l_quantity"), 6).alias("unit_price"),
        F.col("l_extendedprice").alias("line_amount"),
    )
    pages = numbered.groupBy("l_orderkey", F.floor((F.col("_rn") - 1) / page).alias("page")).agg(
        F.sort_array(F.collect_list(item)).alias("items"), F.sum("l_extendedprice").alias("amount")
    )
    buyer = customers.select(
        F.col("c_custkey").alias("_c"), F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                                 F.col("c_mktsegment").alias("segment")).alias("customer")
    )
    joined = pages.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(buyer, F.col("o_custkey") == F.col("_c"))
    return joined.select(
        F.col("o_orderkey").alias("order_id"), "page", "customer", "items", "amount",
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("created_at"),
    )


def order_totals(orders: DataFrame, customers: DataFrame, lines: DataFrame, **facts: Column) -> DataFrame:
    """One row per order that has items: customer struct, amount, number of items, and ``facts`` aggregated over all its lines."""
    totals = lines.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("amount"), F.count(F.lit(1)).alias("n_items"), *[c.alias(name) for name, c in facts.items()]
    )
    buyer = customers.select(
        F.col("c_custkey").alias("_c"), F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                                 F.col("c_mktsegment").alias("segment")).alias("customer")
    )
    joined = totals.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(buyer, F.col("o_custkey") == F.col("_c"))
    return joined.select(F.col("o_orderkey").alias("order_id"), "customer", "amount", "n_items", F.col("o_orderstatus").alias("status"), *facts)


def whole_quantities() -> Column:
    """Over the lines of an order: each quantity is a whole number >= 1; an unknown one is not."""
    quantity = F.col("l_quantity")
    return F.bool_and(F.coalesce((quantity >= 1) & (quantity == F.floor(quantity)), F.lit(False)))


def validation_rules() -> dict[str, Column]:
    """Required fields, status set, total >= 0, at least one item, each quantity a whole number >= 1; of ``order_totals``
    with the fact ``whole``."""
    return {
        "customer": F.col("customer.id").isNotNull(),
        "status": F.col("status").isin("O", "F"),
        "total": F.col("amount") >= 0,
        "items": F.col("n_items") > 0,
        "quantity": F.col("whole"),
    }


def term_hits(text: Column, terms: list[str]) -> Column:
    """Occurrences of any of the terms as whole lower-case words, in one pass over the text."""
    words = F.lit(rf"(?<![a-z])(?:{'|'.join(terms)})(?![a-z])")
    return F.regexp_count(F.lower(text), words).cast("bigint")
