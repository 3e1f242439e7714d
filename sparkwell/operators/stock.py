"""All-or-nothing order admission against stock, decided in parallel rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwell.operators.ordered import running
from sparkwell.session import cut_lineage


def admit_orders(lines: DataFrame, stock: DataFrame) -> DataFrame:
    """(order_id, accepted) exactly as if the orders were taken one by one.

    ``lines``: order_id, arrival, product_id, quantity. ``stock``: product_id, stock.
    ``arrival`` orders the orders and is unique per order.

    Per round an open order is accepted when it fits even if every earlier
    order that is not rejected takes its stock, and rejected when it does not
    fit beside the accepted earlier ones alone. The earliest open order always
    meets one of the two, so the rounds end. A decided order leaves the table: an open line carries
    the quantity ``taken`` by the accepted ones before it, so a round reads what is open and what the last one accepted.
    """
    demand = lines.groupBy("order_id", "arrival", "product_id").agg(F.sum("quantity").alias("quantity"))
    demand = demand.join(stock, "product_id", "left").withColumn("stock", F.coalesce("stock", F.lit(0)))
    none = F.lit(0).cast("bigint")
    state = cut_lineage(demand.select("*", none.alias("taken"), F.lit("open").alias("status")), "stock")
    order = [("arrival", "asc"), ("order_id", "asc")]
    decided = None
    while True:
        accepted = F.when(F.col("status") == "accepted", F.col("quantity")).otherwise(none)
        scanned = running(
            state, ["product_id"], order,
            {"_most": ("sum", F.col("quantity")), "_least": ("sum", accepted)},
        )
        # what was accepted in the last round is added to the lines after it and then leaves
        open_lines = scanned.filter("status = 'open'")
        fits = F.col("taken") + F.col("_most") <= F.col("stock")
        fails = F.col("taken") + F.col("_least") + F.col("quantity") > F.col("stock")
        verdict = open_lines.groupBy("order_id").agg(F.min(fits).alias("fits"), F.max(fails).alias("fails"))
        verdict = verdict.select(
            "order_id", F.when(F.col("fails"), "rejected").when(F.col("fits"), "accepted").otherwise("open").alias("next")
        )
        kept = open_lines.withColumn("taken", F.col("taken") + F.col("_least")).drop("_most", "_least", "status")
        moved = cut_lineage(kept.join(verdict, "order_id").withColumnRenamed("next", "status").select(*state.columns), "stock")
        done = moved.filter("status <> 'open'").select("order_id", (F.col("status") == "accepted").alias("accepted")).distinct()
        decided = done if decided is None else decided.unionByName(done)
        state = moved.filter("status <> 'rejected'")
        if state.filter("status = 'open'").isEmpty():
            return decided
