"""Data-quality rules, gates and layers, and the user-function surface."""

from sparkwell.functions.predicates import guarded_flag
from sparkwell.functions.udfs import harmonic_total, parse_records, weighted_mean
from sparkwell.operators.merge import merge, merged_rows
from sparkwell.operators.ordered import latest_per_key
from sparkwell.operators.quality import check_report, gate, key_shares, orphans, unique_report
from sparkwell.plans.common import F, Tables, col, day, lit, net, query, rows, when
from sparkwell.plans.streams import staged
from sparkwell.session import shared_path
from sparkwell.sources.readers import with_reasons
from sparkwell.sources.versioned import VersionedTable
from sparkwell.streaming import jobs


@query(
    "dq_not_null",
    """SELECT 'c_name not null' AS rule, COUNT(*) AS rows, COUNT(*) - COUNT(c_name) AS violations FROM customer
       UNION ALL SELECT 'segment not null', COUNT(*), COUNT(CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 END) FROM customer""",
)
def dq_not_null(t: Tables):
    segment = F.nullif(col("c_mktsegment"), lit("FURNITURE"))
    return check_report(t.customer, {"c_name not null": col("c_name").isNotNull(), "segment not null": segment.isNotNull()})


@query(
    "dq_unique",
    """SELECT 'o_orderkey' AS rule, COUNT(*) AS rows, COUNT(*) - COUNT(DISTINCT o_orderkey) AS violations FROM orders
       UNION ALL SELECT 'l_orderkey, l_linenumber', COUNT(*), COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem""",
)
def dq_unique(t: Tables):
    return unique_report(t.orders, ["o_orderkey"], "o_orderkey").unionByName(
        unique_report(t.lineitem, ["l_orderkey", "l_linenumber"], "l_orderkey, l_linenumber")
    )


@query(
    "dq_check",
    """SELECT 'discount below 0.1' AS rule, COUNT(*) AS rows, COUNT(CASE WHEN NOT l_discount < 0.1 THEN 1 END) AS violations FROM lineitem
       UNION ALL SELECT 'tax below discount', COUNT(*), COUNT(CASE WHEN l_discount <> 0 AND NOT l_tax < l_discount THEN 1 END) FROM lineitem""",
)
def dq_check(t: Tables):
    """A zero discount is unknown here, and an unknown check passes."""
    known = F.nullif(col("l_discount"), lit(0.0))
    return check_report(t.lineitem, {"discount below 0.1": col("l_discount") < 0.1, "tax below discount": col("l_tax") < known})


@query(
    "dq_foreign_key",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_partkey <> 17 AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 45)",
)
def dq_foreign_key(t: Tables):
    """Lines without a parent among the parts below size 45; a NULL key passes."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.nullif(col("l_partkey"), lit(17)).alias("fk"))
    return orphans(lines, "fk", t.part.filter("p_size < 45"), "p_partkey").drop("fk")


@query(
    "dq_accepted_values",
    "SELECT o_orderstatus AS value, COUNT(*) AS n, o_orderstatus IN ('O', 'F') AS accepted FROM orders GROUP BY 1",
)
def dq_accepted_values(t: Tables):
    counts = t.orders.groupBy(col("o_orderstatus").alias("value")).agg(rows().alias("n"))
    return counts.withColumn("accepted", col("value").isin("O", "F"))


@query(
    "dq_expectations",
    """SELECT 'price in range' AS expectation, CAST(COUNT(CASE WHEN o_totalprice BETWEEN 1000 AND 400000 THEN 1 END) AS DOUBLE) / COUNT(*) >= 0.95 AS met FROM orders
       UNION ALL SELECT 'status in set', COUNT(CASE WHEN o_orderstatus NOT IN ('O', 'F', 'P') THEN 1 END) = 0 FROM orders
       UNION ALL SELECT 'mean price', AVG(o_totalprice) BETWEEN 200000 AND 300000 FROM orders
       UNION ALL SELECT 'row count', COUNT(*) > 100 FROM orders""",
)
def dq_expectations(t: Tables):
    """Range, set, distribution and volume expectations from one pass."""
    facts = t.orders.agg(
        (F.count_if(col("o_totalprice").between(1000, 400000)) / rows() >= 0.95).alias("price in range"),
        (F.count_if(~col("o_orderstatus").isin("O", "F", "P")) == 0).alias("status in set"),
        F.avg("o_totalprice").between(200000, 300000).alias("mean price"), (rows() > 100).alias("row count"),
    )
    return facts.unpivot([], facts.columns, "expectation", "met")


@query(
    "dq_gate",
    """SELECT 'clean' AS batch, 'published' AS outcome, COUNT(*) AS n FROM orders WHERE o_totalprice <= 400000
       UNION ALL SELECT 'dirty', 'quarantined', COUNT(*) FROM orders""",
)
def dq_gate(t: Tables):
    """A batch goes to the next layer only when every rule holds; otherwise the whole batch is set aside."""
    out = None
    for name, batch in (("clean", t.orders.filter("o_totalprice <= 400000")), ("dirty", t.orders)):
        passed = gate(check_report(batch, {"price": col("o_totalprice") <= 400000, "key": col("o_orderkey") >= 0}))
        place = "published" if passed else "quarantined"
        path = shared_path(t.spark, f"gate-{place}")
        batch.select("o_orderkey", "o_totalprice").write.parquet(path)
        stored = t.spark.read.schema("o_orderkey BIGINT, o_totalprice DOUBLE").parquet(path)
        part = stored.agg(lit(name).alias("batch"), lit(place).alias("outcome"), rows().alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "dq_quarantine",
    """SELECT CASE WHEN o_totalprice > 400000 OR o_orderstatus = 'P' THEN 'errors' ELSE 'archive' END AS place,
              concat_ws(',', CASE WHEN o_totalprice > 400000 THEN 'price' END, CASE WHEN o_orderstatus = 'P' THEN 'status' END) AS reasons, COUNT(*) AS n FROM orders GROUP BY 1, 2""",
)
def dq_quarantine(t: Tables):
    """Bad rows land in the errors folder with their reasons."""
    path = shared_path(t.spark, "quarantine")
    rules = {"price": col("o_totalprice") <= 400000, "status": col("o_orderstatus") != "P"}
    checked = with_reasons(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), rules)
    placed = checked.withColumn("place", when(F.size("reasons") > 0, "errors").otherwise("archive"))
    placed.write.partitionBy("place").parquet(path)
    stored = t.spark.read.schema(placed.schema).parquet(path)
    return stored.groupBy("place", F.array_join("reasons", ",").alias("reasons")).agg(rows().alias("n"))


@query(
    "medallion_layers",
    """SELECT p_brand AS category, CAST(o_orderdate AS DATE) AS order_day, round(SUM(l_extendedprice * (1 - l_discount)), 4) AS revenue, COUNT(*) AS lines
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_discount < 0.1 AND o_orderstatus <> 'P' GROUP BY 1, 2""",
)
def medallion_layers(t: Tables):
    """Bronze keeps the raw lines, silver the clean typed facts, gold the totals; each layer is replaced as a whole."""
    root = shared_path(t.spark, "layers")
    bronze, silver, gold = (VersionedTable(t.spark, f"{root}/{name}") for name in ("bronze", "silver", "gold"))
    raw = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount")
    bronze.replace(raw.unionByName(raw.filter("l_partkey % 50 = 0")))  # the source repeats some lines
    clean = bronze.read().dropDuplicates().filter("l_discount < 0.1")
    open_orders = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", day("o_orderdate").alias("order_day"))
    silver.replace(clean.join(open_orders, col("l_orderkey") == col("o_orderkey")))
    named = silver.read().join(t.part.select("p_partkey", "p_brand"), col("l_partkey") == col("p_partkey"))
    gold.replace(
        named.groupBy(col("p_brand").alias("category"), "order_day").agg(
            F.round(F.sum(net()), 4).alias("revenue"), rows().alias("lines")
        )
    )
    return gold.read()


@query(
    "full_and_incremental_load",
    """SELECT mode, COUNT(*) AS n, round(SUM(price), 2) AS total FROM (
         SELECT 'overwrite' AS mode, o_totalprice AS price FROM orders UNION ALL SELECT 'append', o_totalprice FROM orders
         UNION ALL SELECT 'upsert', CASE WHEN o_orderkey % 2 = 0 THEN round(o_totalprice * 2, 2) ELSE o_totalprice END FROM orders) GROUP BY 1""",
)
def full_and_incremental_load(t: Tables):
    """The same target after a full overwrite, an append of the new half, and an upsert of the even keys."""
    orders = t.orders.select("o_orderkey", col("o_totalprice").alias("price"))
    cut = t.orders.agg(F.percentile_approx("o_orderkey", 0.5)).scalar()
    old, new = orders.filter(col("o_orderkey") <= cut), orders.filter(col("o_orderkey") > cut)
    full = VersionedTable(t.spark, shared_path(t.spark, "full"))
    full.replace(old)
    full.replace(orders)
    path = shared_path(t.spark, "append")
    old.write.parquet(path)
    new.write.mode("append").parquet(path)
    changed = orders.filter("o_orderkey % 2 = 0").withColumn("price", F.round(col("price") * 2, 2))
    upserted = merged_rows(merge(full.read(), changed, ["o_orderkey"]))
    out = None
    for mode, df in (("overwrite", full.read()), ("append", t.spark.read.schema(orders.schema).parquet(path)), ("upsert", upserted)):
        part = df.agg(lit(mode).alias("mode"), rows().alias("n"), F.round(F.sum("price"), 2).alias("total"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "latest_per_entity",
    "SELECT user_id, MAX(event_id) AS last_event, arg_max(event_type, event_id) AS state, arg_max(value, event_id) AS value FROM events GROUP BY 1",
)
def latest_per_entity(t: Tables):
    events = t.events.select("user_id", col("event_id").alias("last_event"), col("event_type").alias("state"), "value")
    return latest_per_key(events, ["user_id"], ["last_event"])


@query(
    "batch_to_spark_scaleup",
    "SELECT event_type, COUNT(*) * 4 AS n, round(SUM(value) * 4, 2) AS total FROM events GROUP BY 1",
)
def batch_to_spark_scaleup(t: Tables, factor: int = 4):
    """The same job on rows multiplied inside each task."""
    copies = t.events.select("event_type", "value", F.explode(F.sequence(lit(1), lit(factor))).alias("copy"))
    return copies.groupBy("event_type").agg(rows().alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(
    "skew_report",
    """SELECT user_id, COUNT(*) AS n, round(COUNT(*) / (SELECT COUNT(*) FROM events), 9) AS share FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 10""",
)
def skew_report(t: Tables):
    return key_shares(t.events, "user_id", 10).withColumn("share", F.round("share", 9))


@query(
    "udf_scalar_guarded",
    """SELECT doc_id, lang = 'en' AND length(text) - length(replace(text, 'the', '')) >= 15 AS flagged FROM documents""",
)
def udf_scalar_guarded(t: Tables):
    flag = F.coalesce(guarded_flag(col("lang") == "en", col("text")), lit(False))
    return t.documents.select("doc_id", flag.alias("flagged"))


@query("udf_record_factory", "SELECT event_id AS id, event_type AS kind, CASE WHEN event_id % 5 <> 0 THEN value END AS amount FROM events")
def udf_record_factory(t: Tables):
    """Lines of an odd format; every fifth amount cannot be read."""
    amount = when(col("event_id") % 5 == 0, "n/a").otherwise(col("value").cast("string"))
    line = F.concat(lit("kind="), "event_type", lit(";amount="), amount, lit(";id="), col("event_id").cast("string"))
    return parse_records(t.events.select(line.alias("line")), "line")


@query("udf_foreach_batch", "SELECT event_type AS page, COUNT(*) AS n FROM events GROUP BY 1")
def udf_foreach_batch(t: Tables):
    """A user function per micro-batch: counts are written under the batch id."""
    stage = staged(t, "each-batch")

    def write(df, batch_id):
        counts = df.groupBy("page").agg(rows().alias("n"))
        jobs.write_batch(counts, stage.sink, batch_id)

    jobs.drain_each_batch(stage.views(), write, stage.checkpoint, "append")
    written = t.spark.read.schema("page STRING, n BIGINT, batch_id BIGINT").parquet(stage.sink)
    return written.groupBy("page").agg(F.sum("n").alias("n"))


@query(
    "udaf_custom",
    """SELECT p_brand, round(SUM(p_retailprice * p_size) / SUM(p_size), 6) AS weighted_price FROM part GROUP BY 1""",
)
def udaf_custom(t: Tables):
    price = weighted_mean(col("p_retailprice"), col("p_size").cast("double"))
    return t.part.groupBy("p_brand").agg(F.round(price, 6).alias("weighted_price"))


@query(
    "udtf_generator",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(i * 7 AS INTEGER) AS visit_day, round(1.0 / (o_orderkey % 3 + 1) + 1.0 / (o_orderkey % 5 + 1), 9) AS cost
       FROM orders, range(1, 4) s(i)""",
)
def udtf_generator(t: Tables):
    """Three weekly dates per order, generated from a sequence."""
    start = day("o_orderdate")
    days = F.sequence(F.date_add(start, 7), F.date_add(start, 21), F.expr("INTERVAL 7 DAYS"))
    cost = harmonic_total(F.array(col("o_orderkey") % 3 + 1, col("o_orderkey") % 5 + 1))
    return t.orders.select("o_orderkey", F.explode(days).alias("visit_day"), F.round(cost, 9).alias("cost"))
