"""Updates, deletes, merges, dimension history, layers and schema changes."""

from sparkwell.operators.merge import (
    delete_where, merge, merged_rows, scd2, scd3, surrogate_keys, update_from, update_where,
)
from sparkwell.operators.ordered import latest_per_key, with_group_stats
from sparkwell.plans.common import F, Tables, big, col, lit, net, query, rows, when
from sparkwell.session import shared_path
from sparkwell.sources.sinks import spread_by
from sparkwell.sources.versioned import VersionedTable


def products(t: Tables):
    return t.part.select("p_partkey", "p_brand", "p_size", "p_retailprice")


def table(t: Tables, label: str, df=None) -> VersionedTable:
    out = VersionedTable(t.spark, shared_path(t.spark, label))
    if df is not None:
        out.replace(df, "load")
    return out


def swapped(t: Tables, label: str, before, change):
    """Load a table, replace it by its changed version, read it back."""
    target = table(t, label, before)
    target.replace(change(target.read()), "change")
    return target.read()


@query(
    "update_expr",
    """SELECT p_partkey, CASE WHEN p_brand = 'Brand#3' THEN round(p_retailprice * 1.1, 4) ELSE p_retailprice END AS p_retailprice FROM part""",
)
def update_expr(t: Tables):
    raise_price = lambda df: update_where(
        df, col("p_brand") == "Brand#3", p_retailprice=F.round(col("p_retailprice") * 1.1, 4)
    )
    return swapped(t, "update_expr", products(t), raise_price).select("p_partkey", "p_retailprice")


@query(
    "update_join",
    """SELECT p_partkey, COALESCE(new_price, p_retailprice) AS p_retailprice FROM part LEFT JOIN
         (SELECT l_partkey, MIN(l_extendedprice) AS new_price FROM lineitem WHERE l_discount = 0.1 GROUP BY 1) ON l_partkey = p_partkey""",
)
def update_join(t: Tables):
    """New prices from a list that is unique per part by construction."""
    price_list = t.lineitem.filter("l_discount = 0.1").groupBy(col("l_partkey").alias("p_partkey")).agg(
        F.min("l_extendedprice").alias("p_retailprice")
    )
    return update_from(t.part.select("p_partkey", "p_retailprice"), price_list, ["p_partkey"], ["p_retailprice"])


@query(
    "update_case",
    """SELECT p_partkey, round(p_retailprice * CASE WHEN p_size < 10 THEN 1.15 WHEN p_size < 30 THEN 1.10 ELSE 1.05 END, 4) AS p_retailprice
       FROM part""",
)
def update_case(t: Tables):
    factor = when(col("p_size") < 10, 1.15).when(col("p_size") < 30, 1.10).otherwise(1.05)
    return t.part.select("p_partkey", F.round(col("p_retailprice") * factor, 4).alias("p_retailprice"))


@query(
    "update_fill_group_avg",
    """WITH x AS (SELECT p_partkey, p_brand, CASE WHEN p_size % 11 <> 0 THEN p_retailprice END AS price FROM part)
       SELECT p_partkey, round(COALESCE(price, AVG(price) OVER (PARTITION BY p_brand)), 6) AS price FROM x""",
)
def update_fill_group_avg(t: Tables):
    gaps = t.part.select("p_partkey", "p_brand", when(col("p_size") % 11 != 0, col("p_retailprice")).alias("price"))
    stats = with_group_stats(gaps, ["p_brand"], mean=F.avg("price"))
    return stats.select("p_partkey", F.round(F.coalesce("price", "mean"), 6).alias("price"))


@query(
    "update_change_report",
    """SELECT p_partkey, p_retailprice AS old_price, round(p_retailprice * 1.1, 4) AS new_price FROM part WHERE p_brand = 'Brand#3'""",
)
def update_change_report(t: Tables):
    old = products(t)
    new = update_where(old, col("p_brand") == "Brand#3", p_retailprice=F.round(col("p_retailprice") * 1.1, 4))
    changed = merge(old, new, ["p_partkey"], only_changed=True).filter("action = 'UPDATE'")
    return changed.select(
        "_t.p_partkey", col("_t.p_retailprice").alias("old_price"), col("_s.p_retailprice").alias("new_price")
    )


@query(
    "delete_where",
    "SELECT p_partkey, NULLIF(p_size, 13) AS stock FROM part WHERE p_size = 13 OR p_size >= 10",
)
def delete_where_query(t: Tables):
    """DELETE WHERE stock < 10: rows with unknown stock stay."""
    stocked = t.part.select("p_partkey", F.nullif(col("p_size"), lit(13)).alias("stock"))
    return delete_where(stocked, col("stock") < 10)


@query(
    "delete_to_archive",
    "SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'archive' ELSE 'live' END AS place FROM orders",
)
def delete_to_archive(t: Tables):
    """Removed rows land in the archive; both tables come from one flagged set."""
    place = when(col("o_orderdate") < lit("1996-01-01").cast("timestamp_ntz"), "archive").otherwise("live")
    path = shared_path(t.spark, "archive")
    flagged = t.orders.select("o_orderkey", "o_totalprice", place.alias("place"))
    flagged.write.partitionBy("place").parquet(path)
    return t.spark.read.parquet(path).select("o_orderkey", "place")


@query(
    "delete_cascade",
    """WITH gone AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0),
            o AS (SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM gone))
       SELECT 'customer' AS tbl, COUNT(*) AS remaining FROM customer WHERE c_acctbal >= 0
       UNION ALL SELECT 'orders', COUNT(*) FROM o
       UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
         WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM gone))""",
)
def delete_cascade(t: Tables):
    """Lines, then orders, then the customers themselves."""
    gone = t.customer.filter("c_acctbal < 0").select("c_custkey")
    gone_orders = t.orders.join(gone, col("o_custkey") == col("c_custkey"), "left_semi").select("o_orderkey")
    lines = t.lineitem.join(gone_orders, col("l_orderkey") == col("o_orderkey"), "left_anti")
    orders = t.orders.join(gone, col("o_custkey") == col("c_custkey"), "left_anti")
    customers = t.customer.filter("c_acctbal >= 0")
    count = lambda name, df: df.agg(lit(name).alias("tbl"), rows().alias("remaining"))
    return count("customer", customers).unionByName(count("orders", orders)).unionByName(count("lineitem", lines))


@query(
    "truncate_reload",
    "SELECT CAST(0 AS BIGINT) AS after_truncate, COUNT(*) AS after_reload, round(SUM(p_retailprice), 2) AS total FROM part",
)
def truncate_reload(t: Tables):
    """Empty the table but keep its schema, then load it in full."""
    target = table(t, "truncate", products(t))
    target.replace(target.read().limit(0), "truncate")
    emptied = target.read()
    target.replace(products(t).select(*emptied.columns), "reload")
    after = emptied.agg(rows().alias("n")).scalar()
    loaded = target.read().agg(rows().alias("after_reload"), F.round(F.sum("p_retailprice"), 2).alias("total"))
    return loaded.withColumn("after_truncate", after)


@query(
    "append_version_read_latest",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN round(p_retailprice * 2, 2) ELSE p_retailprice END AS price,
              CASE WHEN p_size > 25 THEN 2 ELSE 1 END AS version FROM part""",
)
def append_version_read_latest(t: Tables):
    path = shared_path(t.spark, "versions")
    first = t.part.select("p_partkey", col("p_retailprice").alias("price"), lit(1).alias("version"))
    first.write.parquet(path)
    second = t.part.filter("p_size > 25").select(
        "p_partkey", F.round(col("p_retailprice") * 2, 2).alias("price"), lit(2).alias("version")
    )
    second.write.mode("append").parquet(path)
    return latest_per_key(t.spark.read.parquet(path), ["p_partkey"], ["version"])


# Target: two thirds of the parts. Source: the even keys, with unknown prices for size 7.
TARGET_SQL = "tgt AS (SELECT p_partkey, p_size, p_retailprice AS price, 'load' AS touched FROM part WHERE p_partkey % 3 <> 0)"
SOURCE_SQL = """src AS (SELECT p_partkey, p_size, CASE WHEN p_size <> 7 THEN CASE WHEN p_size > 25 THEN round(p_retailprice * 1.05, 4)
                ELSE p_retailprice END END AS price FROM part WHERE p_partkey % 2 = 0)"""


def merge_target(t: Tables):
    return t.part.filter("p_partkey % 3 <> 0").select(
        "p_partkey", "p_size", col("p_retailprice").alias("price"), lit("load").alias("touched")
    )


def merge_source(t: Tables):
    price = when(col("p_size") > 25, F.round(col("p_retailprice") * 1.05, 4)).otherwise(col("p_retailprice"))
    known = when(col("p_size") != 7, price)
    return t.part.filter("p_partkey % 2 = 0").select("p_partkey", "p_size", known.alias("price"))


@query(
    "merge_upsert",
    f"""WITH {TARGET_SQL}, {SOURCE_SQL} SELECT COALESCE(s.p_partkey, t.p_partkey) AS p_partkey,
          CASE WHEN s.p_partkey IS NOT NULL THEN s.price ELSE t.price END AS price,
          CASE WHEN s.p_partkey IS NOT NULL THEN 'merge' ELSE t.touched END AS touched
        FROM tgt t FULL JOIN src s ON s.p_partkey = t.p_partkey""",
)
def merge_upsert(t: Tables):
    def apply(df):
        return merged_rows(merge(df, merge_source(t), ["p_partkey"]), {"touched": lit("merge")})

    target = table(t, "upsert", merge_target(t))
    target.replace(apply(target.read()))
    target.replace(apply(target.read()))  # a replay changes nothing
    return target.read().drop("p_size")


@query(
    "merge_delete_missing",
    f"WITH {TARGET_SQL}, {SOURCE_SQL} SELECT p_partkey, price, 'sync' AS touched FROM src",
)
def merge_delete_missing(t: Tables):
    synced = merge(merge_target(t), merge_source(t), ["p_partkey"], delete_missing=True)
    return merged_rows(synced, {"touched": lit("sync")}).drop("p_size")


@query(
    "merge_conditional",
    f"""WITH {TARGET_SQL}, {SOURCE_SQL} SELECT COALESCE(s.p_partkey, t.p_partkey) AS p_partkey,
          CASE WHEN s.p_partkey IS NOT NULL THEN s.price ELSE t.price END AS price,
          CASE WHEN t.p_partkey IS NULL OR (s.p_partkey IS NOT NULL AND s.price IS DISTINCT FROM t.price) THEN 'merge' ELSE t.touched END AS touched
        FROM tgt t FULL JOIN src s ON s.p_partkey = t.p_partkey""",
)
def merge_conditional(t: Tables):
    """Unchanged rows keep their stamp; a change to NULL counts as a change."""
    changed = merge(merge_target(t), merge_source(t), ["p_partkey"], only_changed=True)
    return merged_rows(changed, {"touched": lit("merge")}).drop("p_size")


@query(
    "merge_actions",
    f"""WITH {TARGET_SQL}, {SOURCE_SQL} SELECT CASE WHEN t.p_partkey IS NULL THEN 'INSERT' WHEN s.p_partkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action,
          COALESCE(s.p_partkey, t.p_partkey) AS p_partkey, t.price AS old_price, s.price AS new_price
        FROM tgt t FULL JOIN src s ON s.p_partkey = t.p_partkey
        WHERE t.p_partkey IS NULL OR s.p_partkey IS NULL OR t.price IS DISTINCT FROM s.price""",
)
def merge_actions(t: Tables):
    actions = merge(merge_target(t), merge_source(t), ["p_partkey"], only_changed=True, delete_missing=True)
    return actions.filter("action <> 'KEEP'").select(
        "action", F.coalesce("_s.p_partkey", "_t.p_partkey").alias("p_partkey"),
        col("_t.price").alias("old_price"), col("_s.price").alias("new_price"),
    )


@query(
    "merge_from_aggregate",
    """WITH a AS (SELECT o_custkey, COUNT(*) AS n, round(SUM(o_totalprice), 2) AS spend FROM orders GROUP BY 1)
       SELECT c_custkey, COALESCE(n, 0) AS orders, COALESCE(spend, 0.0) AS spend FROM customer LEFT JOIN a ON o_custkey = c_custkey""",
)
def merge_from_aggregate(t: Tables):
    summary = t.customer.select("c_custkey", lit(0).cast("bigint").alias("orders"), lit(0.0).alias("spend"))
    fresh = t.orders.groupBy(col("o_custkey").alias("c_custkey")).agg(
        rows().alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("spend")
    )
    return merged_rows(merge(summary, fresh, ["c_custkey"]))


@query(
    "scd1",
    """SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'PREMIUM' ELSE c_mktsegment END AS segment,
              CASE WHEN c_acctbal > 5000 THEN DATE '2024-06-01' ELSE DATE '2024-01-01' END AS modified FROM customer""",
)
def scd1(t: Tables):
    old_day, new_day = lit("2024-01-01").cast("date"), lit("2024-06-01").cast("date")
    dim = t.customer.select("c_custkey", col("c_mktsegment").alias("segment"), old_day.alias("modified"))
    segment = when(col("c_acctbal") > 5000, "PREMIUM").otherwise(col("c_mktsegment"))
    updates = t.customer.select("c_custkey", segment.alias("segment"))
    return merged_rows(merge(dim, updates, ["c_custkey"], only_changed=True), {"modified": new_day})


@query(
    "scd2",
    """WITH d AS (SELECT *, c_custkey % 10 <> 9 AS known, c_acctbal > 5000 AS moved FROM customer)
       SELECT c_custkey, c_mktsegment AS segment, DATE '2024-01-01' AS valid_from,
              CASE WHEN moved THEN DATE '2024-05-31' ELSE DATE '9999-12-31' END AS valid_to, NOT moved AS is_current FROM d WHERE known
       UNION ALL SELECT c_custkey, CASE WHEN moved THEN 'PREMIUM' ELSE c_mktsegment END, DATE '2024-06-01', DATE '9999-12-31', true
         FROM d WHERE moved OR NOT known""",
)
def scd2_query(t: Tables):
    dim = t.customer.filter("c_custkey % 10 <> 9").select(
        "c_custkey", col("c_mktsegment").alias("segment"), lit("2024-01-01").cast("date").alias("valid_from"),
        lit("9999-12-31").cast("date").alias("valid_to"), lit(True).alias("is_current"),
    )
    segment = when(col("c_acctbal") > 5000, "PREMIUM").otherwise(col("c_mktsegment"))
    updates = t.customer.select("c_custkey", segment.alias("segment"))
    return scd2(dim, updates, ["c_custkey"], ["segment"], "2024-06-01")


@query(
    "scd3",
    """SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'PREMIUM' ELSE c_mktsegment END AS segment,
              CASE WHEN c_acctbal > 5000 THEN c_mktsegment END AS previous_segment FROM customer""",
)
def scd3_query(t: Tables):
    dim = t.customer.select("c_custkey", col("c_mktsegment").alias("segment"))
    updates = t.customer.filter("c_acctbal > 5000").select("c_custkey", lit("PREMIUM").alias("segment"))
    return scd3(dim, updates, "c_custkey", "segment")


@query(
    "build_star_schema",
    """WITH p AS (SELECT p_partkey, ROW_NUMBER() OVER (ORDER BY p_partkey) AS product_key FROM part),
            c AS (SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_key FROM customer),
            s AS (SELECT s_suppkey, ROW_NUMBER() OVER (ORDER BY s_suppkey) AS supplier_key FROM supplier)
       SELECT product_key, customer_key, supplier_key, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, l_orderkey, l_linenumber,
              l_quantity AS quantity, round(l_extendedprice * (1 - l_discount), 4) AS amount
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN p ON l_partkey = p_partkey
       JOIN c ON o_custkey = c_custkey JOIN s ON l_suppkey = s_suppkey""",
)
def build_star_schema(t: Tables):
    """FactSales over surrogate keys of the product, customer, supplier and date dimensions."""
    product = surrogate_keys(t.part.select("p_partkey"), "p_partkey", "product_key")
    customer = surrogate_keys(t.customer.select("c_custkey"), "c_custkey", "customer_key")
    supplier = surrogate_keys(t.supplier.select("s_suppkey"), "s_suppkey", "supplier_key")
    return (
        t.lineitem.join(t.orders, col("l_orderkey") == col("o_orderkey"))
        .join(product, col("l_partkey") == col("p_partkey"))
        .join(customer, col("o_custkey") == col("c_custkey"))
        .join(supplier, col("l_suppkey") == col("s_suppkey"))
        .select(
            "product_key", "customer_key", "supplier_key",
            F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key"), "l_orderkey", "l_linenumber",
            col("l_quantity").alias("quantity"), F.round(net(), 4).alias("amount"),
        )
    )


@query(
    "flatten_snowflake",
    """SELECT c_custkey, c_name, n_name AS country, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey""",
)
def flatten_snowflake(t: Tables):
    places = t.nation.join(t.region, col("n_regionkey") == col("r_regionkey"))
    joined = t.customer.join(places, col("c_nationkey") == col("n_nationkey"))
    return joined.select("c_custkey", "c_name", col("n_name").alias("country"), col("r_name").alias("region"))


@query(
    "denormalize_lake",
    """SELECT year(o_orderdate) AS order_year, c_mktsegment AS segment, p_brand AS category, COUNT(*) AS lines, round(SUM(l_quantity), 2) AS qty
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""",
)
def denormalize_lake(t: Tables):
    """order_details_enriched: one wide table by year; the report then reads it without a join."""
    path = shared_path(t.spark, "order-details")
    wide = (
        t.lineitem.join(t.orders, col("l_orderkey") == col("o_orderkey"))
        .join(t.customer, col("o_custkey") == col("c_custkey"))
        .join(t.part, col("l_partkey") == col("p_partkey"))
        .select(
            big(F.year("o_orderdate")).alias("order_year"), "o_orderkey", col("c_mktsegment").alias("segment"),
            col("p_brand").alias("category"), "l_quantity", "l_extendedprice",
        )
    )
    spread_by(wide, "order_year").write.partitionBy("order_year").parquet(path)
    lake = t.spark.read.schema(wide.schema).parquet(path)
    return lake.groupBy("order_year", "segment", "category").agg(
        rows().alias("lines"), F.round(F.sum("l_quantity"), 2).alias("qty")
    )


@query(
    "surrogate_key",
    """WITH old AS (SELECT p_partkey, ROW_NUMBER() OVER (ORDER BY p_partkey) AS sk FROM part WHERE p_size <= 25)
       SELECT * FROM old UNION ALL SELECT p_partkey, (SELECT MAX(sk) FROM old) + ROW_NUMBER() OVER (ORDER BY p_partkey) FROM part WHERE p_size > 25""",
)
def surrogate_key(t: Tables):
    """Keys of a second load continue after the greatest key of the first."""
    old = surrogate_keys(t.part.filter("p_size <= 25").select("p_partkey"), "p_partkey", "sk")
    top = old.agg(F.max("sk")).scalar()
    new = surrogate_keys(t.part.filter("p_size > 25").select("p_partkey"), "p_partkey", "sk", top)
    return old.unionByName(new)


@query(
    "insert_defaults",
    "SELECT c_custkey, COALESCE(NULLIF(c_mktsegment, 'FURNITURE'), 'UNKNOWN') AS segment, true AS active, CAST(NULL AS VARCHAR) AS phone FROM customer",
)
def insert_defaults(t: Tables):
    segment = F.coalesce(F.nullif(col("c_mktsegment"), lit("FURNITURE")), lit("UNKNOWN"))
    return t.customer.select(
        "c_custkey", segment.alias("segment"), lit(True).alias("active"), lit(None).cast("string").alias("phone")
    )


@query(
    "schema_add_columns",
    "SELECT c_custkey, 'new' AS status, CAST(NULL AS TIMESTAMP) AS deleted_at, c_acctbal < 0 AS is_deleted FROM customer",
)
def schema_add_columns(t: Tables):
    """A default, a nullable audit column and a soft-delete flag."""
    added = t.customer.withColumns(
        {
            "status": lit("new"), "deleted_at": lit(None).cast("timestamp_ntz"), "is_deleted": col("c_acctbal") < 0,
        }
    )
    return added.select("c_custkey", "status", "deleted_at", "is_deleted")


@query("schema_drop_rename", "SELECT c_custkey AS customer_id, c_name AS name, c_acctbal AS balance FROM customer")
def schema_drop_rename(t: Tables):
    renamed = t.customer.drop("c_mktsegment", "c_nationkey")
    return renamed.withColumnsRenamed({"c_custkey": "customer_id", "c_name": "name", "c_acctbal": "balance"})


@query("schema_change_type", "SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size FROM part")
def schema_change_type(t: Tables):
    """Add a text column, copy with a cast, drop the old one, rename."""
    copied = t.part.withColumn("size_text", col("p_size").cast("string")).drop("p_size")
    return copied.withColumnRenamed("size_text", "p_size").select("p_partkey", "p_size")


@query(
    "schema_evolution_read",
    "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS priority FROM orders",
)
def schema_evolution_read(t: Tables):
    """Old files lack a column; read together it is NULL there."""
    path = shared_path(t.spark, "evolution")
    cut = lit("1998-01-01").cast("timestamp_ntz")
    t.orders.filter(col("o_orderdate") < cut).select("o_orderkey", "o_totalprice").write.parquet(f"{path}/v=1")
    newer = t.orders.filter(col("o_orderdate") >= cut)
    newer.select("o_orderkey", "o_totalprice", col("o_orderpriority").alias("priority")).write.parquet(f"{path}/v=2")
    return t.spark.read.option("mergeSchema", True).parquet(path).select("o_orderkey", "o_totalprice", "priority")


@query(
    "computed_column_persisted",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * (1 - l_discount), 4) AS line_total FROM lineitem",
)
def computed_column_persisted(t: Tables):
    path = shared_path(t.spark, "computed")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    stored = t.lineitem.select(*keys, F.round(net(), 4).alias("line_total"))
    stored.write.parquet(path)
    return t.spark.read.schema(stored.schema).parquet(path)


@query(
    "schema_version_log",
    """SELECT p_partkey, round(p_retailprice * 1.2, 4) AS gross, 'EUR' AS currency, 'load,add gross,add currency' AS applied FROM part""",
)
def schema_version_log(t: Tables):
    """Two migrations, each asked for twice and applied once."""
    target = table(t, "migrations", t.part.select("p_partkey", "p_retailprice"))
    steps = [
        ("add gross", lambda df: df.withColumn("gross", F.round(col("p_retailprice") * 1.2, 4))),
        ("add currency", lambda df: df.withColumn("currency", lit("EUR"))),
    ]
    for note, change in steps * 2:
        target.apply_once(note, change)
    return target.read().select("p_partkey", "gross", "currency", lit(",".join(target.notes())).alias("applied"))


@query(
    "lake_atomic_replace",
    "SELECT p_partkey, p_size FROM part WHERE p_size > 10 UNION ALL SELECT p_partkey + 1000000000, 0 FROM part WHERE p_size <= 10",
)
def lake_atomic_replace(t: Tables):
    """Delete old and insert new rows as one visible step."""
    stock = t.part.select("p_partkey", "p_size")
    fresh = stock.filter("p_size <= 10").select((col("p_partkey") + 1000000000).alias("p_partkey"), lit(0).alias("p_size"))
    return swapped(t, "atomic", stock, lambda df: df.filter("p_size > 10").unionByName(fresh))


@query(
    "summary_table_refresh",
    """SELECT year(o_orderdate) AS y, p_brand AS category, round(SUM(l_quantity), 2) AS qty, COUNT(*) AS lines,
              TIMESTAMP '2024-02-01 00:00:00' AS refreshed_at
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def summary_table_refresh(t: Tables, now: str = "2024-02-01 00:00:00"):
    """A gold table rewritten in full with its refresh time."""
    per = (
        t.lineitem.join(t.orders, col("l_orderkey") == col("o_orderkey"))
        .join(t.part, col("l_partkey") == col("p_partkey"))
        .groupBy(big(F.year("o_orderdate")).alias("y"), col("p_brand").alias("category"))
        .agg(F.round(F.sum("l_quantity"), 2).alias("qty"), rows().alias("lines"))
    )
    gold = table(t, "summary", per.withColumn("refreshed_at", lit(now).cast("timestamp_ntz")))
    return gold.read()


@query(
    "materialized_view_table",
    """SELECT l_partkey, round(SUM(l_extendedprice * (1 - l_discount)), 4) AS revenue, COUNT(*) AS lines FROM lineitem GROUP BY 1""",
)
def materialized_view_table(t: Tables):
    """Sum and count per product kept current by adding the sums of the new lines."""

    def per_part(df):
        return df.groupBy("l_partkey").agg(F.sum(net()).alias("revenue"), rows().alias("lines"))

    later = col("l_shipdate") >= lit("1998-07-01").cast("timestamp_ntz")
    view = table(t, "view", per_part(t.lineitem.filter(~later)))
    both = view.read().unionByName(per_part(t.lineitem.filter(later)))
    view.replace(both.groupBy("l_partkey").agg(F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines")))
    return view.read().withColumn("revenue", F.round("revenue", 4))
