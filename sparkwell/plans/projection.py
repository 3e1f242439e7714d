"""Projections, filters and predicates."""

from sparkwell.functions.predicates import guarded_flag, search_filter
from sparkwell.plans.common import F, Tables, big, col, lit, query, rows, when


@query("select_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def select_columns(t: Tables):
    return t.customer.select("c_custkey", "c_name", "c_mktsegment")


@query("column_alias", 'SELECT p_partkey AS id, p_name AS "Product Name", p_retailprice AS price FROM part')
def column_alias(t: Tables):
    return t.part.select(
        col("p_partkey").alias("id"), col("p_name").alias("Product Name"), col("p_retailprice").alias("price")
    )


@query("computed_column", "SELECT p_partkey, round(p_retailprice * p_size, 2) AS inventory_value FROM part")
def computed_column(t: Tables):
    return t.part.select("p_partkey", F.round(col("p_retailprice") * col("p_size"), 2).alias("inventory_value"))


@query(
    "alias_reuse",
    """WITH v AS (SELECT p_partkey, round(p_retailprice * p_size, 2) AS value FROM part)
       SELECT p_partkey, value, value > 25000 AS is_large FROM v WHERE value > 1000""",
)
def alias_reuse(t: Tables):
    value = t.part.select("p_partkey", F.round(col("p_retailprice") * col("p_size"), 2).alias("value"))
    return value.filter(col("value") > 1000).withColumn("is_large", col("value") > 25000)


@query("select_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def select_distinct(t: Tables):
    return t.part.select("p_brand", "p_type").distinct()


@query(
    "case_bucket",
    """SELECT p_partkey, p_size, CASE WHEN p_size < 20 THEN 'Budget' WHEN p_size < 50 THEN 'Standard'
       ELSE 'Premium' END AS tier FROM part""",
)
def case_bucket(t: Tables):
    tier = when(col("p_size") < 20, "Budget").when(col("p_size") < 50, "Standard").otherwise("Premium")
    return t.part.select("p_partkey", "p_size", tier.alias("tier"))


@query(
    "null_propagation",
    """WITH x AS (SELECT p_partkey, p_size, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size END AS on_order FROM part)
       SELECT p_partkey, p_size + on_order AS plain_sum, p_size + COALESCE(on_order, 0) AS safe_sum FROM x""",
)
def null_propagation(t: Tables):
    on_order = when(col("p_size") % 7 != 0, col("p_size"))
    return t.part.select(
        "p_partkey",
        (col("p_size") + on_order).alias("plain_sum"),
        (col("p_size") + F.coalesce(on_order, lit(0))).alias("safe_sum"),
    )


@query(
    "contact_directory",
    """SELECT DISTINCT c_name || ' (' || n_name || ')' AS contact, c_mktsegment AS segment
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 0 WHERE n_name IS NOT NULL""",
)
def contact_directory(t: Tables):
    nation = t.nation.filter(col("n_regionkey") != 0)
    joined = t.customer.join(nation, col("c_nationkey") == col("n_nationkey"), "left")
    return (
        joined.filter(col("n_name").isNotNull())
        .select(F.concat("c_name", lit(" ("), "n_name", lit(")")).alias("contact"), col("c_mktsegment").alias("segment"))
        .distinct()
    )


@query("filter_compare", "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice >= 950 AND p_size <> 10")
def filter_compare(t: Tables):
    return t.part.filter((col("p_retailprice") >= 950) & (col("p_size") != 10)).select("p_partkey", "p_retailprice")


@query("filter_between", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20")
def filter_between(t: Tables):
    return t.part.filter(col("p_size").between(10, 20)).select("p_partkey", "p_size")


@query("filter_in", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def filter_in(t: Tables):
    return t.customer.filter(col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@query(
    "filter_like",
    "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 'RED%' OR p_name ILIKE '%bolt%' OR p_type LIKE '_____'",
)
def filter_like(t: Tables):
    wanted = col("p_name").ilike("RED%") | col("p_name").ilike("%bolt%") | col("p_type").like("_____")
    return t.part.filter(wanted).select("p_partkey", "p_name")


@query("filter_like_class", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^[rsb]')")
def filter_like_class(t: Tables):
    return t.part.filter(col("p_name").rlike("^[rsb]")).select("p_partkey", "p_name")


@query(
    "filter_any_pattern",
    "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' OR p_name LIKE '%widget%' OR p_name LIKE '%gear%'",
)
def filter_any_pattern(t: Tables):
    return t.part.filter("p_name LIKE ANY ('%ring%', '%widget%', '%gear%')").select("p_partkey", "p_name")


@query(
    "filter_null",
    """WITH x AS (SELECT c_custkey, NULLIF(c_mktsegment, 'FURNITURE') AS segment FROM customer)
       SELECT CASE WHEN segment IS NULL THEN 'missing' ELSE 'known' END AS state,
              segment IS NOT DISTINCT FROM NULL AS null_safe_match, COUNT(*) AS n FROM x GROUP BY 1, 2""",
)
def filter_null(t: Tables):
    x = t.customer.select(F.nullif(col("c_mktsegment"), lit("FURNITURE")).alias("segment"))
    state = when(col("segment").isNull(), "missing").otherwise("known")
    match = col("segment").eqNullSafe(lit(None))
    return x.groupBy(state.alias("state"), match.alias("null_safe_match")).agg(rows().alias("n"))


@query(
    "filter_in_or_null",
    """WITH x AS (SELECT c_custkey, NULLIF(c_mktsegment, 'FURNITURE') AS segment FROM customer)
       SELECT * FROM x WHERE segment IN ('BUILDING') OR segment IS NULL""",
)
def filter_in_or_null(t: Tables):
    x = t.customer.select("c_custkey", F.nullif(col("c_mktsegment"), lit("FURNITURE")).alias("segment"))
    return x.filter(col("segment").isin("BUILDING") | col("segment").isNull())


@query(
    "filter_boolean",
    """SELECT p_partkey, p_type = 'PROMO' OR p_type = 'LARGE' AND p_size > 25 AS unparenthesised,
              (p_type = 'PROMO' OR p_type = 'LARGE') AND p_size > 25 AS parenthesised FROM part""",
)
def filter_boolean(t: Tables):
    promo, large, high = col("p_type") == "PROMO", col("p_type") == "LARGE", col("p_size") > 25
    return t.part.select(
        "p_partkey", (promo | (large & high)).alias("unparenthesised"), ((promo | large) & high).alias("parenthesised")
    )


@query(
    "filter_three_valued",
    """WITH x AS (SELECT p_partkey, NULLIF(p_size, 13) AS stock FROM part)
       SELECT 'plain' AS rule, COUNT(*) AS n FROM x WHERE stock > 10
       UNION ALL SELECT 'compared_with_null', COUNT(*) FROM x WHERE stock > CAST(NULL AS INTEGER)
       UNION ALL SELECT 'coalesced', COUNT(*) FROM x WHERE COALESCE(stock, 99) > 10""",
)
def filter_three_valued(t: Tables):
    stock = F.nullif(col("p_size"), lit(13))
    counts = t.part.agg(
        F.count_if(stock > 10).alias("plain"),
        F.count_if(stock > lit(None).cast("int")).alias("compared_with_null"),
        F.count_if(F.coalesce(stock, lit(99)) > 10).alias("coalesced"),
    )
    return counts.unpivot([], ["plain", "compared_with_null", "coalesced"], "rule", "n")


@query(
    "filter_sargable_range",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, o_totalprice FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""",
)
def filter_sargable_range(t: Tables):
    in_1997 = (col("o_orderdate") >= lit("1997-01-01").cast("timestamp_ntz")) & (
        col("o_orderdate") < lit("1998-01-01").cast("timestamp_ntz")
    )
    return t.orders.filter(in_1997).select("o_orderkey", F.to_date("o_orderdate").alias("order_day"), "o_totalprice")


@query(
    "filter_guarded_udf",
    """SELECT doc_id, n_chars FROM documents
       WHERE lang = 'en' AND length(text) - length(replace(text, 'the', '')) >= 3 * 5""",
)
def filter_guarded_udf(t: Tables):
    """The costly predicate sees only rows that pass the cheap one."""
    cheap = col("lang") == "en"
    return t.documents.filter(guarded_flag(cheap, col("text"))).select("doc_id", "n_chars")


@query("filter_collation", "SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) = 'building'")
def filter_collation(t: Tables):
    return t.customer.filter("c_mktsegment COLLATE UTF8_LCASE = 'building'").select("c_custkey", "c_mktsegment")


@query(
    "product_search",
    """SELECT 'both' AS mode, p_partkey, p_name FROM part WHERE p_type = 'PROMO' AND contains(lower(p_name), 'red')
       UNION ALL SELECT 'category', p_partkey, p_name FROM part WHERE p_type = 'PROMO'
       UNION ALL SELECT 'text', p_partkey, p_name FROM part WHERE contains(lower(p_name), 'red')
       UNION ALL SELECT 'none', p_partkey, p_name FROM part""",
)
def product_search(t: Tables):
    """All four forms in one scan: each row lists the forms that keep it."""
    forms = {
        "both": search_filter(category="PROMO", q="RED"),
        "category": search_filter(category="PROMO"),
        "text": search_filter(q="RED"),
        "none": search_filter(),
    }
    modes = F.array_compact(F.array(*[when(cond, name) for name, cond in forms.items()]))
    return t.part.select(F.explode(modes).alias("mode"), "p_partkey", "p_name")


@query(
    "filter_complex_product",
    """SELECT p_partkey, p_name, p_retailprice, CAST(p_size AS BIGINT) AS stock FROM part
       WHERE p_type <> 'ECONOMY' AND p_retailprice BETWEEN 920 AND 980
         AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND p_size > 5""",
)
def filter_complex_product(t: Tables):
    kept = (
        t.part.filter(col("p_type") != "ECONOMY")
        .filter(col("p_retailprice").between(920, 980))
        .filter(col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"))
        .filter(col("p_size") > 5)
    )
    return kept.select("p_partkey", "p_name", "p_retailprice", big(col("p_size")).alias("stock")).orderBy(
        col("p_retailprice").desc(), "p_partkey"
    )
