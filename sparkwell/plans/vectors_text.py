"""Vectors, text snippets, conversations, answer checks and catalog reports."""

from sparkwell.operators import vectors
from sparkwell.operators.ordered import running, with_group_stats, with_row_number
from sparkwell.plans.common import F, Tables, big, col, lit, query, rows
from sparkwell.session import cut_lineage
from sparkwell.tables import TABLE_NAMES

COS = "list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"


@query(
    "cosine_pairs",
    f"SELECT a.vec_id AS a, b.vec_id AS b, round({COS}, 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
)
def cosine_pairs(t: Tables):
    """Similarity of each vector with the next one."""
    a = t.embeddings.select(col("vec_id").alias("a"), col("embedding").alias("va"))
    b = t.embeddings.select((col("vec_id") - 1).alias("a"), col("vec_id").alias("b"), col("embedding").alias("vb"))
    return a.join(b, "a").select("a", "b", F.round(vectors.cosine(col("va"), col("vb")), 6).alias("cosine"))


def label_queries(t: Tables):
    """The first vector of each label asks."""
    firsts = t.embeddings.groupBy("label").agg(F.min_by(F.struct("vec_id", "embedding"), "vec_id").alias("q"))
    return vectors.query_list(firsts.select("q.vec_id", "q.embedding"), "vec_id", "embedding")


TOPK_SQL = f"""q AS (SELECT MIN(vec_id) AS query_id FROM embeddings GROUP BY label),
  d AS (SELECT query_id, b.vec_id, round(1 - {COS}, 9) AS distance FROM q JOIN embeddings a ON a.vec_id = query_id, embeddings b),
  k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS place FROM d)"""


@query("vector_topk", f"WITH {TOPK_SQL} SELECT query_id, vec_id, round(distance, 6) AS distance, place FROM k WHERE place <= 3")
def vector_topk(t: Tables):
    found = vectors.nearest(t.embeddings, "vec_id", "embedding", label_queries(t), 3)
    return found.withColumn("distance", F.round("distance", 6))


@query("vector_ann")
def vector_ann(t: Tables, k: int = 5, every: int = 50):
    """Approximate neighbours of every 50th vector, with the recall of all of them measured against the exact answer.

    No SQL twin: which neighbours are missed depends on the index. The tests hold the rows against all distances.
    """
    base = t.embeddings.select("vec_id", "embedding")
    queries = base.filter(col("vec_id") % every == 0)
    exact = cut_lineage(vectors.exact_nearest(base, queries, "vec_id", "embedding", k + 1), "ann-exact")
    index = vectors.CellIndex(base, "vec_id", "embedding", vectors.fit_cells(base, "vec_id", "embedding", k, queries=queries, exact=exact))
    found = cut_lineage(index.search(queries, "vec_id", "embedding", k), "ann-found")
    measured = vectors.recall_of(found, base, queries, "vec_id", "embedding", k, exact).select(F.round("recall", 6).alias("recall"))
    return found.crossJoin(F.broadcast(measured)).select("query_id", "vec_id", F.round("distance", 6).alias("distance"), "place", "recall")  # one row


@query(
    "embed_pending_rows",
    "SELECT doc_id, vec_id IS NULL AS was_pending, CAST(64 AS BIGINT) AS dims FROM documents LEFT JOIN embeddings ON vec_id = doc_id",
)
def embed_pending_rows(t: Tables):
    """Documents without a vector get one; the others keep theirs."""
    have = t.documents.join(t.embeddings, col("doc_id") == col("vec_id"), "left").select("doc_id", "text", "embedding")
    pending = have.filter("embedding IS NULL")
    filled = vectors.fill_vectors(pending, "doc_id", "text", vectors.letter_embedder(64))
    merged = (
        have.filter("embedding IS NOT NULL").select("doc_id", lit(False).alias("was_pending"), "embedding")
        .unionByName(filled.select("doc_id", lit(True).alias("was_pending"), "embedding"))
    )
    return merged.select("doc_id", "was_pending", big(F.size("embedding")).alias("dims"))


@query(
    "embedding_cost",
    """SELECT lang, COUNT(*) AS docs, CAST(SUM(len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> ''))) AS BIGINT) AS words,
              round(SUM(len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> ''))) * 1.3 * 0.02 / 1000000, 8) AS cost FROM documents GROUP BY 1""",
)
def embedding_cost(t: Tables, price: float = 0.02):
    """Words x 1.3 tokens x price per million."""
    words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    totals = t.documents.groupBy("lang").agg(rows().alias("docs"), F.sum(words).alias("words"))
    return totals.withColumn("cost", F.round(col("words") * 1.3 * price / 1000000, 8))


@query(
    "knowledge_snippets",
    f"""WITH {TOPK_SQL} SELECT query_id, place, doc_id, split_part(text, ' ', 1) AS title, substring(text, 1, 300) AS body, round(distance, 3) AS distance
        FROM k JOIN documents ON doc_id = vec_id WHERE place <= 3""",
)
def knowledge_snippets(t: Tables):
    found = vectors.nearest(t.embeddings, "vec_id", "embedding", label_queries(t), 3)
    joined = t.documents.join(F.broadcast(found), col("doc_id") == col("vec_id"))  # three rows per query
    return joined.select(
        "query_id", "place", "doc_id", F.split_part("text", lit(" "), lit(1)).alias("title"),
        F.substring("text", 1, 300).alias("body"), F.round("distance", 3).alias("distance"),
    )


@query(
    "history_growth",
    """SELECT conv_id, turn, CAST(SUM(length(text) + 4) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS history_size
       FROM conversations""",
)
def history_growth(t: Tables):
    """Characters stand for tokens, plus four per message."""
    sized = t.conversations.select("conv_id", "turn", big(F.length("text") + 4).alias("s"))
    return running(sized, ["conv_id"], [("turn", "asc")], {"history_size": ("sum", col("s"))}).drop("s")


COMPACT_SQL = """WITH m AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) AS rn, COUNT(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
  f AS (SELECT *, n > 5 AND rn > 1 AND rn <= n - 4 AS folded FROM m)
  SELECT conv_id, turn, role, text FROM f WHERE NOT folded
  UNION ALL SELECT conv_id, MIN(turn), 'system', string_agg('[' || role || '] ' || substring(text, 1, 400), chr(10) ORDER BY rn) FROM f WHERE folded
    GROUP BY conv_id"""


@query("conversation_compact", COMPACT_SQL)
def conversation_compact(t: Tables, keep: int = 4):
    """Head and last messages stay; the middle becomes one system note, 400 characters a message."""
    numbered = with_row_number(t.conversations, ["conv_id"], [("turn", "asc")])
    sized = with_group_stats(numbered, ["conv_id"], n=rows())
    folded = (col("n") > keep + 1) & (col("rn") > 1) & (col("rn") <= col("n") - keep)
    kept = sized.filter(~folded).select("conv_id", "turn", "role", "text")
    note = F.concat(lit("["), "role", lit("] "), F.substring("text", 1, 400))
    notes = sized.filter(folded).groupBy("conv_id").agg(
        F.min("turn").alias("turn"), F.sort_array(F.collect_list(F.struct("rn", note.alias("t")))).alias("l")
    )
    text = F.array_join(F.transform("l", lambda x: x["t"]), "\n")
    return kept.unionByName(notes.select("conv_id", "turn", lit("system").alias("role"), text.alias("text")))


@query(
    "answer_eval",
    """WITH c AS (SELECT a.conv_id, a.turn, upper(a.text) AS answer, string_split(upper(u.text), ' ')[1:2] AS must FROM conversations a
                  JOIN conversations u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1 WHERE a.role = 'assistant' AND u.role = 'user'),
            r AS (SELECT conv_id, turn, len(list_filter(must, lambda w: NOT contains(answer, w))) = 0 AS passed FROM c)
       SELECT *, round(AVG(CASE WHEN passed THEN 1.0 ELSE 0.0 END) OVER (), 6) AS pass_rate FROM r""",
)
def answer_eval(t: Tables):
    """An answer passes when it holds the first two words of the question before it."""
    a = t.conversations.filter("role = 'assistant'").select("conv_id", "turn", F.upper("text").alias("answer"))
    u = t.conversations.filter("role = 'user'").select(
        "conv_id", (col("turn") + 1).alias("turn"), F.slice(F.split(F.upper("text"), " "), 1, 2).alias("must")
    )
    passed = F.forall("must", lambda w: F.contains(col("answer"), w))
    cases = a.join(u, ["conv_id", "turn"]).select("conv_id", "turn", passed.alias("passed"))
    rate = F.round(F.avg(col("passed").cast("double")), 6)
    return with_group_stats(cases, [], pass_rate=rate)


# Statement keywords that write (fixed list).
WRITE_WORDS = (
    "INSERT ", "UPDATE ", "DELETE ", "DROP ", "TRUNCATE ", "ALTER ", "CREATE ", "GRANT ", "REVOKE ", "COMMIT ", "ROLLBACK ",
)


def is_destructive(text):
    """Comments are blanked out first; then any write keyword followed by a space counts."""
    plain = F.regexp_replace(F.regexp_replace(text, r"(?s)/\*.*?\*/", " "), r"--[^\n]*", " ")
    upper = F.concat(lit(" "), F.upper(plain), lit(" "))
    cond = lit(False)
    for word in WRITE_WORDS:
        cond = cond | F.contains(upper, lit(word))
    return cond


LOG_SQL = """CASE event_type WHEN 'view' THEN 'SELECT * FROM film WHERE id = ' || user_id WHEN 'click' THEN 'delete from rental where id < ' || user_id
  WHEN 'purchase' THEN 'SELECT 1 /* DROP TABLE t' || user_id || ' */' WHEN 'signup' THEN 'SELECT ' || user_id || ' -- DROP TABLE x' || chr(10) || 'FROM t'
  ELSE 'WITH c AS (DELETE FROM rental RETURNING *) SELECT ' || user_id END"""


@query("destructive_sql_scan", f"SELECT event_id, event_type IN ('click', 'error') AS destructive, length({LOG_SQL}) AS chars FROM events")
def destructive_sql_scan(t: Tables):
    """A query log scanned for write statements."""
    log = t.events.select("event_id", F.expr(LOG_SQL.replace("chr(10)", "'\\n'")).alias("sql_text"))
    return log.select("event_id", is_destructive(col("sql_text")).alias("destructive"), big(F.length("sql_text")).alias("chars"))


CATALOG_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "array<float>": "FLOAT[]"}


CATALOG_COLUMNS = {
    "region": "r_regionkey INTEGER, r_name VARCHAR", "nation": "n_nationkey INTEGER, n_name VARCHAR, n_regionkey INTEGER",
    "customer": "c_custkey BIGINT, c_name VARCHAR, c_nationkey INTEGER, c_acctbal DOUBLE, c_mktsegment VARCHAR",
    "supplier": "s_suppkey BIGINT, s_name VARCHAR, s_nationkey INTEGER, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name VARCHAR, p_brand VARCHAR, p_type VARCHAR, p_size INTEGER, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority VARCHAR",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, "
    "l_tax DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR",
    "documents": "doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding FLOAT[], label INTEGER", "pages": "page_id BIGINT, url VARCHAR, html VARCHAR",
    "benchmark": "item_id BIGINT, text VARCHAR", "labels": "doc_id BIGINT, quality INTEGER, toxic INTEGER",
    "conversations": "conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR",
}


def catalog_sql():
    parts = [
        f"SELECT '{t}' AS table_name, {i} AS place, '{c}' AS column_name, '{ty}' AS data_type, COUNT({c}) < COUNT(*) AS nullable, COUNT({c}) AS non_null, NULL AS error FROM {t}"
        for t, cols in CATALOG_COLUMNS.items() for i, (c, ty) in enumerate((x.split(" ") for x in cols.split(", ")), 1)
    ]
    return " UNION ALL ".join([*parts, "SELECT 'payment', NULL, NULL, NULL, NULL, NULL, 'no such table: payment'"])


CATALOG = "table_name STRING, place INT, column_name STRING, data_type STRING, nullable BOOLEAN, non_null BIGINT, error STRING"


@query("schema_catalog", catalog_sql())
def schema_catalog(t: Tables, wanted: tuple[str, ...] = (*TABLE_NAMES, "payment")):
    """Columns of each wanted table in order, their types, filled rows and whether any row lacks them; an unknown table is a row with the error.

    Files declare every column nullable, so this is counted: one scan a table, that of text columns included.
    """
    out = t.spark.createDataFrame([], CATALOG)
    for table in wanted:
        if table not in TABLE_NAMES:
            unknown = (table, None, None, None, None, None, f"no such table: {table}")
            out = out.unionByName(t.spark.createDataFrame([unknown], CATALOG))
            continue
        df = getattr(t, table)
        counts = df.agg(rows().alias("all_rows"), *[F.count(c).alias(c) for c in df.columns])
        entries = F.array(*[
            F.struct(
                lit(table).alias("table_name"), lit(i).alias("place"), lit(c).alias("column_name"), lit(CATALOG_TYPES.get(ty, ty)).alias("data_type"),
                (col(c) < col("all_rows")).alias("nullable"), col(c).alias("non_null"), lit(None).cast("string").alias("error"),
            )
            for i, (c, ty) in enumerate(df.dtypes, 1)
        ])
        out = out.unionByName(counts.select(F.inline(entries)))
    return out


@query(
    "bounded_result",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice, true AS truncated
       FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50)""",
)
def bounded_result(t: Tables, limit: int = 50):
    """At most fifty rows as text, with a flag that more exist."""
    ordered = t.orders.select("o_orderkey", "o_totalprice").orderBy(col("o_totalprice").desc(), "o_orderkey")
    more = ordered.limit(limit + 1)
    flag = more.agg(rows() > limit).scalar()
    return ordered.limit(limit).select(
        col("o_orderkey").cast("string").alias("o_orderkey"), col("o_totalprice").cast("string").alias("o_totalprice"),
        flag.alias("truncated"),
    )
