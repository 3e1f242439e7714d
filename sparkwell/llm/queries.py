"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell.llm.common import fold
from sparkwell.llm.exact_dedup import find_copies
from sparkwell.llm.hard_negatives import mine
from sparkwell.llm.html_extract import extract, learn as learn_pages
from sparkwell.llm.jaccard_join import jaccard_components
from sparkwell.llm.language_id import identify, learn as learn_languages
from sparkwell.llm.lm_score import score_texts
from sparkwell.llm.packing import pack
from sparkwell.llm.piece_codec import round_trip
from sparkwell.llm.quality_rules import MAX_REPEATED_PERCENT, MIN_WORDS, RULES, STOP_WORDS, SYMBOLS, measure
from sparkwell.llm.secret_scan import KINDS, LIVE_DISTINCT, LIVE_LENGTH, MAX_OWNERS, MAX_REPOSITORIES, scan_secrets
from sparkwell.llm.spelling import variant_groups
from sparkwell.llm.token_files import read_token_files, write_token_files
from sparkwell.llm.tokens import tokenizer_path
from sparkwell.llm.toxicity import learn, score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; the caller's session settings stay as they are."""

    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold("doc_id", 3) != 1)
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted", F.size("hits").alias("n_hits"))


@query(
    "op2_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
)
def op2_exact_dedup(spark, sf_dir):
    return find_copies(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op3_language_id")
def op3_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = identify(docs, learn_languages(docs, fold("doc_id", 4) != 2))
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", F.size("mixture").alias("n_languages"))


@query("op4_lm_score")
def op4_lm_score(spark, sf_dir):
    scored = score_texts(documents(spark, sf_dir), fold("doc_id", 7) != 2, fold("doc_id", 11) == 3)
    return scored.withColumn("held_out", ~F.col("train")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op5_ngram_jaccard_join")
def op5_ngram_jaccard_join(spark, sf_dir):
    return jaccard_components(documents(spark, sf_dir))


@query("op6_piece_codec")
def op6_piece_codec(spark, sf_dir):
    return round_trip(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def _quality_sql() -> str:
    stops = "|".join(dict.fromkeys(STOP_WORDS))
    limits = " AND ".join(
        f"coalesce({r.over} / nullif({r.under}, 0) BETWEEN {r.least if r.least > float('-inf') else -1e300} AND {r.most if r.most < float('inf') else 1e300}, true)"
        for r in RULES
    )
    symbols = "".join("\\" + c for c in SYMBOLS)
    return rf"""
    WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
        FROM documents
    ),
    each_word AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i FROM texts),
    starts AS (
        SELECT doc_id, i, [t, lead(t, 1) OVER o, lead(t, 2) OVER o, lead(t, 3) OVER o, lead(t, 4) OVER o] AS five
        FROM each_word WINDOW o AS (PARTITION BY doc_id ORDER BY i)
    ),
    windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM starts WHERE five[5] IS NOT NULL),
    steps AS (SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS step FROM windows WHERE n > 1),
    repeated AS (SELECT doc_id, sum(step)::BIGINT AS n_repeat_words FROM steps GROUP BY doc_id),
    measured AS (
        SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
               length(text) - length(regexp_replace(text, '[{symbols}]', '', 'g')) AS n_symbols,
               (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(l)::BIGINT AS n_lines,
               len([x for x in w if regexp_matches(lower(x), '^(?:{stops})(?:[.,;:!?]|$)')])::BIGINT AS n_stop_words,
               (len(w) - len([x for x in w if regexp_matches(x, '^[^\p{{L}}]+$')]))::BIGINT AS n_plain_words
        FROM texts LEFT JOIN repeated USING (doc_id)
    ),
    judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM measured)
    SELECT *, NOT base_failed AND {limits} AS kept FROM judged
    """


@query("op7_quality_rules", _quality_sql())
def op7_quality_rules(spark, sf_dir):
    return measure(documents(spark, sf_dir))


@query("op8_token_files")
def op8_token_files(spark, sf_dir):
    return read_token_files(write_token_files(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json")))


@query("op9_packing")
def op9_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def _secret_sql() -> str:
    found = " UNION ALL ".join(
        f"""
        SELECT doc_id, source, lang, {i} AS kind, {k.least} AS least,
               string_split_regex(text, '{k.pattern.replace("'", "''")}') AS pieces,
               regexp_extract_all(text, '{k.pattern.replace("'", "''")}', 0) AS matches,
               regexp_extract_all(text, '{k.pattern.replace("'", "''")}', {k.group}) AS vals
        FROM texts WHERE regexp_matches(text, '{k.pattern.replace("'", "''")}')
        """
        for i, k in enumerate(KINDS)
    )
    names = ", ".join(f"'{k.name}'" for k in KINDS)
    base = sum(k.base for k in KINDS)
    return f"""
    WITH texts AS (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents),
    found AS ({found}),
    each_one AS (
        SELECT doc_id, source, lang, kind, least, i, pieces[i] AS piece, matches[i] AS match, vals[i] AS value
        FROM (SELECT *, unnest(generate_series(1, len(matches))) AS i FROM found)
    ),
    placed AS (
        SELECT *, sum(length(piece) + length(match)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM each_one
    ),
    spans AS (
        SELECT doc_id, source, lang, kind, stop - length(match) AS start, stop, value FROM placed WHERE length(value) >= least
    ),
    owned AS (
        SELECT value, count(DISTINCT source) AS owners, count(DISTINCT source || '/' || lang) AS repositories FROM spans GROUP BY value
    ),
    judged AS (
        SELECT doc_id, kind, start, stop,
               CASE WHEN owners > {MAX_OWNERS} OR repositories > {MAX_REPOSITORIES} THEN 'example'
                    WHEN length(value) >= {LIVE_LENGTH} AND regexp_matches(value, '[0-9]')
                         AND len(list_distinct(string_split(value, ''))) >= {LIVE_DISTINCT} THEN 'live'
                    ELSE 'weak' END AS verdict,
               [{names}][kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT AS said
        FROM spans JOIN owned USING (value)
    ),
    by_doc AS (
        SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
               count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (verdict = 'live') AS n_live,
               count(*) FILTER (verdict = 'example') AS n_example,
               string_agg(said, ',' ORDER BY start, kind) FILTER (kind < {base}) AS base,
               string_agg(said, ',' ORDER BY start, kind) AS spans
        FROM judged WHERE kind < {base} OR verdict = 'live' GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
           coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
    FROM texts LEFT JOIN by_doc USING (doc_id)
    """


@query("op10_secret_scan", _secret_sql())
def op10_secret_scan(spark, sf_dir):
    """A source owns its documents; its documents of one language are a repository."""
    return scan_secrets(documents(spark, sf_dir), F.concat_ws("/", "source", "lang"), F.col("source"))


@query("op11_spelling_variants")
def op11_spelling_variants(spark, sf_dir):
    return variant_groups(documents(spark, sf_dir)).select("word", "n", "n_near", "form", "form_n", "root")


_NEGATIVES_SQL = """
    WITH part AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len([1 FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    ),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
        FROM part a JOIN part b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
    ),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
        SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    ) WHERE rank <= 3
    """


@query("op12_hard_negatives", _NEGATIVES_SQL)
def op12_hard_negatives(spark, sf_dir):
    rows = mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@query("op13_html_extraction")
def op13_html_extraction(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, learn_pages(pages)).select("page_id", "url", "text", "n_chars")
