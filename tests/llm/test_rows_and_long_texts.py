"""Rows that share ids or have none, and texts that are long."""

import time

from pyspark.sql import functions as F

from sparkwell.llm import jaccard_join, language_id, secret_scan
from sparkwell.llm.queries import ORACLES

BASE = " ".join(f"w{i}" for i in range(100))
NEAR = BASE.replace("w50 ", "other ")
FAR = " ".join(f"v{i}" for i in range(100))
SCHEMA = "doc_id bigint, text string, n_chars bigint, source string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, len(t or ""), "s") for i, t in rows], SCHEMA)


def test_a_clean_text_under_a_removed_id_stays(spark):
    docs = table(spark, [(7, FAR), (3, BASE), (7, NEAR)])
    assert sorted((r["doc_id"], r["text"]) for r in jaccard_join.nearest_removed(docs).collect()) == [(3, BASE), (7, FAR)]


def test_near_copies_under_one_id(spark):
    kept = jaccard_join.nearest_removed(table(spark, [(3, BASE), (3, NEAR), (4, FAR), (4, FAR)])).collect()
    assert len([r for r in kept if r["doc_id"] == 3]) == 1 and len([r for r in kept if r["doc_id"] == 4]) == 2


def test_rows_without_ids_link(spark):
    """A set that only nameless rows have is compared, also where it is the link of a chain."""
    third = NEAR.replace("w20 ", "another ").replace("w80 ", "more ")
    docs = table(spark, [(5, BASE), (None, NEAR), (9, third), (None, FAR), (None, FAR.replace("v9 ", "u ")), (None, "")])
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == [(-1, -1), (-1, -1), (-1, -1), (-1, 5), (5, 5), (9, 5)]
    kept = [(r["doc_id"], r["text"]) for r in jaccard_join.nearest_removed(docs).collect()]
    assert (5, BASE) in kept and (None, "") in kept and len(kept) == 3


def test_copies_without_shared_ids(spark):
    docs = table(spark, [(i, BASE) for i in range(40)] + [(None, BASE)] * 3)
    assert [r["doc_id"] for r in jaccard_join.nearest_removed(docs).collect()] == [0]


def test_secret_scan_of_long_runs_is_linear(spark):
    letters = "abcdefghij" * 100_000
    texts = [
        "see http://x " + letters, letters + "://u:secret99word@h", "eyJ" * 300_000 + " http://", "://" + "u" * 1_000_000 + ":" + "p" * 1_000_000,
        "token " * 100_000 + "token=abcdef123456", "token" + " " * 1_000_000 + "x",
    ]
    begin = time.time()
    got = {r["doc_id"]: r for r in secret_scan.scan_secrets(table(spark, list(enumerate(texts))), F.col("source"), F.col("source")).collect()}
    assert time.time() - begin < 60
    assert [got[i]["n_assign"] for i in range(6)] == [0, 0, 0, 0, 1, 0]
    assert got[1]["spans"] == f"login:{1_000_000 - 16}:{1_000_000 + 18}"


def test_no_value_is_stored(spark, monkeypatch):
    """Candidate values leave the texts as hashes only."""
    kept = []
    real = secret_scan.stored
    monkeypatch.setattr(secret_scan, "stored", lambda df, label, *a: kept.append(real(df, label, *a)) or kept[-1])
    secret_scan.scan_secrets(table(spark, [(1, "password=hunter2hunter2")]), F.col("source"), F.col("source")).collect()
    assert kept and not any("hunter2" in str(r) for df in kept for r in df.collect())


def test_documents_without_language_go(spark):
    docs = table(spark, [(1, "the of and"), (2, "123 !"), (3, None), (4, ""), (None, "été"), (1, "the of and")])
    model = language_id.learn(docs.withColumn("lang", F.lit("en")), F.lit(True))
    kept = language_id.without_language_removed(docs, model)
    assert kept.schema == docs.schema
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, "été"), (1, "the of and"), (1, "the of and")]
    assert language_id.without_language_removed(docs.filter("doc_id = 99"), model).collect() == []


def test_twin_has_the_patterns():
    assert all(k.pattern.replace("'", "''") in ORACLES["op10_secret_scan"] for k in secret_scan.KINDS)
