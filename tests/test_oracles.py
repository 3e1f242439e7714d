"""Registered queries against their SQL twins on the smallest data.

ORACLE_TESTS=all runs every query; the default is a cross-section of all families.
"""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

PICKED = (
    "total_revenue", "avg_revenue", "maintain_sum_count", "select_distinct", "filter_three_valued", "product_search", "join_multiway",
    "join_band", "join_salted", "join_bloom_prefilter", "join_point_in_time", "join_interval_funnel", "not_in_null_safe",
    "quantified_all", "recursive_cycle_guard", "agg_rollup", "agg_cube", "win_rank_compare", "sessionize_lag", "rolling_30_days",
    "gaps_and_islands", "groups_frame", "symmetric_difference", "order_collation", "fn_local_to_utc", "fn_parse_iso_ts",
    "merge_upsert", "merge_actions", "scd2", "scd3", "schema_version_log", "read_csv_validated", "read_zipped_csv_slices",
    "detect_truncated_file", "split_to_daily_partitions", "etag_incremental_ingest", "window_session", "late_event_drop_count",
    "clicks_aggregate", "stream_dedup", "join_stream_stream", "doc_embed_order", "doc_category_fields", "text_search_terms",
    "graph_build_copurchase", "graph_triangle_cycle", "graph_pagerank", "graph_wcc", "consistent_hash_assign", "hash_slot_assign",
    "quorum_read_repair", "bloom_membership", "count_min_sketch", "vector_topk", "conversation_compact", "destructive_sql_scan",
    "metric_rate", "outage_intervals", "gh_collab_pairs", "fhv_duration_shift", "meter_segment_daily_avg", "dq_check", "dq_quarantine",
)
NAMES = sorted(entry.oracle_sql()) if os.environ.get("ORACLE_TESTS") == "all" else PICKED


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(name, spark, sf_dir, con):
    _, problems = compare(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name])
    assert not problems


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["day", "hour", "revenue"]


def test_every_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
