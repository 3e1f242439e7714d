"""Order documents of more items than one page holds."""

from types import SimpleNamespace

import pytest

from sparkwell.plans import nested


@pytest.fixture(scope="module")
def large(spark):
    """Order 1: 1,500 lines of 100.0, a large quantity on its first page and a listed product on its second; order 2: a bad quantity on its last line."""
    lines = [(1, i, 3 if i == 1400 else 10, 1, 50.0 if i == 5 else 1.0, 100.0) for i in range(1, 1501)]
    lines += [(2, i, 10, 1, 0.5 if i == 1200 else 1.0, 10.0) for i in range(1, 1201)]
    return SimpleNamespace(
        spark=spark,
        lineitem=spark.createDataFrame(lines, "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE"),
        orders=spark.createDataFrame([(1, 7, "O", "2024-01-01"), (2, 7, "F", "2024-01-01")], "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate STRING"),
        customer=spark.createDataFrame([(7, "c7", "BUILDING")], "c_custkey BIGINT, c_name STRING, c_mktsegment STRING"),
    )


def test_find_tests_the_whole_order(large):
    assert [tuple(r) for r in nested.doc_find(large).collect()] == [(1, "c7", "O")]


def test_validation_has_one_row_per_order(large):
    assert sorted(map(tuple, nested.doc_schema_validate(large).collect())) == [(1, "ok", ""), (2, "error", "quantity")]


def test_pages_carry_the_totals_of_the_order(large):
    found = nested.doc_embed_order(large).filter("order_id = 1").orderBy("page").collect()
    assert [(r["page"], r["n_items"], r["amount"], len(r["items"].split(","))) for r in found] == [(0, 1500, 150000.0, 1000), (1, 1500, 150000.0, 500)]
