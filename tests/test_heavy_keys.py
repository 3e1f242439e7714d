"""Dense bands and heavy join keys against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from sparkwell.operators.joins import band_counts, salted_join


def test_band_counts_against_every_pair(spark):
    rnd = random.Random(1)
    values = [round(rnd.choice([rnd.uniform(0, 30), rnd.randint(0, 6) * 2.5]), 2) for _ in range(300)] + [10.0] * 200 + [None, -3.5]
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, v double").repartition(5)
    got = {r["id"]: r["near"] for r in band_counts(df, "v", 2.5, "near").collect()}
    assert got == {i: None if v is None else sum(w is not None and abs(round(v - w, 6)) <= 2.5 for w in values) - 1 for i, v in enumerate(values)}
    assert band_counts(df.filter("id < 0"), "v", 2.5, "near").collect() == []


def test_band_counts_pair_no_values(spark):
    """Every value in one band: the widest step of the plan has three rows a value."""
    df = spark.range(20_000).select("id", (F.col("id") / 1e5).alias("v"))
    plan = band_counts(df, "v", 5.0, "near")
    assert plan.agg(F.min("near"), F.max("near")).first() == (19_999, 19_999)
    assert "CartesianProduct" not in plan._jdf.queryExecution().toString()


def test_salted_join_is_the_join(spark):
    big = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 30 == 1, 8).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    big = big.unionByName(spark.createDataFrame([(None, 1), (None, 2)], "k bigint, x bigint"))
    small = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c"), (None, "n"), (10, "d")], "k bigint, s string")
    for how in ("inner", "left"):
        got = salted_join(big, small, "k", share=0.01, how=how)
        assert sorted(map(str, got.collect())) == sorted(map(str, big.join(small, "k", how).select(got.columns).collect()))
    marked = small.filter("k IN (7, 8, 10)").distinct()
    copies = salted_join(big.select("k", "x"), marked, "k", share=0.01).select("k", "s", F.lit(1)).groupBy("k", "s").count()
    assert {r["s"]: r["count"] for r in copies.collect()} == {"a": 10_001, "b": 10_001, "c": 1_001, "d": 1}
    with pytest.raises(ValueError):
        salted_join(big, small, "k", how="full")


def test_a_third_of_all_rows_is_dealt_over_many_salts(spark):
    big = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("k"), F.col("id").alias("x"))
    small = big.select("k").distinct()
    plan = salted_join(big, small, "k", share=0.01)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in text
    dealt = big.filter("k = 7").select(F.pmod(F.xxhash64("k", "x"), F.lit(34)).alias("salt")).groupBy("salt").count()
    assert dealt.count() == 34 and dealt.agg(F.max("count")).first()[0] < 2 * 3000 / 34
    assert plan.count() == 9_000
