"""What stays in the memory of an executor's Python processes."""

import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark import SparkContext

from sparkwell.llm import exact_dedup, packing, text, tokens
from sparkwell.llm.common import local_table

SCHEMA = "doc_id bigint, text string, source string"
FREED = """
import numpy as np, pyarrow as pa
from sparkwell.llm.text import slices
held = lambda: int(next(x for x in open("/proc/self/status") if x.startswith("RssAnon")).split()[1]) >> 10
begin = held()
many, pins = [], []
for _ in range(3000):  # what stays lies between what goes
    many.append(np.ones(50_000, np.uint8)), pins.append(np.ones(1_000, np.uint8))
full = held()
del many
list(slices([pa.RecordBatch.from_arrays([pa.array([1])], names=["a"])]))
print(full - begin, held() - begin)
"""


@pytest.mark.skipif(text._trim is None, reason="this C library returns memory by itself")
def test_memory_of_a_task_goes_back_when_it_ends():
    full, left = map(int, subprocess.run([sys.executable, "-c", FREED], capture_output=True, text=True, check=True).stdout.split())
    assert full > 100 and left < full / 3


def test_tables_of_the_driver_start_no_workers(spark, monkeypatch):
    """Python rows become an RDD, which executors read through workers of another kind."""
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "a b", None), (3, "c", "y"), (4, None, "x")], SCHEMA)
    monkeypatch.setattr(SparkContext, "parallelize", lambda *a, **b: pytest.fail("an RDD of Python rows"))
    assert sorted(r["doc_id"] for r in exact_dedup.exact_copies_removed(docs).collect()) == [2, 3, 4]
    pieces = packing.pack(docs, tokens.tokenizer_path("byte_bpe_50k.json"), {"x": 2.0, None: 1.0, "y": 1.0})
    assert sorted({r["doc_id"] for r in pieces.collect()}) == [1, 2, 3, 4]
    assert packing.pack(docs.filter("doc_id = 9"), tokens.tokenizer_path("byte_bpe_50k.json")).collect() == []


def test_table_of_the_driver(spark):
    df = local_table(spark, name=pa.array(["é", None, ""], pa.string()), own=pa.array([0, 1, 2], pa.int32()))
    assert df.schema.simpleString() == "struct<name:string,own:int>"
    assert [tuple(r) for r in df.collect()] == [("é", 0), (None, 1), ("", 2)]
    assert local_table(spark, name=pa.array([], pa.string())).collect() == []


def test_the_last_caller_bounds_the_cache():
    path = tokens.tokenizer_path("byte_bpe_50k.json")
    texts = [f"w{i} x{i} y{i}" for i in range(500)]
    wide = [tokens.encoder(path).encode([t])[0] for t in texts]
    assert [tokens.encoder(path, 100).encode([t])[0] for t in texts] == wide
    assert len(tokens.encoder(path, 100)) <= 110


def test_packing_with_a_small_cache(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i * j}" for j in range(50)), f"s{i % 3}") for i in range(40)], SCHEMA).repartition(2, "doc_id").localCheckpoint()
    path = tokens.tokenizer_path("byte_bpe_50k.json")
    assert sorted(packing.pack(docs, path, cached=8).collect()) == sorted(packing.pack(docs, path).collect())
