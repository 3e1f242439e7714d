"""Landing folders and the cubes built from them: what is opened, what is rebuilt, what is read."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from sparkwell.operators.cubes import Cube, CubeStore
from sparkwell.operators.ordered import exact_percentiles
from sparkwell.plans.business import RUSH, SURGE, cube_store, fhv_duration_shift
from sparkwell.sources.ledger import FileLedger, deliveries, landed
from sparkwell.tables import Tables

ROWS = "id BIGINT, value DOUBLE"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def land(spark, folder, name, rows, mode="append"):
    df = spark.createDataFrame([(*r, name) for r in rows], f"{ROWS}, name STRING")
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("name").parquet(f"{folder}/landing")


def stored(ledger):
    return sorted(map(tuple, ledger.read(f"{ROWS}, name STRING").collect()))


def test_only_pending_files_are_opened(spark, folder):
    """Bytes read do not grow with history: a file that was loaded may even be unreadable."""
    landing, ledger = f"{folder}/landing", FileLedger(spark, f"{folder}/store")
    land(spark, folder, "d1", [(1, 1.0), (2, 2.0)])
    assert ledger.ingest_folder(landing, ROWS) == ["d1"]
    for name in os.listdir(f"{landing}/name=d1"):
        if name.endswith(".parquet"):
            path = f"{landing}/name=d1/{name}"
            state = os.stat(path)
            with open(path, "wb") as f:
                f.write(b"x" * state.st_size)
            os.utime(path, ns=(state.st_atime_ns, state.st_mtime_ns))
    land(spark, folder, "d2", [(3, 3.0)])
    opened = []
    assert ledger.ingest_folder(landing, ROWS, lambda rows: opened.extend(rows.inputFiles()) or rows) == ["d2"]
    assert opened and all("name=d2" in f for f in opened)
    assert stored(ledger) == [(1, 1.0, "d1"), (2, 2.0, "d1"), (3, 3.0, "d2")]
    # a ledger that is opened again knows what was loaded
    assert FileLedger(spark, f"{folder}/store").ingest_folder(landing, ROWS) == []


def test_republished_and_second_files_replace_their_name(spark, folder):
    landing, ledger = f"{folder}/landing", FileLedger(spark, f"{folder}/store")
    land(spark, folder, "a b=1", [(1, 1.0)])
    land(spark, folder, "c", [(2, 2.0)])
    ledger.ingest_folder(landing, ROWS)
    land(spark, folder, "a b=1", [(1, 10.0)], "overwrite")
    assert ledger.ingest_folder(landing, ROWS) == ["a b=1"]
    land(spark, folder, "c", [(4, 4.0)])
    assert ledger.ingest_folder(landing, ROWS) == ["c"]
    assert stored(ledger) == [(1, 10.0, "a b=1"), (2, 2.0, "c"), (4, 4.0, "c")]


def test_a_run_that_dies_before_its_commit_is_run_again(spark, folder):
    landing, ledger = f"{folder}/landing", FileLedger(spark, f"{folder}/store")
    land(spark, folder, "a", [(1, 1.0)])
    ledger.ingest_folder(landing, ROWS, crash_before_commit=True)
    assert FileLedger(spark, f"{folder}/store").ingest_folder(landing, ROWS) == ["a"]
    assert stored(ledger) == [(1, 1.0, "a")]


def test_missing_names_are_dropped_only_on_request(spark, folder):
    landing, ledger = f"{folder}/landing", FileLedger(spark, f"{folder}/store")
    land(spark, folder, "a", [(1, 1.0)])
    land(spark, folder, "b", [(2, 2.0)])
    ledger.ingest_folder(landing, ROWS)
    shutil.rmtree(f"{landing}/name=a")
    assert ledger.ingest_folder(landing, ROWS) == [] and len(stored(ledger)) == 2
    assert ledger.ingest_folder(landing, ROWS, drop_missing=True) == []
    assert stored(ledger) == [(2, 2.0, "b")]


def test_listing_reads_no_content(spark, folder):
    land(spark, folder, "a", [(1, 1.0)])
    files = landed(spark, f"{folder}/landing")
    assert [r["name"] for r in deliveries(files).collect()] == ["a"]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


CUBE = Cube("c", {"parity": "id % 2"}, "value")
SUMS = Cube("s", {"parity": "id % 2"}, sums={"total": "value", "n": "1L"}, keep="id > 0")


def parts(store, cube):
    out = {}
    for at, _, names in os.walk(store._ledger(cube).data_path):
        for n in names:
            if n.endswith(".parquet"):
                out[f"{at}/{n}"] = os.stat(f"{at}/{n}").st_mtime_ns
    return out


def test_a_corrected_month_is_rebuilt_alone(spark, folder):
    for m in ("2020-01", "2020-02", "2020-03"):
        land(spark, folder, m, [(i, float(i % 5)) for i in range(20)])
    store = CubeStore(spark, f"{folder}/landing", ROWS, f"{folder}/cubes")
    assert store.refresh(CUBE) == store.refresh(SUMS) == ["2020-01", "2020-02", "2020-03"]
    assert store.refresh(CUBE) == []
    before = parts(store, CUBE)
    land(spark, folder, "2020-02", [(1, 100.0), (1, 100.0), (2, 7.0)], "overwrite")
    assert store.refresh(CUBE) == ["2020-02"]
    after = parts(store, CUBE)
    same = lambda found: {k: v for k, v in found.items() if "2020-02" not in k}
    assert same(before) == same(after) and set(before) - set(after)
    assert sorted(map(tuple, store.read(CUBE, ["2020-02"]).select("parity", "value", "n").collect())) == [(0, 7.0, 1), (1, 100.0, 2)]
    assert store.refresh(SUMS) == ["2020-02"]
    assert sorted(map(tuple, store.read(SUMS, ["2020-02"]).select("parity", "total", "n").collect())) == [(0, 7.0, 1), (1, 200.0, 2)]


def test_counts_of_values_merge_to_exact_percentiles(spark, folder):
    rows = {m: [(i, float((i * k) % 13)) for i in range(40)] for k, m in enumerate(("2020-01", "2020-02", "2020-03"), 3)}
    for m, r in rows.items():
        land(spark, folder, m, r)
    store = CubeStore(spark, f"{folder}/landing", ROWS, f"{folder}/cubes")
    store.refresh(CUBE)
    got = exact_percentiles(store.read(CUBE, ["2020-02", "2020-03"]), ["parity"], "value", {"p": 0.9}, "n").collect()
    plain = spark.createDataFrame(rows["2020-02"] + rows["2020-03"], ROWS).groupBy((F.col("id") % 2).alias("parity"))
    wanted = {r["parity"]: (r["p"], r["n"]) for r in plain.agg(F.percentile("value", 0.9).alias("p"), F.count("value").alias("n")).collect()}
    assert {r["parity"]: (pytest.approx(r["p"]), r["n"]) for r in got} == wanted


def test_ride_questions_read_their_cube_only(spark, sf_dir):
    t = Tables(spark, sf_dir)
    answer = fhv_duration_shift(t)
    assert answer.collect()
    files = answer.inputFiles()
    assert files and all("/cubes/rush-" in f for f in files)
    store = cube_store(t, "rides")
    store.refresh(SURGE)
    one = store.read(SURGE, ["1998-05"])
    assert "name#" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]
    assert store.refresh(RUSH) == []
    with pytest.raises(ValueError):
        fhv_duration_shift(t, "1998-06-15")
