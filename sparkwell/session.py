"""Session settings and the shared folder that survives the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
FIRST_PARTITIONS_CONF = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Shuffle partitions for each core before adaptive execution joins them.
FIRST_PARTITIONS = 32


RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed join partitions also where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "sparkwell", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC wall clock and no web page."""
    builder = (
        SparkSession.builder.appName(app)
        .config(map=RUNTIME_CONF)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> None:
    """Runtime settings every query relies on, set on whatever session the caller brings."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    partitions = "spark.sql.shuffle.partitions"
    if spark.sparkContext.master.startswith("local") and spark.conf.get(partitions) == "200":
        # the cluster default is far too many tasks and state stores for one machine
        parallelism = spark.sparkContext.defaultParallelism
        spark.conf.set(partitions, str(parallelism))
        # a batch shuffle starts with more and adaptive execution joins the small ones, so a task's share does not grow with the input
        if spark.conf.get(FIRST_PARTITIONS_CONF, None) is None:
            spark.conf.set(FIRST_PARTITIONS_CONF, str(FIRST_PARTITIONS * parallelism))


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a folder of its own; elsewhere a
    machine-local path would lose data with the machine, so that is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF) or None
    known = sc.getCheckpointDir()
    if root is None and known is not None:
        return known.rsplit("/", 1)[0]
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="sparkwell-")
    if known is None:
        sc.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one table or checkpoint below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/sparkwell/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write once to the shared folder and read back.

    Loops and reused inputs build on the written table: it outlives executors,
    keeps column pruning and gives the planner a true size.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Size of all inputs of a plan together, as Catalyst knows it from the files."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; it never shrinks under filters."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
