"""Session helpers: table loading, shared checkpoint folder, local sessions for tests."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "cobble") -> SparkSession:
    """A local session for tests and the bench; a cluster job gets its session from spark-submit."""
    # A folder of this machine will do for a local session; a cluster names a shared one.
    scratch = os.environ.get("COBBLE_SCRATCH") or tempfile.mkdtemp(prefix="cobble-ckpt-")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.checkpoint.dir", scratch)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    A cluster names it (a folder every executor can reach). Where it is unset, a local
    session gets a fresh folder; any other session is refused, since its executors would
    each write to a disk of their own.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="cobble-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, for written tables and round trips."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


#: Bytes of input worth a task of its own when a small input is dealt out.
SPREAD_BYTES = 256 << 10


def spread(df: DataFrame, splits: bool = True) -> DataFrame:
    """Deal the rows of an input that Spark reads in too few tasks over more of them.

    ``splits``: whether the source can be cut (Parquet, plain text, CSV without newlines in
    fields). Such an input is dealt out only while all of it is at most one split; anything
    larger is already read in split-sized tasks and is not shuffled. An input that can't be
    cut (one multi-line document a file) is dealt into split-sized partitions.
    """
    spark = df.sparkSession
    # The planner's estimate from file sizes; nothing is run for it.
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    small = min(spark.sparkContext.defaultParallelism, -(-size // SPREAD_BYTES))
    if splits:
        return df.repartition(small) if size <= split and small > 1 else df
    n = max(small, -(-size // split))
    return df.repartition(n) if n > 1 else df
