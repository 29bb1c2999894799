"""Session settings and the shared folder for written intermediates."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

SPREAD_BYTES = 16 << 20


def build_session(app="tickermood", master=None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a folder of
    its own, remembered as the checkpoint folder. On a cluster the setting is
    demanded, and a path of one machine is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.master.startswith("local"):
        if not folder:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if re.match(r"file:|/tmp(/|$)", folder):
            raise RuntimeError(f"spark.checkpoint.dir is {folder}, which other machines do not see")
    if folder:
        return folder
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickermood-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread_small(df: DataFrame, key: str) -> DataFrame:
    """Deal out an input too small to give every core a split, so that more than one works on it.

    A file of one row group cannot be cut by the reader: one task gets all its rows,
    however many splits there are. What moves is below ``SPREAD_BYTES`` of files for each
    core; a larger input, whose splits keep the cores busy, passes unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if plan_bytes(df) < cores * SPREAD_BYTES else df


def plan_bytes(df: DataFrame) -> int:
    """What Spark expects a frame to read, from the sizes of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def pieces(df: DataFrame, least: int) -> int:
    """Number of partitions, ``least`` or more, that leaves each at most ``SPREAD_BYTES`` of the files read."""
    return max(least, -(-plan_bytes(df) // SPREAD_BYTES))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a frame of any size as Parquet below the shared folder and read it back.

    Later jobs read rows and not the work behind them, prune columns, and depend
    on no executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Write a small frame that several jobs reuse to reliable storage.

    Reading it back neither repeats its lineage nor depends on any executor. The
    rebalance hint sizes its partitions by bytes, so that iterative fits over a
    small table do not run hundreds of tiny tasks per step.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.hint("rebalance").checkpoint()
