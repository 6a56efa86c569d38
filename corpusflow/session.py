"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "corpusflow", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on and UTC timestamps.

    Cluster settings (executors, memory, shuffle partitions) are left to
    spark-submit; pass ``conf`` with dots replaced by ``__`` to override.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder under the shared folder of ``spark.checkpoint.dir``.

    Where the setting is absent, the folder given to ``setCheckpointDir`` is
    used; there has to be one of them.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{base.rstrip('/')}/corpusflow/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Deal an input of fewer splits than there are cores to all cores, before heavy work per row.

    Input of as many splits is returned as it is: data that fills a cluster is
    never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def bound_batches(spark: SparkSession, most_bytes: int = 4 << 20) -> None:
    """Let the session hand about ``most_bytes`` at a time to Python (one row at least), unless it has a bound of its own.

    Spark's default is ten thousand rows or 64 MB. The executor holds a batch
    outside its heap, twice while the buffers grow, the worker holds it too, and
    neither gives all of it back. The bound stays set, as a result is run after
    the call that makes it has returned.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, most_bytes)


def stored(df: DataFrame, label: str, row_group_bytes: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For an expensive input that several branches of a plan read: they then scan
    only the columns they need, and a lost executor costs no recomputation.
    Rows of very many bytes ask for small row groups, as Spark reads up to
    4,096 rows of a group at once.
    """
    path = work_dir(df.sparkSession, label)
    df.write.options(**{} if row_group_bytes is None else {"parquet.block.size": row_group_bytes}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
