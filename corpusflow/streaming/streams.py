"""Live telemetry with Structured Streaming.

Each transformation takes and returns a streaming DataFrame; ``run`` drives one
over what has arrived so far. Event time replaces the wall clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.sources.device_log import HISTORY_OPTIONS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of the same application with the settings stateful queries need.

    The caller's session keeps its own settings. A query's number of state
    partitions is fixed by its first run; one per core unless given.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", state_partitions or spark.sparkContext.defaultParallelism)
    return session


def read_landing(
    spark: SparkSession,
    path: str,
    schema,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Files arriving in a directory, oldest first.

    A micro-batch takes at most ``files_per_trigger`` files if given, at most
    about ``bytes_per_trigger`` if given, else all that have arrived. No
    operator's result depends on it.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    elif bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.load(path)


def run(stream: DataFrame, out: str, checkpoint: str, interval: str | None = None, fmt: str = "parquet"):
    """Append the stream to files, exactly once across restarts with the same ``checkpoint``.

    Without ``interval`` everything that has arrived is processed and the query
    ends; with one (say ``"5 seconds"``) the running query is returned.
    """
    writer = stream.writeStream.outputMode("append").format(fmt).option("path", out)
    writer = writer.option("checkpointLocation", checkpoint)
    if fmt == "json":
        writer = writer.options(**HISTORY_OPTIONS)
    if interval:
        return writer.trigger(processingTime=interval).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_updates(stream: DataFrame, out: str, checkpoint: str, keys: list[str], interval: str | None = None, fold: int = 16):
    """Keep the newest row per key of a stream in update mode; read it with :func:`current_rows`.

    The rows that changed in a micro-batch go to one of ``fold`` folders that
    take turns; after each round they are folded into one of two tables of all
    keys. So there are ``fold + 2`` folders at most, however long the stream
    runs. A repeated micro-batch writes its folders again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").parquet(f"{out}/updates{batch_id % fold}")
        if batch_id % fold == fold - 1:
            turn = batch_id // fold
            parts = [f"{out}/updates{i}" for i in range(fold)] + [f"{out}/all{(turn - 1) % 2}"] * (turn > 0)
            newest = _newest(batch.sparkSession.read.schema(rows.schema).parquet(*parts), keys)
            newest.write.mode("overwrite").parquet(f"{out}/all{turn % 2}")

    writer = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    if interval:
        return writer.trigger(processingTime=interval).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_row"))
    return newest.select(*keys, "_row.*").select(rows.columns)


def current_rows(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Newest row per key among the folders of :func:`run_updates`; older ones lie there too and do not count."""
    return _newest(spark.read.parquet(f"{out}/*"), keys).drop("batch_id")


def running_stats(events: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean, minimum and maximum so far; for update mode. The state is four numbers per key."""
    return events.groupBy(*keys).agg(
        F.avg(value).alias("avg_utilization"),
        F.min(value).alias("min_utilization"),
        F.max(value).alias("max_utilization"),
    )
