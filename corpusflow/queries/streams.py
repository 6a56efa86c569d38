"""Streaming queries: events arrive as files, results are read back from the sink."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators import exact
from corpusflow.queries.tables import rounded, table
from corpusflow.queries.telemetry import (
    ASOF_SQL,
    BLOCKS_SQL,
    PARSED,
    THROTTLE_HOURS,
    THROTTLED_SQL,
    exact_sql,
    probe_output,
)
from corpusflow.session import stored, work_dir
from corpusflow.sources import device_log
from corpusflow.streaming import series
from corpusflow.streaming import streams as st

PERIODS = 3
LATEST_SECONDS = 36 * 3600
US = 1_000_000


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # a pattern, so that the table may be one file as well as a folder of files
    return st.read_landing(st.stream_session(spark), f"{sf_dir}/events.parque[t]", schema)


def _appended(spark: SparkSession, stream: DataFrame, label: str, fmt: str = "parquet") -> DataFrame:
    base = work_dir(spark, label)
    st.run(stream, f"{base}/out", f"{base}/checkpoint", fmt=fmt)
    reader = spark.read.schema(stream.schema).format(fmt)
    if fmt == "json":
        reader = reader.options(**device_log.HISTORY_OPTIONS)
    return reader.load(f"{base}/out")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = work_dir(spark, "lines")
    probe_output(table(spark, sf_dir, "events")).write.text(landing)
    lines = st.read_landing(st.stream_session(spark), landing, "line STRING", "text")
    return _appended(spark, device_log.accepted(device_log.parse_device_lines(lines)), "ingest")


def _landing(spark: SparkSession, sf_dir: str) -> tuple[str, int, float]:
    """Events as files of three periods of arrival, and a last file that ends the stream.

    An event arrives up to a day and a half late, so files overlap in their
    times. Returns the folder, the files of a period at most, and the delay that
    makes no event late in whatever order a period's files are read.
    """
    landing = f"{work_dir(spark, 'ordered')}/landing"
    events = table(spark, sf_dir, "events")
    late = F.pmod(F.xxhash64("event_id"), F.lit(LATEST_SECONDS * US))
    arriving = stored(events.withColumn("_arrival", F.unix_micros(F.col("ts").cast("timestamp")) + late), "arriving")
    first, last = arriving.agg(F.min("_arrival"), F.max("_arrival")).head()
    width = ((last or 0) - (first or 0)) // PERIODS + 1
    period = F.floor((F.coalesce("_arrival", F.lit(first or 0)) - (first or 0)) / width)
    for number in range(PERIODS):
        arriving.where(period == number).drop("_arrival").write.mode("append").parquet(landing)
    delay = LATEST_SECONDS + width / US
    series.end_of_stream(spark, events.schema, "ts", landing, 2 * delay)
    return landing, arriving.rdd.getNumPartitions(), delay


def _events_by_file(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, float]:
    landing, files, delay = _landing(spark, sf_dir)
    schema = table(spark, sf_dir, "events").schema
    return st.read_landing(st.stream_session(spark), landing, schema, files_per_trigger=files), delay


def _settled(spark: SparkSession, rows: DataFrame, step: series.Step, arriving: DataFrame) -> DataFrame:
    base = work_dir(spark, "series")
    series.run(rows, f"{base}/out", f"{base}/checkpoint")
    return series.results(spark, f"{base}/out", step, arriving.schema)


def stream_snapshot_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, delay = _events_by_file(spark, sf_dir)
    means = _appended(spark, series.window_means(events, ["event_type"], "value", "ts", 3600, delay), "means")
    return means.withColumn("avg_utilization", F.round("avg_utilization", 6))


def stream_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, delay = _events_by_file(spark, sf_dir)
    events = events.select("user_id", "event_id", "ts", "value")  # what waits in the state
    step = series.Throttle(["user_id"], "ts", "event_id", seconds=THROTTLE_HOURS * 3600)
    kept = _settled(spark, series.in_order(events, delay, step), step, events)
    return kept


def stream_block_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, delay = _events_by_file(spark, sf_dir)
    events = events.select("user_id", "event_id", "ts", "value")
    step = series.BlockMeans(["user_id"], "value", "ts", "event_id")
    blocks = _settled(spark, series.in_order(events, delay, step), step, events)
    return blocks.withColumn("block_mean", F.round("block_mean", 6))


def stream_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events are the samples, all others the records; both arrive as streams of their own."""
    landing, files, delay = _landing(spark, sf_dir)
    session, schema = st.stream_session(spark), table(spark, sf_dir, "events").schema
    either = [st.read_landing(session, landing, schema, files_per_trigger=files) for _ in range(2)]
    # the row that ends the stream has no type, and ends both
    records = either[0].where("event_type IS DISTINCT FROM 'error'").select("user_id", "event_id", "ts", "event_type")
    samples = either[1].where("coalesce(event_type, 'error') = 'error'")
    samples = samples.select("user_id", "event_id", "ts", F.col("value").alias("gpu_utilization"))
    step = series.AsofLast(["user_id"], "gpu_utilization", "ts", "event_id")
    return _settled(spark, series.asof_stream(records, samples, delay, step), step, series.asof_rows(records, samples, step))


def stream_append_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _arriving(spark, sf_dir).select(
        F.col("ts").alias("timestamp"), F.struct(F.col("user_id").alias("index"), "value").alias("gpu")
    )
    return _appended(spark, history, "stream-history", "json").select("timestamp", "gpu.*")


def stream_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "stats")
    stats = st.running_stats(_arriving(spark, sf_dir), ["user_id"], "value")
    st.run_updates(stats, f"{base}/out", f"{base}/checkpoint", ["user_id"])
    current = st.current_rows(spark, f"{base}/out", ["user_id"])
    return current.select("user_id", rounded("avg_utilization"), "min_utilization", "max_utilization")


def stream_exact_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive in several files; the state holds the limbs of each user's sum."""
    events, _ = _events_by_file(spark, sf_dir)
    base = work_dir(spark, "exact")
    st.run_updates(exact.running_limbs(events, ["user_id"], "value"), f"{base}/out", f"{base}/checkpoint", ["user_id", "place"])
    return exact.exact_totals(st.current_rows(spark, f"{base}/out", ["user_id", "place"]), ["user_id"])


QUERIES = {
    "stream_ingest": stream_ingest,
    "stream_snapshot_mean": stream_snapshot_mean,
    "stream_throttle": stream_throttle,
    "stream_block_mean": stream_block_mean,
    "stream_asof": stream_asof,
    "stream_append_history": stream_append_history,
    "stream_run_stats": stream_run_stats,
    "stream_exact_stats": stream_exact_stats,
}

ORACLE = {
    "stream_ingest": f"""
        WITH {PARSED}
        SELECT index, name, utilization_gpu, utilization_memory, memory_used_gb, memory_total_gb, temperature,
               power_draw
        FROM parsed WHERE ok""",
    "stream_snapshot_mean": """
        SELECT date_trunc('hour', ts) AS snapshot, event_type, count(*) AS n_samples,
               round(avg(value), 6) AS avg_utilization
        FROM events GROUP BY ALL""",
    "stream_throttle": THROTTLED_SQL,
    "stream_block_mean": BLOCKS_SQL,
    "stream_asof": ASOF_SQL,
    "stream_append_history": 'SELECT ts AS timestamp, user_id AS "index", value FROM events',
    "stream_run_stats": """
        SELECT user_id, round(avg(value), 6) AS avg_utilization, min(value) AS min_utilization,
               max(value) AS max_utilization
        FROM events GROUP BY user_id""",
    "stream_exact_stats": exact_sql("user_id"),
}
