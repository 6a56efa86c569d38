"""Telemetry over the events: a user is a device, ``value`` its utilisation."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import values as v
from corpusflow.operators import exact
from corpusflow.operators import telemetry as tm
from corpusflow.queries.tables import rounded, table
from corpusflow.session import spread, stored, work_dir
from corpusflow.sources import device_log

HOSTS = 5
THROTTLE_HOURS = 4


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def probe_output(events: DataFrame, *keep: str) -> DataFrame:
    """What the device probe prints for each event, including its unreadable variants."""
    keyed = events.select("*", F.get_json_object("props", "$.k").cast("int").alias("k"))
    k = F.col("k")
    kind = F.col("event_type")
    reading = F.format_string("%.2f", "value")
    name = F.when((kind == "signup") & (k < 20), F.lit("dev, signup")).otherwise(F.concat(F.lit("dev "), kind))
    head = F.concat_ws(", ", F.col("user_id").cast("string"), name)
    full = F.concat_ws(
        ", ",
        head,
        F.when(kind == "error", F.lit("[N/A]")).otherwise(reading),
        k.cast("string"),
        (k * 64).cast("string"),
        F.lit("81920"),
        (k + 30).cast("string"),
        reading,
    )
    output = (
        F.when((kind == "view") & (k >= 90), head)
        .when((kind == "click") & (k >= 95), F.lit("  "))
        .otherwise(full)
    )
    return keyed.select(*keep, output.alias("output"))


def _parsed(events: DataFrame, *keep: str) -> DataFrame:
    return device_log.parse_device_lines(device_log.probe_lines(probe_output(spread(events), *keep)))


def parse_device_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(_events(spark, sf_dir), "event_id")


def _slot(width: str) -> Column:
    return F.window("ts", width)["start"]


def strict_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(_events(spark, sf_dir), "event_id", "ts").withColumn("snapshot", _slot("10 minutes")).drop("ts")
    parsed = stored(parsed, "parsed")
    return device_log.strict_snapshots(parsed, "snapshot").select(
        "snapshot", "event_id", "index", "name", "utilization_gpu", "memory_used_gb"
    )


def _hourly_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = device_log.accepted(_parsed(_events(spark, sf_dir), "event_id", "ts"))
    return good.withColumn("snapshot", _slot("1 hour"))


def snapshot_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = tm.snapshot_means(_hourly_samples(spark, sf_dir), ["snapshot"])
    return means.select("snapshot", "n_samples", rounded("avg_utilization"))


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per hour and host; the devices (users) are dealt to a few hosts, so that documents hold several."""
    samples = _hourly_samples(spark, sf_dir).withColumn("host", (F.col("index") % HOSTS).cast("bigint"))
    return tm.nest_snapshots(samples, "snapshot", "host")


def _flat(nested: DataFrame) -> DataFrame:
    return nested.select(
        "timestamp",
        "host",
        F.col("gpus.index").alias("gpu_index"),
        F.col("gpus.name").alias("gpu_name"),
        F.col("gpus.utilization_gpu").alias("gpu_utilization"),
        F.col("gpus.memory_used_gb").alias("gpu_memory_used"),
        rounded("avg_utilization"),
    )


def snapshot_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_nested(spark, sf_dir))


def history_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "history")
    device_log.append_history(_nested(spark, sf_dir), path)
    return _flat(device_log.read_history(spark, path))


def run_util_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = tm.utilization_stats(_events(spark, sf_dir), ["event_type", "user_id"], "value")
    return stats.withColumn("avg_utilization", F.round("avg_utilization", 6))


def exact_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and means that need no rounding to be compared: they do not depend on the order of addition."""
    return exact.exact_stats(_events(spark, sf_dir), ["event_type", "user_id"], "value")


def latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.latest_value(_events(spark, sf_dir), ["user_id"], "value", "ts", "event_id")


def block_mean_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = tm.block_means(_events(spark, sf_dir), ["user_id"], "value", "ts", "event_id")
    return blocks.withColumn("block_mean", F.round("block_mean", 6))


def trailing_mean_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = _events(spark, sf_dir).select("user_id", "event_id", "ts", "value")
    trailing = tm.trailing_means(samples, ["user_id"], "value", "ts", "event_id")
    return trailing.select("user_id", "event_id", rounded("trailing_mean"))


def throttle_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = _events(spark, sf_dir).select("user_id", "event_id", "ts", "value")
    return tm.throttle(samples, ["user_id"], "ts", "event_id", seconds=THROTTLE_HOURS * 3600)


def asof_last_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    records = events.where(F.col("event_type") != "error").select("user_id", "event_id", "ts", "event_type")
    samples = events.where(F.col("event_type") == "error").select(
        "user_id", "event_id", "ts", F.col("value").alias("gpu_utilization")
    )
    return tm.asof_last(records, samples, ["user_id"], "gpu_utilization", "ts", "event_id")


def rank_device_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("local_rank"))
    samples = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("index"), F.col("n_name").alias("name"))
    return tm.lookup_device(ranks, samples, "local_rank", "index").select("p_partkey", "local_rank", "name")


def pick_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = table(spark, sf_dir, "embeddings").withColumn("local_rank", (F.col("vec_id") % 128).cast("int"))
    own = v.pick_by_rank(F.col("embedding"), F.col("local_rank")).cast("double")
    return readings.select("vec_id", "local_rank", v.fill_missing(own).alias("reading"))


def unit_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        "l_orderkey",
        "l_linenumber",
        v.mib_to_gib(F.col("l_quantity")).alias("quantity_gib"),
        v.bytes_to_gb(F.col("l_extendedprice")).alias("price_gb"),
    )


def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labelled = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return labelled.select(
        "doc_id",
        v.fill_missing(F.col("quality").cast("double")).alias("quality"),
        v.fill_missing(F.col("toxic").cast("double")).alias("toxic"),
    )


QUERIES = {
    "parse_device_csv": parse_device_csv,
    "strict_snapshots": strict_snapshots,
    "snapshot_mean": snapshot_mean,
    "snapshot_nested": snapshot_nested,
    "history_json_roundtrip": history_json_roundtrip,
    "run_util_stats": run_util_stats,
    "exact_run_stats": exact_run_stats,
    "latest_value": latest_value,
    "block_mean_10": block_mean_10,
    "trailing_mean_10": trailing_mean_10,
    "throttle_samples": throttle_samples,
    "asof_last_sample": asof_last_sample,
    "rank_device_join": rank_device_join,
    "pick_by_rank": pick_by_rank,
    "unit_conversion": unit_conversion,
    "default_fill": default_fill,
}

# the lines above, parsed: blank and short ones are gone
PARSED = """
    keyed AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
    kept AS (SELECT * FROM keyed
             WHERE NOT (event_type = 'view' AND k >= 90) AND NOT (event_type = 'click' AND k >= 95)),
    shifted AS (SELECT *, event_type = 'signup' AND k < 20 AS comma FROM kept),
    parsed AS (
        SELECT event_id, ts, CAST(user_id AS INTEGER) AS index,
               CASE WHEN comma THEN 'dev' ELSE 'dev ' || event_type END AS name,
               CASE WHEN comma OR event_type = 'error' THEN NULL ELSE value END AS utilization_gpu,
               CASE WHEN comma THEN value ELSE CAST(k AS DOUBLE) END AS utilization_memory,
               CASE WHEN comma THEN k / 1024.0 ELSE k * 64 / 1024.0 END::DOUBLE AS memory_used_gb,
               CASE WHEN comma THEN k * 64 / 1024.0 ELSE 80.0 END::DOUBLE AS memory_total_gb,
               CASE WHEN comma THEN 81920.0 ELSE k + 30 END::DOUBLE AS temperature,
               CASE WHEN comma THEN CAST(k + 30 AS DOUBLE) ELSE value END AS power_draw,
               NOT comma AND event_type <> 'error' AS ok
        FROM shifted)"""

_HOURLY = f"""{PARSED},
    hourly AS (SELECT *, date_trunc('hour', ts) AS snapshot FROM parsed WHERE ok)"""

_NESTED = f"""
    WITH {_HOURLY}
    SELECT snapshot AS timestamp, CAST(index % {HOSTS} AS BIGINT) AS host,
           list(index ORDER BY {{key}}) AS gpu_index, list(name ORDER BY {{key}}) AS gpu_name,
           list(utilization_gpu ORDER BY {{key}}) AS gpu_utilization,
           list(memory_used_gb ORDER BY {{key}}) AS gpu_memory_used,
           round(avg(utilization_gpu), 6) AS avg_utilization
    FROM hourly GROUP BY snapshot, index % {HOSTS}""".format(
    key="index, name, utilization_gpu, utilization_memory, memory_used_gb, memory_total_gb, temperature, power_draw"
)

_BLOCKS = """
    WITH numbered AS (
        SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 10 AS block FROM events)
    SELECT user_id, CAST(block AS BIGINT) AS block, round(avg(value), 6) AS block_mean,
           max(ts) AS ts, arg_max(event_id, ts) AS event_id
    FROM numbered GROUP BY user_id, block HAVING count(*) = 10"""

_THROTTLED = """
    WITH RECURSIVE kept AS (
        SELECT user_id, min(ts) AS ts FROM events GROUP BY user_id
        UNION ALL
        SELECT k.user_id, min(e.ts) AS ts FROM kept k
        JOIN events e ON e.user_id = k.user_id AND e.ts > k.ts + INTERVAL 4 HOUR
        GROUP BY k.user_id)
    SELECT e.user_id, min(e.event_id) AS event_id, e.ts, arg_min(e.value, e.event_id) AS value
    FROM kept k JOIN events e ON e.user_id = k.user_id AND e.ts = k.ts GROUP BY e.user_id, e.ts"""

ASOF_SQL = """
    SELECT r.user_id, r.event_id, r.ts, r.event_type, s.value AS gpu_utilization
    FROM (SELECT * FROM events WHERE event_type <> 'error') r
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') s
    ON r.user_id = s.user_id AND r.ts >= s.ts"""



def exact_sql(keys: str) -> str:
    """Sums in whole units of 2**-70, which every value from 2**-18 on consists of; the text is read back rounded once."""
    return f"""
        WITH sums AS (
            SELECT {keys}, count(value) AS n_values, sum(CAST(value * pow(2::DOUBLE, 70) AS HUGEINT)) AS units
            FROM events WHERE value IS NOT NULL GROUP BY ALL),
        rounded AS (
            SELECT {keys}, n_values, CAST(CAST(units AS VARCHAR) AS DOUBLE) / pow(2::DOUBLE, 70) AS exact_sum FROM sums)
        SELECT {keys}, n_values, exact_sum, exact_sum / n_values AS exact_mean FROM rounded"""


ORACLE = {
    "parse_device_csv": f"""
        WITH {PARSED}
        SELECT event_id, index, name, utilization_gpu, utilization_memory, memory_used_gb, memory_total_gb,
               temperature, power_draw, ok
        FROM parsed""",
    "strict_snapshots": f"""
        WITH {PARSED},
        slotted AS (SELECT *, time_bucket(INTERVAL '10 minutes', ts) AS snapshot FROM parsed),
        verdicts AS (SELECT snapshot FROM slotted GROUP BY snapshot HAVING bool_and(ok))
        SELECT snapshot, event_id, index, name, utilization_gpu, memory_used_gb
        FROM slotted WHERE snapshot IN (SELECT snapshot FROM verdicts)""",
    "snapshot_mean": f"""
        WITH {_HOURLY}
        SELECT snapshot, count(*) AS n_samples, round(avg(utilization_gpu), 6) AS avg_utilization
        FROM hourly GROUP BY snapshot""",
    "snapshot_nested": _NESTED,
    "history_json_roundtrip": _NESTED,
    "run_util_stats": """
        SELECT event_type, user_id, round(avg(value), 6) AS avg_utilization, min(value) AS min_utilization,
               max(value) AS max_utilization
        FROM events GROUP BY event_type, user_id""",
    "exact_run_stats": exact_sql("event_type, user_id"),
    "latest_value": "SELECT user_id, arg_max(value, ts) AS value, max(ts) AS ts FROM events GROUP BY user_id",
    "block_mean_10": _BLOCKS,
    "trailing_mean_10": """
        WITH windows AS (
            SELECT user_id, event_id, avg(value) OVER w AS trailing_mean, count(*) OVER w AS n
            FROM events
            WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
        SELECT user_id, event_id, round(trailing_mean, 6) AS trailing_mean FROM windows WHERE n = 10""",
    "throttle_samples": _THROTTLED,
    "asof_last_sample": ASOF_SQL,
    "rank_device_join": """
        SELECT p_partkey, p_size AS local_rank, n_name AS name FROM part LEFT JOIN nation ON n_nationkey = p_size""",
    "pick_by_rank": """
        SELECT vec_id, CAST(vec_id % 128 AS INTEGER) AS local_rank,
               coalesce(CAST(embedding[vec_id % 128 + 1] AS DOUBLE), 0.0) AS reading
        FROM embeddings""",
    "unit_conversion": """
        SELECT l_orderkey, l_linenumber, l_quantity / 1024 AS quantity_gib,
               l_extendedprice / CAST(1e9 AS DOUBLE) AS price_gb
        FROM lineitem""",
    "default_fill": """
        SELECT d.doc_id, coalesce(CAST(quality AS DOUBLE), 0.0) AS quality, coalesce(CAST(toxic AS DOUBLE), 0.0) AS toxic
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
}
BLOCKS_SQL, THROTTLED_SQL = _BLOCKS, _THROTTLED
