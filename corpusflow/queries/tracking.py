"""Run metrics, parameters, artifacts and comparisons."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.functions import values as v
from corpusflow.operators import tracking as tr
from corpusflow.operators.telemetry import block_means, utilization_stats
from corpusflow.queries.tables import rounded, table
from corpusflow.session import spread, work_dir
from corpusflow.settings import (
    AFTER_LENGTH,
    BATCH_PER_DEVICE,
    BEFORE_LENGTH,
    BLOCK_METRICS,
    EPOCHS,
    FINAL_METRICS,
    GRADIENT_ACCUMULATION,
    PARAM_KEYS,
    WORLD_SIZE,
)


def _run_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("run_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("step"),
        F.col("l_shipdate").alias("ts"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
    )


def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dictionaries of metrics in one scan and one append."""
    system = {"l_quantity": "system/quantity", "l_discount": "system/discount"}
    training = {"l_extendedprice": "training/price", "l_tax": "training/tax"}
    path = work_dir(spark, "metrics")
    tr.append_table(tr.to_long(_run_items(spark, sf_dir), ["run_id", "step", "ts"], system | training), path)
    return tr.read_table(spark, path, tr.METRICS_SCHEMA)


def metrics_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested dictionaries whose keys depend on the data, by the paths of their numbers."""
    nested = F.struct(
        F.struct(F.col("l_quantity").alias("quantity"), F.create_map("l_returnflag", "l_discount").alias("discount")).alias("system"),
        F.struct(F.array("l_extendedprice", "l_tax").alias("cost"), F.create_map("l_linestatus", F.create_map("l_returnflag", "l_linenumber")).alias("lines")).alias("training"),
    )
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.to_json(nested).alias("metrics"))
    return tr.json_to_long(spread(items), ["l_orderkey", "l_linenumber"], "metrics").drop("text")


def params_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per corpus source."""
    runs = table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("run-"), "source").alias("run_id"),
        F.concat(F.lit("base/"), "source").alias("model_name"),
        F.col("source").alias("dataset_name"),
        F.lit(EPOCHS).alias("num_epochs"),
        F.lit("2e-05").alias("learning_rate"),
        F.lit(BATCH_PER_DEVICE).alias("batch_size_per_device"),
        F.lit(GRADIENT_ACCUMULATION).alias("gradient_accumulation_steps"),
        F.lit(WORLD_SIZE).alias("world_size"),
        F.lit(WORLD_SIZE).alias("num_gpus"),
    )
    path = work_dir(spark, "params")
    tr.append_table(tr.params_to_long(runs, ["run_id"], list(PARAM_KEYS)), path, by_run=False)
    return tr.read_table(spark, path, tr.PARAMS_SCHEMA)


def artifacts_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    generated = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("run-"), F.col("conv_id").cast("string")).alias("run_id"),
        F.concat(F.lit("evaluation/"), "role", F.lit("_"), F.col("turn").cast("string"), F.lit(".txt")).alias("path"),
        F.col("text").alias("content"),
    )
    path = work_dir(spark, "artifacts")
    tr.append_table(generated, path, by_run=False)
    return tr.read_table(spark, path, tr.ARTIFACTS_SCHEMA)


def compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    metrics = tr.to_long(
        items,
        ["l_linestatus"],
        {"l_quantity": "evaluation/quantity", "l_extendedprice": "evaluation/price",
         "l_discount": "evaluation/discount", "l_tax": "evaluation/tax"},
    )
    compared = tr.compare_runs(metrics, F.col("l_linestatus") == "F", F.col("l_linestatus") == "O")
    return compared.select("key", rounded("before", 4), rounded("after", 4), rounded("delta", 4))


def compare_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of what was generated before and after, per run and turn pair."""
    texts = table(spark, sf_dir, "conversations").where(F.col("role").isin("user", "assistant"))
    metrics = texts.select(
        F.col("conv_id").alias("run_id"),
        F.when(F.col("role") == "user", BEFORE_LENGTH).otherwise(AFTER_LENGTH).alias("key"),
        tx.text_length(F.col("text")).cast("double").alias("value"),
    )
    compared = tr.compare_runs(metrics, F.col("key") == BEFORE_LENGTH, F.col("key") == AFTER_LENGTH, by=("run_id",))
    return compared.select("run_id", rounded("before"), rounded("after"), rounded("delta"))


def final_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End-of-run utilisation of every run as metric rows."""
    samples = table(spark, sf_dir, "events").withColumnRenamed("event_type", "run_id")
    stats = utilization_stats(samples, ["run_id"], "value")
    return tr.to_long(stats, ["run_id"], FINAL_METRICS).select("run_id", "key", rounded("value"))


def block_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block means as metric rows, tagged with the step of the block's last sample."""
    samples = table(spark, sf_dir, "events").withColumnRenamed("event_type", "run_id")
    blocks = block_means(samples, ["run_id", "user_id"], "value", "ts", "event_id")
    long = tr.to_long(blocks, ["run_id", "user_id", "event_id", "ts"], BLOCK_METRICS)
    return long.select("run_id", "user_id", "key", rounded("value"), F.col("event_id").alias("step"), "ts")


def missing_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that should have a label and have none."""
    required = table(spark, sf_dir, "documents").select("doc_id")
    return tr.missing_required(required, table(spark, sf_dir, "labels").select("doc_id"), ["doc_id"])


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    return tr.gate(checked, ["source"], F.col("quality") == 1, F.col("toxic") == 1)


def derive_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").select(F.lit("run").alias("kind"), v.run_name(F.col("ts")).alias("name"))
    models = table(spark, sf_dir, "pages").select(
        F.lit("model").alias("kind"), v.registered_name(F.col("url")).alias("name")
    )
    return runs.unionByName(models)


QUERIES = {
    "metrics_long": metrics_long,
    "metrics_from_json": metrics_from_json,
    "params_long": params_long,
    "artifacts_roundtrip": artifacts_roundtrip,
    "compare_runs": compare_runs,
    "compare_generations": compare_generations,
    "final_metrics": final_metrics,
    "block_metrics": block_metrics,
    "missing_required": missing_required,
    "quality_gate": quality_gate,
    "derive_names": derive_names,
}

_METRIC = """SELECT l_returnflag || l_linestatus AS run_id, '{key}' AS key, CAST({column} AS DOUBLE) AS value,
               l_orderkey * 10 + l_linenumber AS step, l_shipdate AS ts FROM lineitem"""

_SETTINGS = {
    "model_name": "'base/' || source",
    "dataset_name": "source",
    "num_epochs": "'3'",
    "learning_rate": "'2e-05'",
    "batch_size_per_device": "'4'",
    "gradient_accumulation_steps": "'8'",
    "world_size": "'16'",
    "num_gpus": "'16'",
}

ORACLE = {
    "metrics_long": " UNION ALL ".join(
        _METRIC.format(key=key, column=column)
        for key, column in [
            ("system/quantity", "l_quantity"),
            ("system/discount", "l_discount"),
            ("training/price", "l_extendedprice"),
            ("training/tax", "l_tax"),
        ]
    ),
    "metrics_from_json": """
        SELECT l_orderkey, l_linenumber, unnest(['system/quantity', 'system/discount/' || l_returnflag, 'training/cost/0',
                   'training/cost/1', 'training/lines/' || l_linestatus || '/' || l_returnflag]) AS key,
               unnest([l_quantity, l_discount, l_extendedprice, l_tax, l_linenumber::DOUBLE]) AS value
        FROM lineitem""",
    "params_long": "WITH runs AS (SELECT DISTINCT source FROM documents) "
    + " UNION ALL ".join(
        f"SELECT 'run-' || source AS run_id, '{key}' AS key, {value} AS value FROM runs"
        for key, value in _SETTINGS.items()
    ),
    "artifacts_roundtrip": """
        SELECT 'run-' || CAST(conv_id AS VARCHAR) AS run_id,
               'evaluation/' || role || '_' || CAST(turn AS VARCHAR) || '.txt' AS path, text AS content
        FROM conversations""",
    "compare_runs": """
        WITH points AS (
            SELECT l_linestatus, 'evaluation/quantity' AS key, l_quantity AS value FROM lineitem
            UNION ALL SELECT l_linestatus, 'evaluation/price', l_extendedprice FROM lineitem
            UNION ALL SELECT l_linestatus, 'evaluation/discount', l_discount FROM lineitem
            UNION ALL SELECT l_linestatus, 'evaluation/tax', l_tax FROM lineitem),
        earlier AS (SELECT key, avg(value) AS value FROM points WHERE l_linestatus = 'F' GROUP BY key),
        later AS (SELECT key, avg(value) AS value FROM points WHERE l_linestatus = 'O' GROUP BY key)
        SELECT key, round(b.value, 4) AS before, round(a.value, 4) AS after, round(a.value - b.value, 4) AS delta
        FROM earlier b FULL JOIN later a USING (key)""",
    "compare_generations": """
        WITH lengths AS (SELECT conv_id AS run_id, role, length(text) AS n FROM conversations
                         WHERE role IN ('user', 'assistant')),
        compared AS (SELECT run_id, avg(n) FILTER (WHERE role = 'user') AS before,
                            avg(n) FILTER (WHERE role = 'assistant') AS after
                     FROM lengths GROUP BY run_id)
        SELECT run_id, round(before, 6) AS before, round(after, 6) AS after, round(after - before, 6) AS delta
        FROM compared""",
    "final_metrics": """
        WITH stats AS (SELECT event_type AS run_id, avg(value) AS a, min(value) AS lo, max(value) AS hi
                       FROM events GROUP BY event_type)
        SELECT run_id, 'training/final_avg_gpu_utilization' AS key, round(a, 6) AS value FROM stats
        UNION ALL SELECT run_id, 'training/min_gpu_utilization', lo FROM stats
        UNION ALL SELECT run_id, 'training/max_gpu_utilization', hi FROM stats""",
    "block_metrics": """
        WITH numbered AS (
            SELECT *, (row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) - 1) // 10 AS block
            FROM events)
        SELECT event_type AS run_id, user_id, 'training/avg_gpu_utilization' AS key, round(avg(value), 6) AS value,
               arg_max(event_id, ts) AS step, max(ts) AS ts
        FROM numbered GROUP BY event_type, user_id, block HAVING count(*) = 10""",
    "missing_required": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "quality_gate": """
        SELECT source, bool_and(quality = 1) AS all_ok, bool_or(toxic = 1) AS any_flag
        FROM documents JOIN labels USING (doc_id) GROUP BY source""",
    "derive_names": """
        SELECT 'run' AS kind, 'fine_tuning_' || strftime(ts, '%Y%m%d_%H%M%S') AS name FROM events
        UNION ALL SELECT 'model' AS kind, replace(url, '/', '_') || '_fine_tuned' AS name FROM pages""",
}
