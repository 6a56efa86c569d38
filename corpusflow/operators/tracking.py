"""Run metrics, parameters and artifacts as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.session import stored

METRICS_SCHEMA = "run_id STRING, key STRING, value DOUBLE, step BIGINT, ts TIMESTAMP_NTZ"
PARAMS_SCHEMA = "run_id STRING, key STRING, value STRING"
LEVELS = 4
ARTIFACTS_SCHEMA = "run_id STRING, path STRING, content STRING"


def to_long(df: DataFrame, ids: list[str], metrics: dict[str, str]) -> DataFrame:
    """Wide to long: ``metrics`` maps a column to its namespaced key."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(key) for c, key in metrics.items()])
    return wide.unpivot(ids, list(metrics.values()), "key", "value")


def json_to_long(df: DataFrame, ids: list[str], metrics: str) -> DataFrame:
    """``ids, key, value, text``: every leaf of the JSON in the column ``metrics``, whatever its keys and however deep.

    A key is the path of names, and of places in arrays, joined by slashes.
    Numbers are in ``value``; other leaves, as JSON, in ``text``. Text that is
    no JSON, a null, and an empty object or array give no row. ``LEVELS`` levels of
    nesting are one pass, written once; what has more goes through another one.
    """
    rows = df.select(*ids, F.lit("").alias("_path"), F.col(metrics).alias("_json"))
    found = None
    while True:
        below = _exploded(rows.select(*ids, "_path", F.try_parse_json("_json").alias("_value")), ids)
        for _ in range(LEVELS - 1):
            below = _exploded(below, ids, outer=True)
        json, kind = F.to_json("_value"), F.schema_of_variant("_value")
        nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        number = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
        below = below.where((kind != "VOID") & ~json.isin("{}", "[]")).select(
            *ids, "_path",
            F.when(number, json.cast("double")).alias("_number"),
            F.when(~number & ~nested, json).alias("_text"),
            F.when(nested, json).alias("_json"),
        )
        below = stored(below, "metric_leaves")
        leaves = below.where("_json IS NULL").select(
            *ids, F.col("_path").alias("key"), F.col("_number").alias("value"), F.col("_text").alias("text")
        )
        found = leaves if found is None else found.union(leaves)
        rows = below.where("_json IS NOT NULL").select(*ids, "_path", "_json")
        if rows.isEmpty():
            return found


def _exploded(held: DataFrame, ids: list[str], outer: bool = False) -> DataFrame:
    """``ids, _path, _value`` of what is one level below; with ``outer`` also of what has nothing below it, as it is."""
    explode = "variant_explode_outer" if outer else "variant_explode"
    below = held.sparkSession.sql(
        f"SELECT h.*, c.pos AS _pos, c.key AS _key, c.value AS _below FROM {{held}} h, LATERAL {explode}(h._value) c", held=held
    )
    name = F.coalesce("_key", F.col("_pos").cast("string"))
    path = F.when(F.col("_path") == "", name).otherwise(F.concat("_path", F.lit("/"), name))
    return below.select(
        *ids,
        F.when(F.col("_pos").isNull(), F.col("_path")).otherwise(path).alias("_path"),
        F.when(F.col("_pos").isNull(), F.col("_value")).otherwise(F.col("_below")).alias("_value"),
    )


def params_to_long(df: DataFrame, ids: list[str], params: list[str]) -> DataFrame:
    wide = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in params])
    return wide.unpivot(ids, params, "key", "value")


def append_table(df: DataFrame, path: str, by_run: bool = True) -> None:
    """Append records. ``by_run`` keeps one folder per run, so reading a run prunes the others.

    Rows are rebalanced by run first: a large run is written by several tasks,
    a small one by one, so there are few files. With very many small runs use
    ``by_run=False``.
    """
    if by_run:
        df.hint("rebalance", F.col("run_id")).write.mode("append").partitionBy("run_id").parquet(path)
    else:
        df.write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_artifact_files(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Text files as artifacts, one row per file."""
    return spark.read.text(path, wholetext=True).select(
        F.lit(run_id).alias("run_id"), F.input_file_name().alias("path"), F.col("value").alias("content")
    )


def compare_runs(metrics: DataFrame, before: Column, after: Column, by: tuple[str, ...] = ("key",)) -> DataFrame:
    """Mean of every key in two groups of metric points, and their difference.

    One pass and one shuffle of partial sums instead of a self-join; a key that
    only one side has keeps NULL on the other, as in a full outer join.
    """
    return (
        metrics.where(before | after)
        .groupBy(*by)
        .agg(
            F.avg(F.when(before, F.col("value"))).alias("before"),
            F.avg(F.when(after, F.col("value"))).alias("after"),
        )
        .withColumn("delta", F.col("after") - F.col("before"))
    )


def missing_required(required: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """All required items that are not present."""
    return required.join(present, keys, "left_anti")


def gate(df: DataFrame, keys: list[str], all_of: Column, any_of: Column) -> DataFrame:
    """Per group: does every row pass, and does any row raise a flag?"""
    return df.groupBy(*keys).agg(F.every(all_of).alias("all_ok"), F.some(any_of).alias("any_flag"))
