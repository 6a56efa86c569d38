"""The scalar functions in use, grouped by kind."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import values as v
from corpusflow.queries.tables import table


def scalar_text_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    listed = F.split("p_name", " ")
    return parts.select(
        "p_partkey",
        F.get(listed, F.lit(0)).alias("first"),
        F.array_join(listed, "/").alias("joined"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.endswith("p_type", F.lit("Y")).alias("has_suffix"),
        F.replace("p_brand", F.lit("#"), F.lit("_")).alias("replaced"),
        F.length("p_name").alias("n_chars"),
        F.format_string("%.2f", "p_retailprice").alias("two_decimals"),
        F.format_string("%.1f", F.col("p_size") / 2).alias("one_decimal"),
        F.concat_ws("/", "p_brand", "p_name").alias("path"),
        F.col("p_name").try_cast("int").alias("not_a_number"),
        F.col("p_size").cast("string").try_cast("double").alias("number"),
        (F.col("p_size") / 7).cast("int").alias("truncated"),
    )


def scalar_time_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        v.iso_timestamp(F.col("ts")).alias("iso"),
        F.date_format("ts", "yyyyMMdd_HHmmss").alias("compact"),
        v.elapsed_seconds("date_trunc('day', ts)", "ts").alias("elapsed"),
    )


def scalar_array_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("values"), "label"
    )
    return wide.select(
        "vec_id",
        F.get("values", F.lit(0)).alias("first"),
        F.element_at("values", -1).alias("last"),
        F.size("values").alias("n"),
        v.last_entries(F.col("values"), 10).alias("tail"),
        F.size(F.concat("values", F.array(F.col("label").cast("double")))).alias("n_appended"),
        F.get("values", F.lit(1000)).alias("out_of_range"),
    )


def scalar_json_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = table(spark, sf_dir, "events").withColumn("props", F.from_json("props", "map<string,int>"))
    return props.select(
        "event_id",
        F.map_contains_key("props", "k").alias("has_key"),
        F.coalesce(F.try_element_at("props", F.lit("missing")), F.lit(-1)).alias("with_default"),
        F.to_json(F.struct("event_type", F.element_at("props", "k").alias("k"))).alias("json"),
    )


QUERIES = {
    "scalar_text_ops": scalar_text_ops,
    "scalar_time_ops": scalar_time_ops,
    "scalar_array_ops": scalar_array_ops,
    "scalar_json_ops": scalar_json_ops,
}

ORACLE = {
    "scalar_text_ops": """
        SELECT p_partkey, split_part(p_name, ' ', 1) AS first, replace(p_name, ' ', '/') AS joined,
               trim('  ' || p_name || ' ') AS trimmed, ends_with(p_type, 'Y') AS has_suffix,
               replace(p_brand, '#', '_') AS replaced, CAST(length(p_name) AS INTEGER) AS n_chars,
               printf('%.2f', p_retailprice) AS two_decimals, printf('%.1f', p_size / 2.0::DOUBLE) AS one_decimal,
               p_brand || '/' || p_name AS path, TRY_CAST(p_name AS INTEGER) AS not_a_number,
               TRY_CAST(CAST(p_size AS VARCHAR) AS DOUBLE) AS number, CAST(p_size // 7 AS INTEGER) AS truncated
        FROM part""",
    "scalar_time_ops": """
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso, strftime(ts, '%Y%m%d_%H%M%S') AS compact,
               date_diff('microsecond', date_trunc('day', ts), ts) / CAST(1e6 AS DOUBLE) AS elapsed
        FROM events""",
    "scalar_array_ops": """
        WITH wide AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vals FROM embeddings)
        SELECT vec_id, vals[1] AS first, vals[-1] AS last, CAST(len(vals) AS INTEGER) AS n,
               vals[len(vals) - 9:] AS tail, CAST(len(vals) + 1 AS INTEGER) AS n_appended,
               vals[1001] AS out_of_range
        FROM wide""",
    "scalar_json_ops": """
        SELECT event_id, json_extract(props, '$.k') IS NOT NULL AS has_key, CAST(-1 AS INTEGER) AS with_default,
               CAST(to_json({'event_type': event_type, 'k': CAST(json_extract_string(props, '$.k') AS INTEGER)})
                    AS VARCHAR) AS json
        FROM events""",
}
