"""Device samples: headerless CSV lines without units, and the snapshots built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.values import mib_to_gib
from corpusflow.settings import DEVICE_FIELDS

SAMPLE_FIELDS = (
    "index",
    "name",
    "utilization_gpu",
    "utilization_memory",
    "memory_used_gb",
    "memory_total_gb",
    "temperature",
    "power_draw",
)

SAMPLE_SCHEMA = (
    "index INT, name STRING, utilization_gpu DOUBLE, utilization_memory DOUBLE, "
    "memory_used_gb DOUBLE, memory_total_gb DOUBLE, temperature DOUBLE, power_draw DOUBLE"
)

SNAPSHOT_SCHEMA = f"timestamp TIMESTAMP_NTZ, host BIGINT, gpus ARRAY<STRUCT<{SAMPLE_SCHEMA}>>, avg_utilization DOUBLE"


def read_device_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def probe_lines(df: DataFrame, output: str = "output") -> DataFrame:
    """One row per line of each probe's printed output; other columns are repeated."""
    keep = [c for c in df.columns if c != output]
    return df.select(*keep, F.explode(F.split(output, "\n")).alias("line"))


def parse_device_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """The eight sample columns plus ``ok``; columns other than ``line`` are kept.

    Blank lines and lines with fewer than eight fields are skipped. ``ok`` is
    false where a number cannot be read. Works on batch and streaming input.
    """
    keep = [c for c in df.columns if c != line]
    # Exploding the (zero or one) field list keeps the optimizer from splitting
    # the line again for every condition placed on a field.
    split = F.when(F.trim(line) != "", F.array(F.split(F.trim(line), r"\s*,\s*")))
    fields = df.select(*keep, F.explode(F.filter(split, lambda f: F.size(f) >= DEVICE_FIELDS)).alias("_f"))

    def number(i: int) -> Column:
        return F.col("_f")[i].try_cast("double")

    sample = fields.select(
        *keep,
        F.col("_f")[0].try_cast("int").alias("index"),
        F.col("_f")[1].alias("name"),
        number(2).alias("utilization_gpu"),
        number(3).alias("utilization_memory"),
        mib_to_gib(number(4)).alias("memory_used_gb"),
        mib_to_gib(number(5)).alias("memory_total_gb"),
        number(6).alias("temperature"),
        number(7).alias("power_draw"),
    )
    readable = F.lit(True)
    for name in SAMPLE_FIELDS:
        readable = readable & F.col(name).isNotNull()
    return sample.withColumn("ok", readable)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("ok").drop("ok")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("ok")).drop("ok")


def strict_snapshots(parsed: DataFrame, snapshot: str) -> DataFrame:
    """Samples of the snapshots in which every line could be read.

    The verdicts are aggregated before the shuffle and anti-joined, so a large
    snapshot is never gathered in one task (AQE splits its side of the join).
    """
    broken = parsed.where(~F.col("ok")).select(F.col(snapshot).alias("_broken")).distinct()
    return accepted(parsed.join(broken, F.col(snapshot) == F.col("_broken"), "left_anti"))


# JSON keeps timestamps to the microsecond
HISTORY_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def append_history(snapshots: DataFrame, path: str) -> None:
    """Add snapshot documents to a JSON history; what is there is never rewritten."""
    snapshots.write.mode("append").options(**HISTORY_OPTIONS).json(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SNAPSHOT_SCHEMA).options(**HISTORY_OPTIONS).json(path)
