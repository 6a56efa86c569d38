from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(name: str, digits: int = 6) -> Column:
    """Float aggregates depend on the order of addition in their last bits; compare them rounded."""
    return F.round(name, digits).alias(name)
