"""Column functions on numbers, times, names and small collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampType

# zones in which a calendar time is an instant, so that the cheap conversion is exact
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def mib_to_gib(value: Column) -> Column:
    """Device memory: mebibytes to gibibytes."""
    return value / 1024


def bytes_to_gb(value: Column) -> Column:
    """Process memory: bytes to decimal gigabytes. Not the same unit as :func:`mib_to_gib`."""
    return value / 1e9


def fill_missing(value: Column, default: float = 0.0) -> Column:
    return F.coalesce(value, F.lit(default))


def pick_by_rank(values: Column, rank: Column) -> Column:
    """The entry at a 0-based rank; NULL where the rank is out of range."""
    return F.when(rank >= 0, F.get(values, rank))


def micros(df: DataFrame, ts: str) -> Column:
    """A timestamp column, with or without time zone, as an integer for exact comparison.

    A timestamp without time zone is counted from its own calendar fields, so
    the session's time zone and its clock changes play no part.
    """
    if isinstance(df.schema[ts].dataType, TimestampType):
        return F.unix_micros(ts)
    if df.sparkSession.conf.get("spark.sql.session.timeZone") in UTC_NAMES:
        return F.unix_micros(F.col(ts).cast("timestamp"))
    days = F.unix_date(F.col(ts).cast("date")).cast("bigint")
    minutes = days * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), F.col(ts)) * 1_000_000).cast("bigint")


def from_micros(us: str, kind: DataType) -> Column:
    """The inverse of :func:`micros`."""
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(us)
    return F.expr(f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST({us} AS DECIMAL(20, 0)) / 1000000)")


def elapsed_seconds(start: str, end: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {start}, {end})") / 1e6


def iso_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def run_name(ts: Column) -> Column:
    return F.concat(F.lit("fine_tuning_"), F.date_format(ts, "yyyyMMdd_HHmmss"))


def registered_name(model_name: Column) -> Column:
    return F.concat(F.replace(model_name, F.lit("/"), F.lit("_")), F.lit("_fine_tuned"))


def last_entries(values: Column, n: int) -> Column:
    """The trailing ``n`` entries, or all of them when there are fewer."""
    return F.slice(values, F.greatest(F.size(values) - (n - 1), F.lit(1)), n)


def batch_size_estimate(model_gb: float, device_gb: float, length: Column) -> Column:
    """Samples that fit on a device: 80 % of its memory over weights, gradients and activations; at least 1."""
    per_sample = F.lit(model_gb * 3) + length * F.lit(0.001)
    return F.greatest(F.lit(1), (F.lit(device_gb * 0.8) / per_sample).cast("int"))
