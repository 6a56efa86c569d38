"""Device telemetry: snapshots, statistics, count blocks, throttling, as-of lookups.

A series is a set of rows sharing ``keys`` (run, device), ordered by a timestamp
and an id that breaks ties. Operators that need that order accept one key
holding most of the data; see ``hot_keys``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusflow.functions.values import micros
from corpusflow.operators.hot_keys import index_within, join_small, split_hot_keys, tie_number
from corpusflow.settings import BLOCK_SIZE, ROWS_PER_CHUNK, THROTTLE_SECONDS
from corpusflow.sources.device_log import SAMPLE_FIELDS

NEVER = -(1 << 62)


def snapshot_means(samples: DataFrame, keys: list[str | Column], value: str = "utilization_gpu") -> DataFrame:
    """Mean over the devices of each snapshot."""
    return samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_samples"), F.avg(value).alias("avg_utilization"))


def utilization_stats(samples: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean, minimum and maximum of each series; a series without samples has no row."""
    return (
        samples.where(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(
            F.avg(value).alias("avg_utilization"),
            F.min(value).alias("min_utilization"),
            F.max(value).alias("max_utilization"),
        )
    )


def latest_value(samples: DataFrame, keys: list[str], value: str, ts: str, tie: str) -> DataFrame:
    """The newest row's value per series, as a partial aggregate (no sort)."""
    return samples.groupBy(*keys).agg(
        F.max_by(F.struct(F.col(value), F.col(ts)), F.struct(ts, tie)).alias("_last")
    ).select(*keys, F.col(f"_last.{value}").alias(value), F.col(f"_last.{ts}").alias(ts))


def nest_snapshots(samples: DataFrame, snapshot: str, host: str) -> DataFrame:
    """Snapshot documents ``timestamp, host, gpus, avg_utilization``: one for each probe of a host.

    A document is as long as its host has devices. Means over all hosts of a
    probe are those of :func:`snapshot_means`.
    """
    return (
        samples.groupBy(F.col(snapshot).alias("timestamp"), F.col(host).alias("host"))
        .agg(
            F.array_sort(F.collect_list(F.struct(*SAMPLE_FIELDS))).alias("gpus"),
            F.avg("utilization_gpu").alias("avg_utilization"),
        )
    )


def union_history(*histories: DataFrame) -> DataFrame:
    """Append histories, duplicates kept."""
    first, *rest = histories
    for other in rest:
        first = first.unionByName(other)
    return first


def lookup_device(ranks: DataFrame, samples: DataFrame, local_rank: str, index: str) -> DataFrame:
    """The reading of each rank's own device, NULL when there is none.

    Spark broadcasts ``samples`` when it is small enough and splits skewed
    ranks otherwise.
    """
    return ranks.join(samples, ranks[local_rank] == samples[index], "left")


def asof_last(
    records: DataFrame,
    samples: DataFrame,
    keys: list[str],
    value: str,
    ts: str,
    tie: str,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Each record with the latest earlier (or simultaneous, lower ``tie``) sample of its series.

    ``value`` is NULL while there is no sample yet.
    """
    order = ["_us", tie]
    left = records.select("*", F.lit(None).cast(samples.schema[value].dataType).alias(value), F.lit(False).alias("_sample"))
    right = samples.select(*keys, ts, tie, value, F.lit(True).alias("_sample"))
    series = left.unionByName(right, allowMissingColumns=True)
    series = series.withColumn("_us", micros(series, ts))
    split = split_hot_keys(series, keys, "_us", rows_per_chunk, tie=tie_number(series, order))

    # what each slice of a hot series inherits from the slices before it
    ends = (
        split.where(F.col("chunk").isNotNull())
        .groupBy(*keys, "chunk")
        .agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_end"))
    )
    earlier = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    inherited = ends.select(*keys, "chunk", F.last("_end", ignorenulls=True).over(earlier).alias("_inherited"))

    so_far = Window.partitionBy(*keys, "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = split.withColumn(value, F.last(value, ignorenulls=True).over(so_far)).where(~F.col("_sample"))
    return (
        join_small(filled, inherited, [*keys, "chunk"])
        .withColumn(value, F.coalesce(value, "_inherited"))
        .select(*records.columns, value)
    )


def block_means(
    samples: DataFrame,
    keys: list[str],
    value: str,
    ts: str,
    tie: str,
    size: int = BLOCK_SIZE,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Mean of every full block of ``size`` consecutive samples, tagged with the last one's time and id.

    An incomplete last block is not reported.
    """
    indexed = index_within(samples.withColumn("_us", micros(samples, ts)), keys, ["_us", tie], "_us", rows_per_chunk)
    return (
        indexed.groupBy(*keys, F.expr(f"idx div {size}").alias("block"))
        .agg(
            F.avg(value).alias("block_mean"),
            F.max(F.struct("_us", ts, tie)).alias("_end"),
            F.count(F.lit(1)).alias("_n"),
        )
        .where(F.col("_n") == size)
        .select(*keys, "block", "block_mean", F.col(f"_end.{ts}").alias(ts), F.col(f"_end.{tie}").alias(tie))
    )


def trailing_means(
    samples: DataFrame,
    keys: list[str],
    value: str,
    ts: str,
    tie: str,
    size: int = BLOCK_SIZE,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Mean of the last ``size`` samples at each sample that has that many.

    Rows are shuffled once. Only the first ``size - 1`` rows of a slice of a hot
    series look back beyond their slice; they are computed among the few rows
    on either side of the cuts.
    """
    timed = samples.withColumn("_us", micros(samples, ts))
    split = split_hot_keys(timed, keys, "_us", rows_per_chunk, tie=tie_number(timed, ["_us", tie]))
    piece = Window.partitionBy(*keys, "chunk")
    forward = piece.orderBy("_us", tie)
    backward = piece.orderBy(F.desc("_us"), F.desc(tie))
    mean = F.avg(value)
    inside = (
        split.withColumn("_place", F.row_number().over(forward))
        .withColumn("trailing_mean", mean.over(forward.rowsBetween(-(size - 1), 0)))
        .where(F.col("_place") >= size)
    )
    near_cuts = (
        split.where(F.col("chunk").isNotNull())
        .withColumn("_place", F.row_number().over(forward))
        .withColumn("_from_end", F.row_number().over(backward))
        .where((F.col("_place") < size) | (F.col("_from_end") < size))
    )
    across = Window.partitionBy(*keys).orderBy("_us", tie).rowsBetween(-(size - 1), 0)
    heads = (
        near_cuts.withColumn("trailing_mean", mean.over(across))
        .withColumn("_n", F.count(F.lit(1)).over(across))
        .where((F.col("_place") < size) & (F.col("_n") == size))
    )
    columns = [*samples.columns, "trailing_mean"]
    return inside.select(columns).unionByName(heads.select(columns))


# -- throttle ---------------------------------------------------------------


def kept_places(us: np.ndarray, last: int, gap: int) -> np.ndarray:
    """Places in a sorted array that lie more than ``gap`` after the previously kept one.

    A row more than the gap after its predecessor is always kept, whatever was
    kept before. From these rows on, the next kept ones are found for all
    sessions at a time by doubling the steps taken.
    """
    n = len(us)
    first = int(np.searchsorted(us, last + gap, side="right"))
    if first == n:
        return np.empty(0, np.int64)
    kept = np.zeros(n + 1, bool)
    kept[[first, n]] = True
    kept[first + 1 : n] = us[first + 1 :] - us[first:-1] > gap
    if not kept[first:n].all():
        jump = np.append(np.searchsorted(us, us + gap, side="right"), n)
        while True:
            reached = jump[np.flatnonzero(kept)]
            if kept[reached].all():
                break
            kept[reached] = True
            jump = jump[jump]
    return np.flatnonzero(kept[:n])


def chunk_exits(us: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """What a sorted slice does to the last kept time.

    Returns ``(upto, exit)``: if the time kept before the slice plus ``gap`` is
    below ``upto[i]`` (the first such i), the last time kept in the slice is
    ``exit[i]``. Beyond the last entry the slice keeps nothing.
    """
    n = len(us)
    following = np.searchsorted(us, us + gap, side="right")
    end = np.where(following == n, np.arange(n), following)
    while True:
        further = end[end]
        if np.array_equal(further, end):
            break
        end = further
    entries = min(int(np.searchsorted(us, us[0] - 1 + gap, side="right")) + 1, n)
    upto, leaves = us[:entries], us[end[:entries]]
    last_of_run = np.append(leaves[1:] != leaves[:-1], True)
    return upto[last_of_run], leaves[last_of_run]


def throttle(
    samples: DataFrame,
    keys: list[str],
    ts: str,
    tie: str,
    seconds: float = THROTTLE_SECONDS,
    start: Column | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Keep a sample only if it comes more than ``seconds`` after the last kept one of its series.

    The first sample of a series is kept, or measured against ``start`` (one
    time in microseconds per series) when given. A sample without a time is
    after nothing and is not kept. Whether a row is kept depends on all rows before it, which windows
    cannot express; sorted partitions are scanned once in Arrow batches with a
    single carried time. Series too long for one task are cut into slices: a
    first pass over their timestamps finds what each slice does to the last
    kept time, those few numbers are chained per series, and the scan then runs
    on all slices in parallel.
    """
    gap = int(round(seconds * 1_000_000))
    columns = samples.columns
    series = samples.withColumn("_us", micros(samples, ts)).where("_us IS NOT NULL")
    if start is not None:
        series = series.where(F.coalesce(F.col("_us") - start > gap, F.lit(True)))
    split = split_hot_keys(
        series, keys, "_us", rows_per_chunk, min_width=8 * gap, tie=tie_number(series, ["_us", tie])
    )
    entries = _slice_entries(split.where(F.col("chunk").isNotNull()), keys, gap)
    local = Window.partitionBy(*keys, "chunk").orderBy("_us", tie)
    ready = (
        join_small(split, entries, [*keys, "chunk"])
        .withColumn("_entry", F.coalesce("_entry", F.lit(NEVER)))
        .withColumn("_first", F.row_number().over(local) == 1)
        .select(*columns, "_us", "_entry", "_first")
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = NEVER
        for batch in batches:
            us = batch.column("_us").to_numpy(zero_copy_only=False)
            entry = batch.column("_entry").to_numpy(zero_copy_only=False)
            first = batch.column("_first").to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(first)
            bounds = np.unique(np.concatenate(([0], heads, [len(us)])))
            mask = np.zeros(len(us), dtype=bool)
            for a, b in zip(bounds[:-1], bounds[1:]):
                if first[a]:
                    last = int(entry[a])
                places = kept_places(us[a:b], last, gap)
                if len(places):
                    mask[a + places] = True
                    last = int(us[a + places[-1]])
            yield batch.select(columns).filter(pa.array(mask))

    return ready.mapInArrow(keep, samples.schema)


def _slice_entries(hot: DataFrame, keys: list[str], gap: int) -> DataFrame:
    """Last kept time before each slice of a hot series (``keys``, ``chunk``, ``_entry``).

    Slices are much longer than the gap, so what they do to the last kept time
    takes few numbers; these are scanned in order, in constant memory.
    """
    key_fields = [hot.schema[k] for k in keys]
    long = LongType()
    effect_schema = StructType([*key_fields, *[StructField(c, long) for c in ("chunk", "_upto", "_exit")]])
    entry_schema = StructType([*key_fields, *[StructField(c, long) for c in ("chunk", "_entry")]])

    def effects(rows: pd.DataFrame) -> pd.DataFrame:
        upto, leaves = chunk_exits(np.sort(rows["_us"].to_numpy()), gap)
        head = rows.iloc[[0] * len(upto)][[*keys, "chunk"]].reset_index(drop=True)
        return head.assign(_upto=upto, _exit=leaves)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, entry, current, found = NEVER, NEVER, None, False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            chunk, upto, leaves, first = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("chunk", "_upto", "_exit", "_first")
            )
            cuts = np.flatnonzero((chunk[1:] != chunk[:-1]) | first[1:]) + 1
            heads, entries = [], []
            for a, b in zip([0, *cuts], [*cuts, len(chunk)]):
                if first[a]:
                    last, current = NEVER, None
                if chunk[a] != current:  # else the slice goes on from the previous batch
                    current, entry, found = chunk[a], last, False
                    heads.append(a)
                    entries.append(entry)
                if not found:
                    i = a + int(np.searchsorted(upto[a:b], entry + gap, side="right"))
                    if i < b:
                        last, found = int(leaves[i]), True
            slices = batch.select([*keys, "chunk"]).take(pa.array(heads, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*slices.columns, pa.array(entries, pa.int64())], names=[*keys, "chunk", "_entry"]
            )

    in_order = Window.partitionBy(*keys).orderBy("chunk", "_upto")
    return (
        hot.select(*keys, "chunk", "_us")
        .groupBy(*keys, "chunk")
        .applyInPandas(effects, effect_schema)
        .withColumn("_first", F.row_number().over(in_order) == 1)
        .mapInArrow(chain, entry_schema)
    )
