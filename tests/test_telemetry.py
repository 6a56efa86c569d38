"""Ordered operators against brute force, with and without hot keys."""

import datetime
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions import values as v
from corpusflow.operators import telemetry as tm
from corpusflow.operators.hot_keys import index_within, split_hot_keys

EPOCH = datetime.datetime(2024, 1, 1)
SCHEMA = "device int, id bigint, ts timestamp_ntz, value double"


def at(seconds):
    return EPOCH + datetime.timedelta(microseconds=round(seconds * 1e6))


def series(seed=1, n=400, ties=True):
    """One device with two thirds of the rows, some sparse ones, a NULL device, repeated times."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        device = 0 if rng.random() < 0.66 else rng.choice([1, 2, 3, None])
        seconds = rng.choice([rng.uniform(0, 400), rng.randint(0, 60) if ties else rng.uniform(0, 60)])
        rows.append((device, i, at(seconds), float(rng.randint(0, 100))))
    return rows


def by_device(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1])):
        groups.setdefault(r[0], []).append(r)
    return groups


CHUNKS = [10_000, 50, 7]


@pytest.fixture(scope="module")
def rows():
    return series()


@pytest.fixture(scope="module")
def samples(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("chunk", CHUNKS)
def test_index_within(samples, rows, chunk):
    df = samples.withColumn("_us", v.micros(samples, "ts"))
    found = {r.id: r.idx for r in index_within(df, ["device"], ["_us", "id"], "_us", chunk).collect()}
    assert found == {r[1]: i for group in by_device(rows).values() for i, r in enumerate(group)}


def test_crowded_slices_are_cut_again(spark):
    """Nearly all rows of the hot key within a thousandth of its span."""
    rows = [(0, i, at(1000 if i == 0 else 500 + i / 2000), 1.0) for i in range(2000)] + [(1, 5000, at(0), 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumn("_us", v.micros(df, "ts"))
    split = split_hot_keys(df, ["device"], "_us", 100)
    sizes = {r["chunk"]: (r["n"], r["lo"], r["hi"]) for r in split.groupBy("chunk").agg(
        F.count("*").alias("n"), F.min("_us").alias("lo"), F.max("_us").alias("hi")).collect()}
    assert sizes.pop(None)[0] == 1
    assert sum(n for n, _, _ in sizes.values()) == 2000 and max(n for n, _, _ in sizes.values()) <= 200
    ordered = [sizes[c] for c in sorted(sizes)]
    assert all(a[2] < b[1] for a, b in zip(ordered, ordered[1:]))


@pytest.mark.parametrize("chunk", CHUNKS)
def test_block_means(samples, rows, chunk):
    found = tm.block_means(samples, ["device"], "value", "ts", "id", rows_per_chunk=chunk).collect()
    expected = {}
    for device, group in by_device(rows).items():
        for b in range(len(group) // 10):
            part = group[10 * b : 10 * b + 10]
            expected[device, b] = (sum(r[3] for r in part) / 10, part[-1][2], part[-1][1])
    assert {(r.device, r.block): (pytest.approx(r.block_mean), r.ts, r.id) for r in found} == expected


@pytest.mark.parametrize("chunk", CHUNKS)
def test_trailing_means(samples, rows, chunk):
    found = tm.trailing_means(samples, ["device"], "value", "ts", "id", rows_per_chunk=chunk).collect()
    expected = {}
    for group in by_device(rows).values():
        for i in range(9, len(group)):
            expected[group[i][1]] = sum(r[3] for r in group[i - 9 : i + 1]) / 10
    assert {r.id: pytest.approx(r.trailing_mean) for r in found} == expected


def brute_throttle(group, gap, last=None):
    kept = []
    for r in group:
        if last is None or r[2] - last > datetime.timedelta(seconds=gap):
            kept.append(r[1])
            last = r[2]
    return kept


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("gap", [0.5, 5, 90])
def test_throttle(samples, rows, chunk, gap):
    found = tm.throttle(samples, ["device"], "ts", "id", seconds=gap, rows_per_chunk=chunk)
    assert found.columns == samples.columns
    expected = [i for group in by_device(rows).values() for i in brute_throttle(group, gap)]
    assert sorted(r.id for r in found.collect()) == sorted(expected)


@pytest.mark.parametrize("batch", [10_000, 2])
def test_throttle_of_dense_series(spark, batch):
    """Slices shorter than the gap, a device of its own in each partition, tiny Arrow batches."""
    rng = random.Random(5)
    rows = [(d, i, at(rng.uniform(0, 60)), 0.0) for i in range(600) for d in [rng.choice([0, 0, 0, 1])]]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        kept = {
            gap: sorted(r.id for r in tm.throttle(df, ["device"], "ts", "id", seconds=gap, rows_per_chunk=20).collect())
            for gap in (0.01, 0.7, 20)
        }
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for gap, found in kept.items():
        assert found == sorted(i for group in by_device(rows).values() for i in brute_throttle(group, gap))


def test_throttle_literal(spark):
    df = spark.createDataFrame([(1, i, at(t), 0.0) for i, t in enumerate([0, 2, 4, 5, 6, 11, 12])], SCHEMA)
    kept = tm.throttle(df, ["device"], "ts", "id").collect()
    assert sorted((r.ts - EPOCH).seconds for r in kept) == [0, 6, 12]


@pytest.mark.parametrize("chunk", [100, 3])
def test_throttle_measured_from_a_start(spark, chunk):
    rows = [(1, i, at(t), 0.0) for i, t in enumerate([0, 2, 4, 5, 6, 11, 12])]
    df = spark.createDataFrame(rows, SCHEMA)
    start = F.lit(int((EPOCH - datetime.datetime(1970, 1, 1)).total_seconds()) * 1_000_000 + 500_000)
    kept = tm.throttle(df, ["device"], "ts", "id", start=start, rows_per_chunk=chunk).collect()
    assert sorted(r.id for r in kept) == brute_throttle(rows, 5, at(0.5)) == [4, 6]


@settings(max_examples=300, deadline=None)
@given(
    times=st.lists(st.integers(0, 120), min_size=1, max_size=60),
    cuts=st.lists(st.integers(0, 121), max_size=5),
    gap=st.integers(0, 50),
)
def test_chained_slices_equal_one_scan(times, cuts, gap):
    us = np.sort(np.array(times, dtype=np.int64))
    whole = us[tm.kept_places(us, tm.NEVER, gap)].tolist()
    gaps = np.diff(whole)
    assert (gaps > gap).all()

    pieces = np.split(us, np.searchsorted(us, sorted(set(cuts))))
    last, kept = tm.NEVER, []
    for piece in pieces:
        if len(piece) == 0:
            continue
        kept += piece[tm.kept_places(piece, last, gap)].tolist()
        upto, leaves = tm.chunk_exits(piece, gap)
        i = int(np.searchsorted(upto, last + gap, side="right"))
        last = int(leaves[i]) if i < len(upto) else last
        assert last == (kept[-1] if kept else tm.NEVER)
    assert kept == whole


@pytest.mark.parametrize("chunk", CHUNKS)
def test_asof(samples, rows, chunk):
    is_sample = F.col("id") % 5 == 0
    records = samples.where(~is_sample).select("device", "id", "ts")
    measured = samples.where(is_sample).withColumnRenamed("value", "load")
    found = tm.asof_last(records, measured, ["device"], "load", "ts", "id", rows_per_chunk=chunk)
    assert found.columns == ["device", "id", "ts", "load"]
    expected = {}
    for group in by_device(rows).values():
        last = None
        for r in group:
            if r[1] % 5 == 0:
                last = r[3]
            else:
                expected[r[1]] = last
    assert {r.id: r.load for r in found.collect()} == expected
    assert None in expected.values()


def test_asof_skips_missing_samples(spark):
    rows = [(1, 0, at(0), 7.0), (1, 1, at(1), None)]
    measured = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("value", "load")
    records = spark.createDataFrame([(1, 2, at(2))], "device int, id bigint, ts timestamp_ntz")
    for chunk in (10, 1):
        [row] = tm.asof_last(records, measured, ["device"], "load", "ts", "id", rows_per_chunk=chunk).collect()
        assert row.load == 7.0


def test_statistics_and_latest(spark):
    rows = [(1, 0, at(0), 1.0), (1, 1, at(5), 3.0), (1, 2, at(2), 8.0), (2, 3, at(1), None)]
    df = spark.createDataFrame(rows, SCHEMA)
    [stats] = tm.utilization_stats(df, ["device"], "value").collect()
    assert stats[0] == 1 and tuple(stats)[1:] == (4.0, 1.0, 8.0)
    latest = {r.device: (r.value, r.ts) for r in tm.latest_value(df, ["device"], "value", "ts", "id").collect()}
    assert latest == {1: (3.0, at(5)), 2: (None, at(1))}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_micros_counts_calendar_time_in_any_time_zone(spark, zone):
    moments = [datetime.datetime(2024, 3, 31, 2, 30, 0, 5), datetime.datetime(1969, 12, 31, 23, 59, 59, 999999)]
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", zone)
    df = session.createDataFrame([(m,) for m in moments], "ts timestamp_ntz")
    us = df.select("ts", v.micros(df, "ts").alias("us"))
    back = us.select("us", v.from_micros("us", df.schema["ts"].dataType).alias("ts")).collect()
    epoch = datetime.datetime(1970, 1, 1)
    assert [(r.us, r.ts) for r in back] == [((m - epoch) // datetime.timedelta(microseconds=1), m) for m in moments]


def test_ordinary_keys_are_shuffled_once(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", "ts", "value")
    plan = tm.throttle(events, ["user_id"], "ts", "event_id")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "SortMergeJoin" not in plan and "Cartesian" not in plan
    scan_branch = plan[: plan.index("BroadcastExchange")]
    assert scan_branch.count("Exchange hashpartitioning") <= 1


def test_values(spark):
    df = spark.createDataFrame([([1.0, 2.0], 1), ([1.0, 2.0], 2), ([1.0, 2.0], -1)], "a array<double>, r int")
    assert [r[0] for r in df.select(v.pick_by_rank(F.col("a"), F.col("r"))).collect()] == [2.0, None, None]
    row = spark.range(1).select(
        v.mib_to_gib(F.lit(1024)).alias("gib"),
        v.bytes_to_gb(F.lit(2_000_000_000)).alias("gb"),
        v.fill_missing(F.lit(None).cast("double")).alias("filled"),
        v.registered_name(F.lit("org/base/7b")).alias("registered"),
        v.run_name(F.lit(EPOCH).cast("timestamp_ntz")).alias("run"),
        v.iso_timestamp(F.lit(datetime.datetime(2024, 1, 2, 3, 4, 5, 60)).cast("timestamp_ntz")).alias("iso"),
        v.last_entries(F.array(*[F.lit(i) for i in range(12)]), 10).alias("tail"),
        v.last_entries(F.array(F.lit(1)), 10).alias("short"),
    ).head()
    assert (row.gib, row.gb, row.filled) == (1.0, 2.0, 0.0)
    assert row.registered == "org_base_7b_fine_tuned" and row.run == "fine_tuning_20240101_000000"
    assert row.iso == "2024-01-02T03:04:05.000060" and row.tail == list(range(2, 12)) and row.short == [1]
