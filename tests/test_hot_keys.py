"""Keys that hold most rows: missing times, one shared time, crowded times; same rows on both paths."""

import datetime
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.functions import values as v
from corpusflow.operators import telemetry as tm
from corpusflow.operators.hot_keys import split_hot_keys

EPOCH = datetime.datetime(2024, 1, 1)
SCHEMA = "device int, id bigint, ts timestamp_ntz, value double"
N, LIMIT = 400, 20


def moment(us):
    return None if us is None else EPOCH + datetime.timedelta(microseconds=int(us))


SHAPES = {
    "missing": [None if i % 80 == 0 else 1_000_000 * i for i in range(N)],
    "shared": [5_000_000] * N,
    "half_shared": [5_000_000 if i % 2 else 50_000 * i for i in range(N)],
    "log_spaced": [int(1.05**i) * 1000 for i in range(N)],
}


def order_key(r):
    return (r[2] is not None, r[2] or EPOCH, r[1])


def rows_of(shape):
    rows = [(0, i, moment(us), None if i % 7 == 0 else float(i % 50)) for i, us in enumerate(SHAPES[shape])]
    return rows + [(1, N + i, moment(1_000_000 * i), 1.0) for i in range(12)]


@pytest.fixture(scope="module", params=sorted(SHAPES))
def case(request, spark):
    rows = rows_of(request.param)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def groups(rows):
    return [sorted((r for r in rows if r[0] == d), key=order_key) for d in (0, 1)]


def mean(values):
    known = [x for x in values if x is not None]
    return round(sum(known) / len(known), 6) if known else None


def test_no_slice_is_much_too_large(case):
    rows, df = case
    timed = df.withColumn("_us", v.micros(df, "ts"))
    split = split_hot_keys(timed, ["device"], "_us", LIMIT, tie="id")
    sizes = split.where("chunk IS NOT NULL").groupBy("chunk").agg(F.count("*").alias("n"), F.min(F.struct("_us", "id")).alias("lo"), F.max(F.struct("_us", "id")).alias("hi"))
    found = sizes.orderBy("chunk").collect()
    assert sum(r.n for r in found) == N and max(r.n for r in found) <= 3 * LIMIT
    places = [tuple((x is not None, x or 0) for x in end) for r in found for end in (r.lo, r.hi)]
    assert places == sorted(places)  # slices follow one another in the order of the key


@pytest.mark.parametrize("chunk", [10_000, LIMIT])
def test_blocks_and_trailing_means(case, chunk):
    rows, df = case
    want = {(g[0][0], b): mean([r[3] for r in g[10 * b : 10 * b + 10]]) for g in groups(rows) for b in range(len(g) // 10)}
    found = tm.block_means(df, ["device"], "value", "ts", "id", rows_per_chunk=chunk).collect()
    assert {(r.device, r.block): None if r.block_mean is None else round(r.block_mean, 6) for r in found} == want
    want = {g[i][1]: mean([r[3] for r in g[i - 9 : i + 1]]) for g in groups(rows) for i in range(9, len(g))}
    found = tm.trailing_means(df, ["device"], "value", "ts", "id", rows_per_chunk=chunk).collect()
    assert {r.id: None if r.trailing_mean is None else round(r.trailing_mean, 6) for r in found} == want


@pytest.mark.parametrize("chunk", [10_000, LIMIT])
def test_asof_and_throttle(case, chunk):
    rows, df = case
    records, samples = df.where("id % 3 <> 0").drop("value"), df.where("id % 3 = 0")
    want = {}
    for g in groups(rows):
        last = None
        for r in g:
            if r[1] % 3 == 0:
                last = r[3] if r[3] is not None else last
            else:
                want[r[1]] = last
    found = tm.asof_last(records, samples, ["device"], "value", "ts", "id", rows_per_chunk=chunk).collect()
    assert {r.id: r.value for r in found} == want
    kept = []
    for g in groups(rows):
        last = None
        for r in g:
            if r[2] is not None and (last is None or r[2] - last > datetime.timedelta(seconds=3)):
                kept.append(r[1])
                last = r[2]
    found = tm.throttle(df, ["device"], "ts", "id", seconds=3, rows_per_chunk=chunk).collect()
    assert sorted(r.id for r in found) == sorted(kept)


def test_without_hot_keys_nothing_is_added(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = tm.block_means(events, ["user_id"], "value", "ts", "event_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Relation") == 1


def test_walks_take_array_operations():
    sparse = np.arange(1_000_000, dtype=np.int64) * 10
    dense = np.arange(1_000_000, dtype=np.int64)
    for us, gap, want in ((sparse, 5, 1_000_000), (dense, 9, 100_000)):
        best = 9.0
        for _ in range(3):
            began = time.process_time()
            assert len(tm.kept_places(us, tm.NEVER, gap)) == want
            best = min(best, time.process_time() - began)
        assert best < (0.2 if gap == 5 else 2)
