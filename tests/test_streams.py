"""Streams give the batch result, over several micro-batches and across restarts."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import telemetry as tm
from corpusflow.streaming import series as sr
from corpusflow.streaming import streams as st

GAP = 4 * 3600


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


@pytest.fixture(scope="module")
def days(spark, events, tmp_path_factory):
    """The events as one file per five days, named and dated in time order."""
    base = tmp_path_factory.mktemp("days")
    rows = events.withColumn("part", F.expr("(day(ts) - 1) div 5"))
    files = []
    for part in range(6):
        out = base / f"write{part}"
        rows.where(F.col("part") == part).drop("part").coalesce(1).write.parquet(str(out))
        [file] = out.glob("*.parquet")
        target = base / f"day{part}.parquet"
        shutil.copy(file, target)
        os.utime(target, (1_700_000_000 + part, 1_700_000_000 + part))
        files.append(target)
    return files


def land(files, where):
    where.mkdir(exist_ok=True)
    for f in files:
        shutil.copy2(f, where / f.name)


def bag(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def mixed(spark, events, tmp_path_factory):
    """The events as four files that each span the whole time, with rows without a value and two runs as a second key."""
    base = tmp_path_factory.mktemp("mixed")
    rows = events.withColumn("value", F.when(F.col("event_id") % 3 > 0, F.col("value"))).withColumn(
        "run", F.expr("CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END")
    )
    files = []
    for part in range(4):
        out = base / f"write{part}"
        rows.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == part).coalesce(1).write.parquet(str(out))
        [file] = out.glob("*.parquet")
        target = base / f"part{part}.parquet"
        shutil.copy(file, target)
        os.utime(target, (1_700_000_000 + part, 1_700_000_000 + part))
        files.append(target)
    return rows, files


KEYS = ["run", "user_id"]
STEPS = {
    "throttle": sr.Throttle(KEYS, "ts", "event_id", seconds=GAP),
    "blocks": sr.BlockMeans(KEYS, "value", "ts", "event_id", size=3),
}
HOUR = 3600


def batch_of(name, rows):
    if name == "throttle":
        return tm.throttle(rows, KEYS, "ts", "event_id", seconds=GAP)
    if name == "blocks":
        return tm.block_means(rows, KEYS, "value", "ts", "event_id", size=3)
    hours = rows.withColumn("snapshot", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return tm.snapshot_means(hours, ["snapshot", "event_type"], "value")


def rounded_bag(df, columns):
    return sorted(
        (tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.select(columns).collect()), key=repr
    )


class Sitting:
    """One of the ordered streams over a landing folder: run it as often as files arrive."""

    def __init__(self, spark, base, schema, name, delay, per_trigger):
        self.spark, self.base, self.schema, self.name = spark, base, schema, name
        self.delay, self.per_trigger = delay, per_trigger
        self.landing, self.session = base / "landing", st.stream_session(spark, 3)

    def _arriving(self):
        return st.read_landing(self.session, str(self.landing), self.schema, files_per_trigger=self.per_trigger)

    def run(self):
        if self.name == "means":
            means = sr.window_means(self._arriving(), ["event_type"], "value", "ts", HOUR, self.delay)
            st.run(means, f"{self.base}/out", f"{self.base}/checkpoint")
            late = sr.late_by_window(self._arriving(), "ts", HOUR, self.delay)
            return sr.run(late, f"{self.base}/late", f"{self.base}/late-checkpoint")
        rows = sr.in_order(self._arriving(), self.delay, STEPS[self.name])
        return sr.run(rows, f"{self.base}/out", f"{self.base}/checkpoint")

    def end(self):
        sr.end_of_stream(self.spark, self.schema, "ts", str(self.landing), 2 * self.delay + 2 * HOUR)
        return self.run()

    def results(self):
        if self.name == "means":
            return self.spark.read.parquet(f"{self.base}/out")
        return sr.results(self.spark, f"{self.base}/out", STEPS[self.name], self.schema)

    def late(self):
        out = f"{self.base}/late" if self.name == "means" else f"{self.base}/out"
        return sr.late_rows(self.spark, out, self.schema)


ORDERED = ["blocks", "means", "throttle"]


@pytest.mark.parametrize("per_trigger", [1, 4])
@pytest.mark.parametrize("name", ORDERED)
def test_any_cut_gives_the_batch_result(spark, mixed, tmp_path, name, per_trigger):
    rows, files = mixed
    sitting = Sitting(spark, tmp_path, rows.schema, name, 40 * 86400, per_trigger)
    for arrived in (files[:3], files[3:]):  # in two sittings
        land(arrived, sitting.landing)
        sitting.run()
    sitting.end()
    want = batch_of(name, rows)
    assert rounded_bag(sitting.results(), want.columns) == rounded_bag(want, want.columns)
    assert sitting.late().count() == 0


@pytest.mark.parametrize("name", ORDERED)
def test_days_in_order_settle_and_late_rows_are_counted(spark, events, tmp_path, name):
    """A short delay: results settle while the stream runs; rows too late, and rows without a time, are kept apart."""
    rows = events.withColumn("run", F.lit("a"))
    rows = rows.withColumn("ts", F.when(F.col("event_id") % 97 > 0, F.col("ts")))
    written = []
    for i in range(6):
        target = tmp_path / f"run{i}.parquet"
        part = rows.where((F.coalesce(F.dayofmonth("ts"), F.lit(30)) - 1 >= 5 * i) & (F.coalesce(F.dayofmonth("ts"), F.lit(30)) - 1 < 5 * i + 5))
        part.coalesce(1).write.parquet(str(target))
        [file] = target.glob("*.parquet")
        copy = tmp_path / f"day{i}.parquet"
        shutil.copy(file, copy)
        os.utime(copy, (1_700_000_000 + i, 1_700_000_000 + i))
        written.append(copy)
    sitting = Sitting(spark, tmp_path, rows.schema, name, 7200, 2)
    land(written[1:], sitting.landing)
    sitting.run()
    assert sitting.results().count() > 0.5 * batch_of(name, rows.where("ts IS NOT NULL")).count()
    land(written[:1], sitting.landing)
    sitting.run()
    sitting.end()
    on_time = rows.where("day(ts) > 5")
    want = batch_of(name, on_time)
    assert rounded_bag(sitting.results(), want.columns) == rounded_bag(want, want.columns)
    assert rounded_bag(sitting.late(), ["event_id"]) == rounded_bag(rows.where("ts IS NULL OR day(ts) <= 5"), ["event_id"])


def test_idle_series_are_not_touched(spark, events, tmp_path):
    """A micro-batch with rows of one series writes the state of that series only."""
    rows = events.withColumn("run", F.lit("a"))
    sitting = Sitting(spark, tmp_path, rows.schema, "blocks", 3600, 1)
    rows.where("user_id <> 1").coalesce(1).write.parquet(str(sitting.landing))
    sitting.run()
    one = rows.where("user_id = 1").withColumn("ts", F.col("ts") + F.expr("INTERVAL 60 DAYS"))
    one.coalesce(1).write.mode("append").parquet(str(sitting.landing))
    query = sitting.run()
    [first, *_] = [p for p in query.recentProgress if p["numInputRows"]]
    assert first["numInputRows"] == one.count()
    assert sum(o["numRowsUpdated"] for o in first["stateOperators"]) <= 3 * one.count()


@pytest.mark.parametrize("per_trigger", [1, 3])
def test_live_asof_lookup_equals_the_batch(spark, mixed, tmp_path, per_trigger):
    """Samples and records as two streams, cut differently, over a restart; samples without a value are passed over."""
    rows, files = mixed
    records = rows.where("event_type IS DISTINCT FROM 'error'").select(*KEYS, "event_id", "ts", "event_type")
    samples = rows.where("coalesce(event_type, 'error') = 'error'").select(*KEYS, "event_id", "ts", F.col("value").alias("load"))
    step = sr.AsofLast(KEYS, "load", "ts", "event_id")
    out, schema = str(tmp_path / "out"), sr.asof_rows(records, samples, step).schema
    session = st.stream_session(spark, 3)

    def run():
        arriving = [st.read_landing(session, str(tmp_path / "landing"), rows.schema, files_per_trigger=n) for n in (per_trigger, 2)]
        left = arriving[0].where("event_type IS DISTINCT FROM 'error'").select(records.columns)
        right = arriving[1].where("coalesce(event_type, 'error') = 'error'").withColumnRenamed("value", "load").select(samples.columns)
        sr.run(sr.asof_stream(left, right, 40 * 86400, step), out, str(tmp_path / "checkpoint"))

    for arrived in (files[:3], files[3:]):
        land(arrived, tmp_path / "landing")
        run()
    sr.end_of_stream(spark, rows.schema, "ts", str(tmp_path / "landing"), 90 * 86400)
    run()
    want = tm.asof_last(records, samples, KEYS, "load", "ts", "event_id")
    found = sr.results(spark, out, step, schema)
    assert rounded_bag(found, want.columns) == rounded_bag(want, want.columns)
    assert sr.late_rows(spark, out, schema).count() == 0


def test_history_survives_a_restart_without_duplicates(spark, events, days, tmp_path):
    landing = tmp_path / "landing"
    land(days[:3], landing)
    for arrived in (days[3:], []):
        stream = st.read_landing(st.stream_session(spark), str(landing), events.schema, files_per_trigger=1)
        st.run(stream.select("event_id", "ts", "value"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        land(arrived, landing)
    found = spark.read.schema("event_id bigint, ts timestamp_ntz, value double").parquet(str(tmp_path / "out"))
    assert bag(found) == bag(events.select("event_id", "ts", "value"))


def test_running_stats_in_a_bounded_number_of_folders(spark, events, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    events.repartition(50).write.parquet(str(landing))
    stream = st.read_landing(st.stream_session(spark, 2), str(landing), events.schema, files_per_trigger=4)
    st.run_updates(st.running_stats(stream, ["user_id"], "value"), str(out), str(tmp_path / "checkpoint"), ["user_id"], fold=3)
    assert sorted(p.name for p in out.iterdir()) == ["all0", "all1", "updates0", "updates1", "updates2"]
    batch = tm.utilization_stats(events, ["user_id"], "value")
    columns = ["user_id", F.round("avg_utilization", 6).alias("a"), "min_utilization", "max_utilization"]
    assert bag(st.current_rows(spark, str(out), ["user_id"]).select(columns)) == bag(batch.select(columns))


def test_polling_query_runs_until_stopped(spark, events, days, tmp_path):
    landing = tmp_path / "landing"
    land(days[:1], landing)
    stream = st.read_landing(st.stream_session(spark), str(landing), events.schema).select("event_id")
    query = st.run(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), interval="1 second")
    try:
        query.processAllAvailable()
        land(days[1:2], landing)
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    expected = spark.read.parquet(str(days[0]), str(days[1])).count()
    assert spark.read.schema("event_id bigint").parquet(str(tmp_path / "out")).count() == expected


def test_the_callers_settings_stay(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    st.stream_session(spark)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_a_backlog_is_cut_into_batches_by_bytes(spark, events, days, tmp_path):
    landing = tmp_path / "landing"
    land(days, landing)
    size = max(f.stat().st_size for f in days)
    stream = st.read_landing(
        st.stream_session(spark), str(landing), events.schema, bytes_per_trigger=2 * size
    ).select("event_id")
    query = st.run(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert 2 < len([p for p in query.recentProgress if p["numInputRows"]]) < len(days)
    assert spark.read.schema("event_id bigint").parquet(str(tmp_path / "out")).count() == events.count()
