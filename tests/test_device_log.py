import datetime

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import telemetry as tm
from corpusflow.sources import device_log as dl

GOOD = "0, NVIDIA H100, 87, 40, 1024, 81920, 55, 300.5"
MISSING = "1, NVIDIA H100, [N/A], 40, 1024, 81920, 55, 300.5"
COMMA = "0, A, B, 87, 40, 1024, 81920, 55, 300.5"


def parse(spark, *lines):
    return dl.parse_device_lines(spark.createDataFrame([(x,) for x in lines], "line string"))


def test_good_line(spark):
    [row] = parse(spark, GOOD).collect()
    assert row.asDict() == {
        "index": 0, "name": "NVIDIA H100", "utilization_gpu": 87.0, "utilization_memory": 40.0,
        "memory_used_gb": 1.0, "memory_total_gb": 80.0, "temperature": 55.0, "power_draw": 300.5, "ok": True,
    }


@pytest.mark.parametrize("line", ["2, x, 1", "  ", ""])
def test_short_and_blank_lines_are_skipped(spark, line):
    assert parse(spark, line).count() == 0


@pytest.mark.parametrize("line", [MISSING, COMMA, "x" + GOOD])
def test_unreadable_lines_are_rejected(spark, line):
    parsed = parse(spark, GOOD, line)
    assert dl.accepted(parsed).count() == 1
    assert dl.rejected(parsed).count() == 1


def test_extra_fields_are_ignored(spark):
    assert dl.accepted(parse(spark, GOOD + ", extra")).count() == 1


def test_probe_output_is_split_into_lines(spark):
    df = spark.createDataFrame([(1, f"{GOOD}\n\n{MISSING}\n")], "poll int, output string")
    parsed = dl.parse_device_lines(dl.probe_lines(df))
    assert [(r.poll, r["index"], r.ok) for r in parsed.orderBy("index").collect()] == [(1, 0, True), (1, 1, False)]


def test_strict_drops_the_whole_snapshot(spark):
    df = spark.createDataFrame([(1, f"{GOOD}\n{MISSING}"), (2, GOOD)], "poll int, output string")
    parsed = dl.parse_device_lines(dl.probe_lines(df))
    assert [r.poll for r in dl.strict_snapshots(parsed, "poll").collect()] == [2]
    assert sorted(r.poll for r in dl.accepted(parsed).collect()) == [1, 2]


def test_files_of_lines(spark, tmp_path):
    (tmp_path / "log.txt").write_text(f"{GOOD}\n{MISSING}\n")
    assert dl.accepted(dl.parse_device_lines(dl.read_device_lines(spark, str(tmp_path)))).count() == 1


def test_snapshots_nest_and_survive_the_history_file(spark, tmp_path):
    moment = datetime.datetime(2024, 1, 2, 3, 4, 5, 678901)
    lines = [(moment, i, f"{i}, dev, {10 * i}, 1, 1024, 2048, 50, 7") for i in range(7)]
    df = spark.createDataFrame(lines, "snapshot timestamp_ntz, place bigint, line string")
    samples = dl.accepted(dl.parse_device_lines(df)).withColumn("host", F.expr("place div 4"))
    nested = tm.nest_snapshots(samples, "snapshot", "host")
    dl.append_history(nested, str(tmp_path / "h"))
    dl.append_history(nested.limit(0), str(tmp_path / "h"))
    found = dl.read_history(spark, str(tmp_path / "h")).orderBy("host").collect()
    assert [[g["index"] for g in r.gpus] for r in found] == [[0, 1, 2, 3], [4, 5, 6]]
    assert [(r.timestamp, r.host, r.avg_utilization) for r in found] == [(moment, 0, 15.0), (moment, 1, 50.0)]


def test_snapshot_mean(spark):
    df = spark.createDataFrame([(1, 10.0), (1, 20.0), (2, 5.0)], "poll int, utilization_gpu double")
    means = {r.poll: r.avg_utilization for r in tm.snapshot_means(df, ["poll"]).collect()}
    assert means == {1: 15.0, 2: 5.0}


def test_lines_are_split_once(spark):
    df = spark.createDataFrame([(GOOD,)], "line string").select(F.concat("line", F.lit("")).alias("line"))
    plan = dl.accepted(dl.parse_device_lines(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_documents_take_one_shuffle_and_no_join(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    wide = events.select(
        F.col("event_id"), F.date_trunc("hour", "ts").alias("snapshot"), F.col("user_id").cast("int").alias("index"),
        F.col("event_type").alias("name"), *[F.col("value").alias(c) for c in dl.SAMPLE_FIELDS[2:]],
    )
    nested = tm.nest_snapshots(wide, "snapshot", "index")
    nested.collect()
    executed = nested._jdf.queryExecution().executedPlan().toString()
    final = executed[: executed.index("== Initial Plan ==")]
    assert final.count("Exchange hashpartitioning") == 1 and "Join" not in final
