from pyspark.sql import functions as F

from corpusflow.operators import tracking as tr


def test_metrics_are_appended_and_pruned_by_run(spark, tmp_path):
    wide = spark.createDataFrame(
        [("r1", 10, 50.0, 3), ("r2", 20, None, 4)], "run_id string, step bigint, cpu double, mem int"
    ).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    long = tr.to_long(wide, ["run_id", "step", "ts"], {"cpu": "system/cpu_percent", "mem": "system/memory_percent"})
    path = str(tmp_path / "metrics")
    tr.append_table(long, path)
    tr.append_table(long, path)
    saved = tr.read_table(spark, path, tr.METRICS_SCHEMA)
    assert saved.count() == 8
    one = saved.where("run_id = 'r1' AND key = 'system/memory_percent'")
    assert {(r.value, r.step) for r in one.collect()} == {(3.0, 10)}
    assert "PartitionFilters: [isnotnull(run_id" in one._jdf.queryExecution().toString()


def test_params_are_text(spark):
    df = spark.createDataFrame([("r", "m", 3)], "run_id string, model_name string, num_epochs int")
    found = tr.params_to_long(df, ["run_id"], ["model_name", "num_epochs"]).collect()
    assert {(r.key, r.value) for r in found} == {("model_name", "m"), ("num_epochs", "3")}


def test_artifact_files(spark, tmp_path):
    (tmp_path / "config.yaml").write_text("a: 1\nb: 2\n")
    [row] = tr.read_artifact_files(spark, str(tmp_path / "config.yaml"), "r").collect()
    assert row.run_id == "r" and row.content == "a: 1\nb: 2\n" and row.path.endswith("config.yaml")


def test_compare_runs_keeps_one_sided_keys(spark):
    df = spark.createDataFrame(
        [("before", "len", 10.0), ("after", "len", 16.0), ("before", "old", 1.0), ("after", "new", 2.0), ("x", "len", 99.0)],
        "phase string, key string, value double",
    )
    compared = tr.compare_runs(df, F.col("phase") == "before", F.col("phase") == "after")
    assert {r.key: (r.before, r.after, r.delta) for r in compared.collect()} == {
        "len": (10.0, 16.0, 6.0), "old": (1.0, None, None), "new": (None, 2.0, None),
    }


def test_missing_and_gate(spark):
    required = spark.createDataFrame([(s,) for s in ["model", "dataset", "training"]], "name string")
    present = spark.createDataFrame([("dataset",), ("extra",)], "name string")
    missing = tr.missing_required(required, present, ["name"]).collect()
    assert sorted(r.name for r in missing) == ["model", "training"]
    checks = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "name string, ok boolean")
    found = tr.gate(checks, ["name"], F.col("ok"), ~F.col("ok")).collect()
    assert {(r.name, r.all_ok, r.any_flag) for r in found} == {("a", False, True), ("b", True, False)}
