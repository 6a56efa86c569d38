import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from corpusflow.session import spread, stored, work_dir
from corpusflow.sources import corpus as src


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_json_object_over_two_lines_is_one_row(spark, tmp_path):
    path = tmp_path / "obj.json"
    path.write_text('{"text": "a",\n "x": 1}')
    assert rows(src.read_json_document(spark, str(path))) == [{"text": "a", "x": 1}]


def test_json_array_is_one_row_per_item(spark, tmp_path):
    path = tmp_path / "arr.json"
    path.write_text('[{"text":"a"},\n{"text":"b","x":2}]')
    found = rows(src.read_json_document(spark, str(path), "text STRING, x INT"))
    assert found == [{"text": "a", "x": None}, {"text": "b", "x": 2}]


def test_jsonl_skips_blank_lines_and_keeps_rejects(spark, tmp_path):
    path = tmp_path / "rows.jsonl"
    path.write_text('{"text":"a"}\n\n{"text":"b","x":2}\n{bad\n')
    kept = src.read_jsonl(spark, str(path), "text STRING, x INT", on_bad="keep")
    good = kept.where(F.col(src.CORRUPT).isNull()).drop(src.CORRUPT)
    assert rows(good) == [{"text": "a", "x": None}, {"text": "b", "x": 2}]
    broken = rows(kept.where(F.col(src.CORRUPT).isNotNull()))
    assert broken == [{"text": None, "x": None, src.CORRUPT: "{bad"}]
    with pytest.raises(Exception, match="MALFORMED_RECORD|malformed"):
        src.read_jsonl(spark, str(path), "text STRING, x INT").collect()
    with pytest.raises(ValueError):
        src.read_jsonl(spark, str(path), on_bad="ignore")


def test_resolve_dispatches_on_path_suffix_then_name(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"text":"j"},{"text":"k"}]')
    (tmp_path / "a.jsonl").write_text('{"text":"l"}\n{"text":"m"}\n')
    (tmp_path / "a.csv").write_text("text,n\nc,1\n")
    (tmp_path / "a.txt").write_text("plain line\n")
    spark.createDataFrame([("p",)], "text string").write.parquet(str(tmp_path / "a.parquet"))
    for suffix, expected in [("json", ["j", "k"]), ("jsonl", ["l", "m"]), ("csv", ["c"]), ("parquet", ["p"])]:
        df = src.resolve_dataset(spark, str(tmp_path / f"a.{suffix}"))
        assert [r["text"] for r in rows(df)] == expected
    assert rows(src.resolve_dataset(spark, str(tmp_path / "a.txt"))) == [{"value": "plain line"}]
    named = src.resolve_dataset(spark, "corpus", registry={"corpus": str(tmp_path / "a.jsonl")})
    assert named.count() == 2
    with pytest.raises(AnalysisException):
        src.resolve_dataset(spark, "no_such_dataset")


def test_compressed_files_folders_and_schemas(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "text string, n int")
    df.select(F.to_json(F.struct("*"))).write.option("compression", "gzip").text(str(tmp_path / "rows.jsonl.gz"))
    df.write.option("compression", "gzip").json(str(tmp_path / "lines"))  # part-*.json.gz, a row a line
    df.write.option("header", True).option("sep", "\t").csv(str(tmp_path / "tabs"))
    df.write.parquet(str(tmp_path / "columns"))
    (tmp_path / "one.csv.gz").write_bytes(__import__("gzip").compress(b"text,n\nc,3\n"))
    ddl = "text STRING, n INT, extra INT"
    ab = [{"text": "a", "n": 1, "extra": None}, {"text": "b", "n": 2, "extra": None}]
    for name, fmt in (("rows.jsonl.gz", None), ("lines", "jsonl"), ("tabs", "tsv"), ("columns", None)):
        found = src.resolve_dataset(spark, str(tmp_path / name), schema=ddl, fmt=fmt)
        assert sorted(rows(found), key=str) == sorted(ab, key=str), name
    assert rows(src.resolve_dataset(spark, str(tmp_path / "one.csv.gz"))) == [{"text": "c", "n": "3"}]
    named = src.resolve_dataset(spark, "x", registry={"x": str(tmp_path / "rows.jsonl.gz")}, schema=ddl)
    assert named.columns == ["text", "n", "extra"]
    df.createOrReplaceTempView("named_rows")
    assert sorted(rows(src.read_named(spark, "named_rows", schema=ddl)), key=str) == sorted(ab, key=str)
    (tmp_path / "mixed").mkdir()
    (tmp_path / "mixed/a.csv").write_text("text\n")
    (tmp_path / "mixed/b.jsonl").write_text("{}\n")
    with pytest.raises(ValueError, match="several formats"):
        src.resolve_dataset(spark, str(tmp_path / "mixed"))


def test_split_is_pruned(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "train"), (2, "b", "test")], "id int, text string, split string")
    src.save_dataset(df, str(tmp_path / "d"), "d", partition_by=["split"])
    chosen = src.select_split(src.load_dataset(spark, str(tmp_path / "d")))
    assert [r.id for r in chosen.collect()] == [1]
    assert "PartitionFilters: [isnotnull(split" in chosen._jdf.queryExecution().toString()
    assert src.select_split(df.drop("split")).count() == 2
    with pytest.raises(ValueError, match="no split 'validation'"):
        src.select_split(df.drop("split"), "validation")


def test_metadata_record(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "text string, n int")
    out = str(tmp_path / "d")
    expected = {
        "dataset_name": "d", "num_examples": 3, "max_length": 128, "split": "train",
        "features": ["text", "n"], "null_texts": 1,
    }
    assert rows(src.save_dataset(df, out, "d", max_length=128)) == [expected]
    [part] = (tmp_path / "d" / "metadata").glob("*.json")
    assert json.loads(part.read_text()) == expected
    assert src.load_dataset(spark, out).count() == 3
    with pytest.raises(AnalysisException):
        src.save_dataset(df, out, "d")


def test_text_column(spark, sf_dir):
    assert src.text_column(spark.createDataFrame([("x", "y")], "a string, text string")) == "text"
    assert src.text_column(spark.createDataFrame([("x", 1)], "a string, b int")) == "a"
    with pytest.raises(TypeError):
        src.text_column(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def test_spread_only_inputs_of_few_splits(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    dealt = spread(documents)
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(dealt) is dealt


def test_working_folders_lie_in_the_shared_one(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert work_dir(spark, "a").startswith(f"{base}/corpusflow/a-")
    assert work_dir(spark, "a") != work_dir(spark, "a")


def test_stored_keeps_rows_and_schema(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kept = stored(events, "events")
    assert kept.schema == events.schema
    assert kept.exceptAll(events).count() == 0 and kept.count() == events.count()
