"""Arrays cut into byte ranges give the rows of the reader that takes a file at once."""

import json
import random

import pytest

from corpusflow.sources import corpus as src
from corpusflow.sources import json_arrays as ja

SCHEMA = "id INT, text STRING, nested STRUCT<a: ARRAY<STRUCT<b: STRING>>, c: STRING>"


def objects(n, seed):
    rng = random.Random(seed)
    marks = ['"', "\\", "}", "{", "[", "]", ",", "\n", "é", "😀", "\\\"}", "}}]", "x" * 30, '":{"', "]}"]
    def text():
        return "".join(rng.choice(marks) for _ in range(rng.randint(0, 12)))

    for i in range(n):
        yield {"id": i, "text": text(), "nested": {"a": [{"b": text()} for _ in range(rng.randint(0, 3))], "c": text()}}


def found(df):
    return sorted(json.dumps(r.asDict(True), sort_keys=True) for r in df.collect())


@pytest.mark.parametrize("range_bytes,indent", [(90, 2), (300, None), (None, 2)])
def test_any_ranges(spark, tmp_path, range_bytes, indent):
    n = 8 if range_bytes else 120
    for name in range(2):
        rows = list(objects(n, name))
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=name == 0) + "\n" * name)
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "nothing.json").write_text("")
    (tmp_path / "one.json").write_text('{"id": 7, "text": "a}b"}')
    want = found(src.read_json_document(spark, str(tmp_path), SCHEMA))
    assert len(want) >= 2 * n + 1
    assert found(src.read_json_array(spark, str(tmp_path), SCHEMA, range_bytes=range_bytes)) == [w for w in want if '"id": null' not in w]


def test_an_object_over_many_ranges_and_a_few_ranges_broadcast(spark, tmp_path):
    rows = [{"id": 1, "text": "a" * 5000 + '}"{' * 300}, {"id": 2, "text": "}"}]
    (tmp_path / "wide.json").write_text(json.dumps(rows))
    lines = ja.array_items(spark, str(tmp_path), 600, most_broadcast=0).collect()
    assert sorted((json.loads(r.value) for r in lines), key=lambda r: r["id"]) == rows


def test_many_tasks_read_one_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(list(objects(200, 1))))
    size = (tmp_path / "a.json").stat().st_size
    fragments = ja._fragments(spark, str(tmp_path), size // 10)
    assert fragments.select("start").distinct().count() >= 9
    assert fragments.rdd.getNumPartitions() >= 9


def test_schema_is_inferred_and_bad_objects_kept(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1, "y": "b"},\n {"x": "no", "y": "c"}, {"x": 3}]')
    inferred = src.read_json_array(spark, str(tmp_path))
    assert set(inferred.columns) == {"x", "y"} and inferred.count() == 3
    kept = src.read_json_array(spark, str(tmp_path), "x INT, y STRING", on_bad="keep").collect()
    assert sorted((r.x, r.y) for r in kept if r._corrupt_record is None) == [(1, "b"), (3, None)]
    assert sum(r._corrupt_record is not None for r in kept) == 1


def test_compressed_file(spark, tmp_path):
    import gzip

    rows = list(objects(20, 4))
    with gzip.open(tmp_path / "a.json.gz", "wt") as out:
        json.dump(rows, out)
    assert src.read_json_array(spark, str(tmp_path), SCHEMA, range_bytes=100).count() == 20


def test_small_ranges_share_tasks(spark, tmp_path):
    rows = list(objects(300, 9))
    (tmp_path / "a.json").write_text(json.dumps(rows))
    fragments = ja._fragments(spark, str(tmp_path), 100)
    assert fragments.select("start").distinct().count() > 100
    assert fragments.rdd.getNumPartitions() <= 3 * spark.sparkContext.defaultParallelism
    lines = ja.array_items(spark, str(tmp_path), 100).collect()
    assert sorted((json.loads(r.value) for r in lines), key=lambda r: r["id"]) == rows
