"""Bucket bounds against all choices; nested metrics against a walk over the parsed JSON."""

import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import tokenize as tok
from corpusflow.operators import tracking as tr


def padded(lengths, counts, bounds):
    return sum(n * min(b for b in bounds if b >= x) for x, n in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(12))
def test_bounds_are_the_best_of_all(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 9)))
    counts = [rng.randint(1, 20) for _ in lengths]
    for buckets in range(1, 5):
        bounds = tok.best_bounds(np.array(lengths), np.array(counts), buckets)
        k = min(buckets, len(lengths))
        best = min(padded(lengths, counts, c) for c in itertools.combinations(lengths, k) if c[-1] == lengths[-1])
        assert len(bounds) == k and bounds[-1] == lengths[-1]
        assert padded(lengths, counts, bounds) == best


def test_buckets_of_a_table(spark):
    rng = random.Random(2)
    sizes = [rng.choice([0, 1, 7, 8, 90, 91, 400, 3000]) for _ in range(200)] + [None]
    df = spark.createDataFrame([(s,) for s in sizes], "n_tokens int")
    rows = tok.optimal_buckets(df, 1.0, 80.0, buckets=3).orderBy("bucket").collect()
    assert sum(r.n_texts for r in rows) == 200 and len(rows) == 3
    assert rows[-1].bucket == 2048 and rows[-1].longest == 3000
    wide = tok.length_buckets(df.where("n_tokens IS NOT NULL"), 1.0, 80.0).selectExpr("sum(bucket * n_texts) AS t").head().t
    assert sum(r.padded_tokens for r in rows) <= wide
    assert all(r.padded_tokens == r.bucket * r.n_texts and r.batch_size >= 1 for r in rows)
    assert tok.optimal_buckets(df.limit(0), 1.0, 80.0).collect() == []


def leaves(value, path=()):
    inside = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else None
    if inside is None:
        if value is not None:
            number = isinstance(value, (int, float)) and not isinstance(value, bool)
            yield "/".join(path), float(value) if number else None, None if number else json.dumps(value, ensure_ascii=False)
        return
    for key, below in inside:
        yield from leaves(below, (*path, str(key)))


def test_leaves_of_any_json(spark):
    documents = [
        {"a": 1, "b": {"c": 2.5, "d": {"e": -1e-7, "f": [1, [2, {"g": 3}]]}}},
        {"a": "text", "b": True, "c": None, "d": {}, "e": []},
        {"x/y": {"é 'q'": 12345678901234567890}, "": {"": 4}},
        {"deep": {"deep": {"deep": {"deep": {"deep": {"deep": 6}}}}}},
    ]
    rows = [(i, json.dumps(d)) for i, d in enumerate(documents)] + [(8, None), (9, "no json"), (10, "5"), (11, "")]
    df = spark.createDataFrame(rows, "id int, metrics string")
    found = sorted((r.id, r.key, r.value, r.text) for r in tr.json_to_long(df, ["id"], "metrics").where("key <> '/' AND key <> ''").collect())
    want = sorted((i, k, v, t) for i, d in enumerate(documents) for k, v, t in leaves(d) if k not in ("/", ""))
    assert found == want


def test_rows_without_metrics(spark):
    df = spark.createDataFrame([(1, None)], "id int, metrics string")
    assert tr.json_to_long(df, ["id"], "metrics").collect() == []
    assert tr.json_to_long(df.limit(0), ["id"], "metrics").select(F.count("*")).head()[0] == 0


def test_four_levels_are_one_pass(spark):
    """Leaves of every depth, what is empty, and what is deeper than a pass; each pass is written once."""
    import glob

    base = spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file:")
    def passes():
        return len(glob.glob(f"{base}/corpusflow/metric_leaves-*"))

    four = '{"a": 1, "b": {"c": "t", "d": [2.5, {"e": true}]}, "f": {}, "g": [], "h": null, "i": {"j": {"k": []}}}'
    deep = '{"a": {"b": {"c": {"d": {"e": {"f": [7, {}]}}}}}}'
    before = passes()
    rows = tr.json_to_long(spark.createDataFrame([(1, four), (2, "5"), (3, "no json"), (4, None)], "id int, m string"), ["id"], "m").collect()
    assert passes() == before + 1
    want = [(1, "a", 1.0, None), (1, "b/c", None, '"t"'), (1, "b/d/0", 2.5, None), (1, "b/d/1/e", None, "true")]
    assert sorted(tuple(r) for r in rows) == want
    rows = tr.json_to_long(spark.createDataFrame([(1, deep)], "id int, m string"), ["id"], "m").collect()
    assert [tuple(r) for r in rows] == [(1, "a/b/c/d/e/f/0", 7.0, None)] and passes() == before + 3
