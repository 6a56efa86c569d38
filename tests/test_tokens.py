import hashlib
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.operators import tokenize as tok


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, text string")


def hashed(word):
    return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 31997 + 3


def test_empty_text_is_all_padding(spark):
    [row] = tok.tokenize_fixed(texts(spark, [""]), ["id"], max_length=4).collect()
    assert (row.input_ids, row.attention_mask, row.labels) == ([0] * 4, [0] * 4, [0] * 4)


def test_truncates_pads_and_drops_source_columns(spark):
    df = texts(spark, ["a b c d e", "a"])
    rows = tok.tokenize_fixed(df, ["id"], max_length=3).orderBy("id").collect()
    assert rows[0].asDict().keys() == {"id", "n_tokens", "input_ids", "attention_mask", "labels"}
    assert rows[0].input_ids == [hashed(w) for w in "abc"] and rows[0].n_tokens == 5
    assert rows[1].input_ids == [hashed("a"), 0, 0] and rows[1].attention_mask == [1, 0, 0]
    left = tok.tokenize_fixed(df, ["id"], max_length=3, side="left").orderBy("id").collect()
    assert left[1].input_ids == [0, 0, hashed("a")] and left[1].attention_mask == [0, 0, 1]


def test_null_texts_are_rejected(spark):
    assert tok.token_ids(texts(spark, [None, "a"]), ["id"]).count() == 1


def test_labels_when_pad_is_end_of_text(spark):
    df = spark.createDataFrame([([7, 2, 2, 2], [1, 1, 0, 0])], "ids array<int>, mask array<int>")
    row = df.select(
        tx.causal_labels(F.col("ids"), "pad_id", pad_id=2).alias("by_pad"),
        tx.causal_labels(F.col("ids"), "attention", attention=F.col("mask")).alias("by_mask"),
    ).head()
    assert row.by_pad == [7, -100, -100, -100]
    assert row.by_mask == [7, 2, -100, -100]
    for bad in [dict(mask="pad_id"), dict(mask="attention"), dict(mask="other")]:
        with pytest.raises(ValueError):
            tx.causal_labels(F.col("ids"), **bad)


@pytest.mark.parametrize("side", ["left", "right"])
@pytest.mark.parametrize("mask", ["pad_id", "attention"])
def test_labels_from_unpadded_ids(spark, side, mask):
    df = spark.createDataFrame([([7, 2, 9],), ([],), ([2] * 6,)], "ids array<int>")
    padded = df.select("ids", tx.pad(F.col("ids"), 6, 2, side).alias("x"), tx.attention_mask(F.size("ids"), 6, side).alias("m"))
    both = padded.select(
        tx.causal_labels(F.col("x"), mask, pad_id=2, attention=F.col("m")),
        tx.padded_labels(F.col("ids"), 6, mask, pad_id=2, side=side),
    )
    assert all(a == b for a, b in both.collect())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.text(alphabet="ab çé\n\t", max_size=40), min_size=1, max_size=30), length=st.integers(1, 9))
def test_rows_have_the_fixed_length(spark, values, length):
    for row in tok.tokenize_fixed(texts(spark, values), ["id"], max_length=length).collect():
        words = values[row.id].split()
        assert len(row.input_ids) == len(row.attention_mask) == len(row.labels) == length
        assert row.n_tokens == len(words) and sum(row.attention_mask) == min(len(words), length)
        assert row.input_ids[: len(words)] == [hashed(w) for w in words[:length]]


def test_tokenising_is_a_narrow_map_over_two_columns(spark, sf_dir):
    df = tok.tokenize_fixed(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
    plan = df._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_batched_map_checks_its_rows(spark):
    df = texts(spark, ["a", "bb"]).coalesce(1)
    upper = tok.batched_map(df, lambda c: {"id": c["id"], "n": [len(t.as_py()) for t in c["text"]]}, "id int, n int")
    assert sorted((r.id, r.n) for r in upper.collect()) == [(0, 1), (1, 2)]
    with pytest.raises(Exception, match="one row per input row"):
        tok.batched_map(df, lambda c: {"n": [1]}, "n int").collect()


def test_batch_size_per_length_bucket(spark):
    lengths = spark.createDataFrame([(3,), (256,), (257,), (9000,), (0,)], "n_tokens int")
    rows = {r.bucket: r for r in tok.length_buckets(lengths, 13.0, 80.0).collect()}
    assert {b: r.n_texts for b, r in rows.items()} == {256: 3, 512: 1, 2048: 1}
    assert {r.batch_size for r in rows.values()} == {1}
    assert rows[2048].longest == 9000
    [tiny] = tok.length_buckets(lengths.limit(1), 13.0, 0.1).collect()
    assert tiny.batch_size == 1
    [roomy] = tok.length_buckets(spark.createDataFrame([(2048,)] * 12, "n_tokens int"), 1.1, 80.0).collect()
    assert (roomy.batch_size, roomy.n_batches) == (11, 2)
