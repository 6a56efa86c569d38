"""Subword ids against a merge loop in plain Python, and against the public library on a public vocabulary."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import merges as mg
from corpusflow.queries import tokens

BYTES = {b: b for b in range(256)}
TABLE = [("a", "a"), ("b", "c"), ("aa", "a"), ("a", "bc"), ("aa", "aa"), (" ", "a"), ("bc", "bc"), (" a", "b")]


def small_table(spark):
    ids = {chr(b): b for b in range(256)}
    rows = []
    for rank, (a, b) in enumerate(TABLE):
        ids[a + b] = 256 + rank
        rows.append((ids[a], ids[b], rank, ids[a + b]))
    return spark.createDataFrame(rows, "left bigint, right bigint, rank bigint, id bigint"), ids


def by_hand(word, ids):
    parts, ranks = [chr(b) for b in word.encode()], {pair: r for r, pair in enumerate(TABLE)}
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not found:
            return [ids[p] for p in parts]
        _, at = min(found)
        parts[at : at + 2] = ["".join(parts[at : at + 2])]


def test_small_table(spark):
    table, ids = small_table(spark)
    rng = random.Random(1)
    texts = ["".join(rng.choice("aaabbcc  é\n") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["a" * n for n in range(12)] + ["", " ", "bcbcbcbc", None, "日本 😀", "a" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    pieces = df.select("id", "text", F.regexp_extract_all("text", F.lit(mg.WORD_PATTERN), F.lit(0)).alias("words")).collect()
    want = {r.id: [i for w in r.words for i in by_hand(w, ids)] for r in pieces if r.text is not None}
    assert all("".join(r.words) == r.text for r in pieces if r.text is not None)
    merges = mg.load_merges(BYTES, table)
    found = {r.id: (r.n_tokens, r.ids) for r in mg.subword_ids(df, ["id"], merges, max_length=30).collect()}
    assert found == {i: (len(w), w[:30]) for i, w in want.items()}


def test_without_merges_bytes_stay(spark):
    merges = mg.load_merges(BYTES, spark.createDataFrame([], "left bigint, right bigint, rank bigint, id bigint"))
    df = spark.createDataFrame([(1, "aé")], "id int, text string")
    assert mg.subword_ids(df, ["id"], merges).head().ids == list("aé".encode())
    assert mg.subword_ids(df.limit(0), ["id"], merges).collect() == []


def test_too_many_merges_are_refused(spark):
    with pytest.raises(ValueError, match="merges"):
        mg.load_merges(BYTES, small_table(spark)[0], most=3)


def test_a_public_vocabulary(spark, sf_dir):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    library.encode_special_tokens = True
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += ["it's  we'll\t\tthey've\r\n 12 ½ 漢字かな 🙂🙂 naïve x y   z<|endoftext|>  "]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    found = {r.id: r.ids for r in mg.subword_ids(df, ["id"], mg.load_merges(*mg.read_merges(spark, path)), max_length=1 << 20).collect()}
    for i, encoded in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert found[i] == encoded.ids


def test_registered_query_fits_fixed_length(spark, sf_dir):
    rows = tokens.tokenize_merges(spark, sf_dir)
    assert rows.columns == ["doc_id", "n_tokens", "ids"]
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL").count()


def test_words_are_encoded_a_few_bytes_at_a_time():
    rows = [[b"ab", b"c"], [], [b"x" * 50], [b"d"] * 9, [b"e"], [b""] * 3]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array([[b"z"], *rows], pa.list_(pa.binary()))], ["id", "w"])
    slices = list(mg.word_slices([batch.slice(1), batch.slice(0, 0)], "w", 10))
    assert [s.column("id").to_pylist() for s in slices] == [[1, 2], [3], [4, 5, 6]]
    assert [r for s in slices for r in s.column("w").to_pylist()] == rows
