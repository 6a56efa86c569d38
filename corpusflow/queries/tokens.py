"""Tokenisation to fixed length."""

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.operators import merges as mg
from corpusflow.operators import tokenize as tok
from corpusflow.queries.tables import table
from corpusflow.session import spread
from corpusflow.settings import MAX_LENGTH

# the hash id of the word "the": a real token that looks like padding
SHARED_PAD_ID = 466
MODEL_GB = 1.1
DEVICE_GB = 80.0
BUCKETS = 8
VOCABULARY = "byte_bpe_50k.json"


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def tokenize_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tok.tokenize_fixed(_texts(spark, sf_dir), ["doc_id"])


def tokenize_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second corpus has a two-column key and is padded on the left."""
    chats = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    return tok.tokenize_fixed(chats, ["conv_id", "turn"], side="left")


def collate_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels in both modes where the pad id is also the id of a frequent word."""
    rows = tok.tokenize_fixed(_texts(spark, sf_dir), ["doc_id"], pad_id=SHARED_PAD_ID)
    return rows.select(
        "doc_id",
        tx.causal_labels(F.col("input_ids"), "pad_id", pad_id=SHARED_PAD_ID).alias("labels_by_pad"),
        tx.causal_labels(F.col("input_ids"), "attention", attention=F.col("attention_mask")).alias("labels_by_mask"),
    )


def pad_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per corpus source: the settings of its tokenizer; some have no pad token of their own."""
    settings = (
        table(spark, sf_dir, "documents")
        .groupBy("source", "lang")
        .agg(F.count(F.lit(1)).alias("n_texts"))
        .withColumn("pad_token", F.when(F.col("lang") != "en", F.concat(F.lit("<pad-"), "lang", F.lit(">"))))
        .withColumn("eos_token", F.lit("</s>"))
    )
    return settings.withColumn("pad_token", tx.pad_token(F.col("pad_token"), F.col("eos_token")))


def tokenize_merges(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Subword ids by the merges of a public byte-level vocabulary; ``path`` names another vocabulary file."""
    if path is None:
        from public_tokenizers import path as public_path

        path = public_path(VOCABULARY)
    return mg.subword_ids(_texts(spark, sf_dir), ["doc_id"], mg.load_merges(*mg.read_merges(spark, path)))


def length_bucket_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = _texts(spark, sf_dir).select(F.size(tx.words(F.col("text"))).alias("n_tokens"))
    return tok.length_buckets(lengths, MODEL_GB, DEVICE_GB)


def optimal_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = _texts(spark, sf_dir).select(F.size(tx.words(F.col("text"))).alias("n_tokens"))
    return tok.optimal_buckets(lengths, MODEL_GB, DEVICE_GB, BUCKETS)


def udf_batched_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user function over column batches, vectorised with Arrow kernels."""

    def measure(columns):
        return {
            "doc_id": columns["doc_id"],
            "n_words": pc.count_substring_regex(columns["text"], r"\S+"),
            "n_chars": pc.utf8_length(columns["text"]),
            "lower": pc.utf8_lower(columns["lang"]),
        }

    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return tok.batched_map(documents, measure, "doc_id bigint, n_words bigint, n_chars bigint, lower string")


QUERIES = {
    "tokenize_fixed": tokenize_fixed,
    "tokenize_chats": tokenize_chats,
    "tokenize_merges": tokenize_merges,
    "collate_labels": collate_labels,
    "pad_fallback": pad_fallback,
    "length_bucket_batches": length_bucket_batches,
    "optimal_buckets": optimal_buckets,
    "udf_batched_map": udf_batched_map,
}

# 32000 ids of which the first 3 are special, 2048 tokens, pad 0, end-of-text 2.
HASH_IDS = """list_transform(words[1:{length}], lambda w:
        CAST(CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 31997 + 3 AS INTEGER))"""

DOCUMENT_IDS = f"""
    split AS (SELECT doc_id, regexp_extract_all(text, '\\S+') AS words FROM documents WHERE text IS NOT NULL),
    token_ids AS (
        SELECT doc_id, CAST(len(words) AS INTEGER) AS n_tokens, {HASH_IDS.format(length=MAX_LENGTH)} AS ids
        FROM split)"""

ORACLE = {
    "tokenize_fixed": f"""
        WITH {DOCUMENT_IDS}
        SELECT doc_id, n_tokens, list_resize(ids, 2048, 0) AS input_ids,
               list_resize(list_transform(ids, lambda x: CAST(1 AS INTEGER)), 2048, 0) AS attention_mask,
               list_resize(ids, 2048, 0) AS labels
        FROM token_ids""",
    "tokenize_chats": f"""
        WITH split AS (SELECT conv_id, turn, regexp_extract_all(text, '\\S+') AS words
                       FROM conversations WHERE text IS NOT NULL),
             token_ids AS (SELECT conv_id, turn, CAST(len(words) AS INTEGER) AS n_tokens,
                                  {HASH_IDS.format(length=MAX_LENGTH)} AS ids FROM split),
             padded AS (SELECT *, list_resize(CAST([] AS INTEGER[]), {MAX_LENGTH} - len(ids), 0) AS filler FROM token_ids)
        SELECT conv_id, turn, n_tokens, list_concat(filler, ids) AS input_ids,
               list_concat(filler, list_transform(ids, lambda x: CAST(1 AS INTEGER))) AS attention_mask,
               list_concat(filler, ids) AS labels
        FROM padded""",
    "collate_labels": f"""
        WITH {DOCUMENT_IDS}
        SELECT doc_id,
               list_resize(list_transform(ids, lambda x: CASE WHEN x = {SHARED_PAD_ID} THEN -100 ELSE x END), 2048, -100)
                   AS labels_by_pad,
               list_resize(ids, 2048, -100) AS labels_by_mask
        FROM token_ids""",
    "pad_fallback": """
        SELECT source, lang, count(*) AS n_texts,
               CASE WHEN lang <> 'en' THEN '<pad-' || lang || '>' ELSE '</s>' END AS pad_token,
               '</s>' AS eos_token
        FROM documents GROUP BY source, lang""",
    "length_bucket_batches": f"""
        WITH lengths AS (SELECT CAST(len(regexp_extract_all(text, '\\S+')) AS INTEGER) AS n FROM documents),
             buckets AS (
                SELECT CAST(least(ceil(greatest(1, least(n, 2048)) / 256.0) * 256, 2048) AS INTEGER) AS bucket,
                       count(*) AS n_texts, max(n) AS longest
                FROM lengths GROUP BY 1),
             sized AS (
                SELECT *, greatest(1, CAST(trunc(({DEVICE_GB} * 0.8) / ({MODEL_GB} * 3 + bucket * 0.001)) AS INTEGER))
                          AS batch_size
                FROM buckets)
        SELECT bucket, n_texts, longest, batch_size,
               CAST((n_texts + batch_size - 1) // batch_size AS BIGINT) AS n_batches
        FROM sized""",
    "optimal_buckets": f"""
        WITH RECURSIVE lengths AS (SELECT CAST(len(regexp_extract_all(text, '\\S+')) AS INTEGER) AS n FROM documents),
             histogram AS (SELECT greatest(1, least(n, 2048)) AS length, count(*) AS c, max(n) AS longest FROM lengths GROUP BY 1),
             summed AS (SELECT *, sum(c) OVER (ORDER BY length)::BIGINT AS upto FROM histogram),
             best AS (
                SELECT 1 AS k, length, upto, upto * length AS cost, [length] AS bounds FROM summed
                UNION ALL
                SELECT any_value(b.k) + 1, s.length, s.upto, min(b.cost + (s.upto - b.upto) * s.length),
                       list_append(arg_min(b.bounds, (b.cost + (s.upto - b.upto) * s.length) * 4096 + b.length), s.length)
                FROM best b JOIN summed s ON s.length > b.length
                WHERE b.k < {BUCKETS} GROUP BY s.length, s.upto),
             chosen AS (SELECT bounds FROM best WHERE length = (SELECT max(length) FROM summed) ORDER BY k DESC LIMIT 1),
             buckets AS (SELECT unnest(bounds) AS bucket FROM chosen),
             filled AS (
                SELECT (SELECT min(bucket) FROM buckets WHERE bucket >= length) AS bucket, c, longest FROM summed),
             sized AS (
                SELECT bucket, sum(c)::BIGINT AS n_texts, max(longest) AS longest, (sum(c) * bucket)::BIGINT AS padded_tokens,
                       greatest(1, CAST(trunc(({DEVICE_GB} * 0.8) / ({MODEL_GB} * 3 + bucket * 0.001)) AS INTEGER)) AS batch_size
                FROM filled GROUP BY bucket)
        SELECT *, CAST((n_texts + batch_size - 1) // batch_size AS BIGINT) AS n_batches FROM sized""",
    "udf_batched_map": """
        SELECT doc_id, CAST(len(regexp_extract_all(text, '\\S+')) AS BIGINT) AS n_words,
               CAST(length(text) AS BIGINT) AS n_chars, lower(lang) AS lower
        FROM documents""",
}
