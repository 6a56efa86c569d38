"""From raw documents to packed training sequences, one stage after the other.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written and read back as the next one's ``docs``. All but the last return the
columns of ``documents``. Stages share the executors and their Python workers,
so texts go to Python in small batches in all of them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import langid, packing, quality, repeats, shingles
from corpusflow.llm.common import filter_rows, table
from corpusflow.session import bound_batches, stored

LEAST_POSTERIOR = 0.5
LEAST_QUALITY = 0.5


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: null texts, texts without a letter, and those on which no language has the majority.

    Languages are learned from ``docs.lang``, which stays as it is.
    """
    pieces = langid.public_pieces()
    langs, p = langid.train(docs, pieces)

    def decider() -> Callable:
        predict = langid.Identifier(pieces, langs, p)
        return lambda texts: [lang != langid.UNKNOWN and score >= LEAST_POSTERIOR for lang, score in predict(texts)]

    return filter_rows(docs, decider)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose labelled neighbours vote for label 0 of ``labels.quality``; without labels all stay."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    if model is None:
        return docs
    return filter_rows(docs, lambda: lambda texts: model.score_texts(texts) >= LEAST_QUALITY)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each component of texts with 0.8 or more of their five-word shingles in common.

    A document is what its id names: rows that repeat an id stay or go together.
    Rows without an id stay.
    """
    first = shingles.first_documents(docs)
    named = docs.join(first, "doc_id", "left_semi").select(docs.columns)
    return named.union(docs.where("doc_id IS NULL"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out of each text what stands earlier in the corpus; a document of which nothing is left goes.

    Where a cut goes through a character, the bytes left of it go too.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    # read in the operator's last step: a second step in Python would take a second worker for each task, and Spark keeps those
    found = repeats.remove_repeats(docs, carry=others, as_text=True).where("n_bytes = 0 OR n_removed < n_bytes")
    cut = found.withColumn("text", F.col("kept"))
    return cut.withColumn("n_chars", F.char_length("text").cast("bigint")).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place the documents' pieces in sequences of at most 2048 tokens."""
    # a worker holds less here than in a job of its own, as other stages ran in it before
    return packing.pack_documents(docs, cached_chunks=60_000, slice_bytes=1 << 20)


def _in_small_batches(stage: Callable[..., DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("language ID", _in_small_batches(identify_languages)),
    ("quality classifier", _in_small_batches(keep_quality)),
    ("SimHash near-dedup", _in_small_batches(drop_near_duplicates)),
    ("suffix-array dedup", _in_small_batches(cut_repeats)),
    ("best-fit packing", _in_small_batches(pack_sequences)),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
