"""Quality classifier: nearest labelled neighbours in a latent-semantic space.

Texts are counts of hashed byte trigrams (case and punctuation count), weighted
by IDF and projected on the leading singular vectors of a labelled sample; the share of
repeated words is one more coordinate. The sample's vectors are broadcast; every document is compared with all of them, a
block at a time, and its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import doc_texts, held_out, release_caches, remainder_of, slices, table

BUCKETS = 2048
RANK = 48
ROWS_PER_LABEL = 1500
NEIGHBOURS = 25
SHARPNESS = 4
BLOCK = 256  # documents compared at a time: about 20 MB of cosines and their order
REPEAT_WEIGHT = 1.5


def trigram_counts(text: bytes, buckets: int = BUCKETS) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(buckets, np.int64)
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    code *= np.uint32(2654435761)
    return np.bincount(code >> np.uint32(32 - (buckets.bit_length() - 1)), minlength=buckets)


def features(text: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """Trigram counts, then how many words equal the word before them, then the number of words."""
    words = text.split()
    repeated = sum(map(eq, words, islice(words, 1, None)))
    return np.append(trigram_counts(text, buckets), (repeated, len(words)))


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of log counts times IDF, of unit length (a row without trigrams stays zero)."""
    rows = np.log1p(counts) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Neighbours:
    """Labelled vectors, their labels and what maps counts to vectors."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    shares: np.ndarray

    @classmethod
    def fit(
        cls, counts: np.ndarray, labels: np.ndarray, idf: np.ndarray | None = None, shares: np.ndarray | None = None, rank: int = RANK
    ) -> Neighbours:
        """``idf`` of the buckets (else of ``counts``) and how many documents each row's vote stands for (else one)."""
        if idf is None:
            idf = np.log((len(counts) + 1) / ((counts[:, :-2] > 0).sum(axis=0) + 1)) + 1
        shares = np.ones(len(counts)) if shares is None else shares
        x = weighted(counts[:, :-2], idf)
        rank = max(1, min(rank, *x.shape))
        sketch = x @ np.random.default_rng(0).standard_normal((x.shape[1], min(rank + 16, x.shape[1])))
        for _ in range(3):  # subspace iteration towards the leading right singular vectors
            basis, _ = np.linalg.qr(x.T @ sketch)
            sketch = x @ basis
        _, _, right = np.linalg.svd(sketch, full_matrices=False)
        basis = basis @ right[:rank].T
        return cls(idf, basis, cls._vectors(counts, idf, basis), labels.astype(float), shares)

    @classmethod
    def _vectors(cls, counts: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
        """Unit latent vectors with the weighted share of repeated words as one more coordinate, of unit length again."""
        latent = cls._unit(weighted(counts[:, :-2], idf) @ basis)
        repeated = REPEAT_WEIGHT * counts[:, -2:-1] / np.maximum(counts[:, -1:], 1)
        return cls._unit(np.hstack([latent, repeated]))

    @staticmethod
    def _unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)

    def scores(self, counts: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
        """Similarity-weighted share of label 1 among the ``k`` nearest; all documents' share for rows without trigrams."""
        cosine = self._vectors(counts, self.idf, self.basis) @ self.vectors.T
        k = min(k, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0) ** SHARPNESS * self.shares[near]
        total = weight.sum(axis=1)
        vote = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-300)
        return np.where(total > 0, np.clip(vote, 0, 1), np.average(self.labels, weights=self.shares))

    def score_texts(self, texts: list[bytes | None]) -> np.ndarray:
        """Scores of texts, a block at a time; null counts as empty."""
        release_caches()
        blocks = [texts[at : at + BLOCK] for at in range(0, len(texts), BLOCK)]
        return np.concatenate([self.scores(np.vstack([features(t or b"") for t in block])) for block in blocks])


def document_idf(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """IDF of every trigram bucket over all rows: a row per bucket leaves each task, one per bucket reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches()
        found = np.zeros(buckets + 1, np.int64)
        for part in slices(batches):
            for text in part.column("text").to_pylist():
                found[:-1] += trigram_counts(text, buckets) > 0
            found[-1] += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets + 1)), pa.array(found)], ["bucket", "n"])

    each = doc_texts(docs).select("text").mapInArrow(count, "bucket bigint, n bigint")
    n = np.zeros(buckets + 1)
    for row in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        n[row.bucket] = row.n
    return np.log((n[-1] + 1) / (n[:-1] + 1)) + 1


def train(docs: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL) -> Neighbours | None:
    """Fit on at most ``rows_per_label`` documents of each label 0 and 1, those with the smallest hashes of their id.

    A document labelled more than once counts with its largest label, one with
    several texts with the smallest in byte order. Document frequencies are
    those of all rows of ``docs``; a label's votes count as many times as its
    documents were cut down by, so scores mean the same at every size. Without
    any labelled document there is no model.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    shares = {row.quality: max(1.0, row.n / rows_per_label) for row in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    chosen = [
        known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(rows_per_label)
        for label in (0, 1)
    ]
    sample = chosen[0].union(chosen[1])  # bounded, so it may be broadcast

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            counts = [features(t).astype("<u4").tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("quality"), pa.array(counts, pa.binary())], ["doc_id", "quality", "counts"]
            )

    rows = (
        doc_texts(docs)
        .join(F.broadcast(sample.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id"))
        .groupBy("doc_id", F.col("quality").cast("int").alias("quality"))
        .agg(F.min("text").alias("text"))  # one row for each id of the sample
        .mapInArrow(count, "doc_id bigint, quality int, counts binary")
        .collect()
    )
    if not rows:
        return None
    rows.sort(key=lambda r: r.doc_id)
    counts = np.vstack([np.frombuffer(r.counts, "<u4").astype(np.int64) for r in rows])
    kinds = np.array([r.quality for r in rows])
    return Neighbours.fit(counts, kinds, document_idf(docs), np.array([shares[k] for k in kinds.tolist()]))


def score_quality(docs: DataFrame, model: Neighbours | None) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher: label 1 likelier) for every row.

    Null and empty texts get the share of label 1 among all permitted labels, and so do all
    without a model: 0.5. Repeated rows give equal rows.
    """
    if model is None:
        return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(0.5).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            scores = model.score_texts(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return doc_texts(docs).mapInArrow(run, "doc_id bigint, score double")


def op6_latent_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(remainder_of("doc_id", 3) != 1))
    found = score_quality(docs, model)
    return found.select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


QUERIES = {"op6_latent_neighbours": op6_latent_neighbours}
ORACLE: dict[str, str] = {}
