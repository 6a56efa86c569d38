"""Texts to fixed-length token rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.settings import MAX_LENGTH, PAD_ID
from corpusflow.sources.corpus import text_column


def token_ids(df: DataFrame, keys: list[str], max_length: int = MAX_LENGTH, text: str | None = None) -> DataFrame:
    """``keys``, ``n_tokens`` of the whole text and at most ``max_length`` unpadded ``ids``.

    A narrow map in the JVM: no shuffle, and only the key and text columns are read.
    Rows without a text are rejected; ``save_dataset`` counts them.
    """
    text = text or text_column(df)
    split = df.where(F.col(text).isNotNull()).select(*keys, tx.words(F.col(text)).alias("_words"))
    return split.select(
        *keys,
        F.size("_words").alias("n_tokens"),
        tx.hash_ids(tx.truncate(F.col("_words"), max_length)).alias("ids"),
    )


def fixed_length(
    df: DataFrame, max_length: int = MAX_LENGTH, pad_id: int = PAD_ID, side: str = "right", ids: str = "ids"
) -> DataFrame:
    """Replace ``ids`` by ``input_ids``, ``attention_mask`` and ``labels`` of length ``max_length``."""
    keep = [F.col(c) for c in df.columns if c != ids]
    padded = df.select(
        *keep,
        tx.pad(F.col(ids), max_length, pad_id, side).alias("input_ids"),
        tx.attention_mask(F.size(ids), max_length, side).alias("attention_mask"),
    )
    return padded.withColumn("labels", F.col("input_ids"))


def tokenize_fixed(
    df: DataFrame,
    keys: list[str],
    max_length: int = MAX_LENGTH,
    pad_id: int = PAD_ID,
    side: str = "right",
    text: str | None = None,
) -> DataFrame:
    """Tokenise, truncate, pad and label; every source column except ``keys`` is dropped."""
    return fixed_length(token_ids(df, keys, max_length, text), max_length, pad_id, side)


def batched_map(
    df: DataFrame, function: Callable[[dict[str, pa.Array]], dict[str, object]], schema: str, batch_rows: int = 1000
) -> DataFrame:
    """A user function over column batches: one output row per input row, new columns only.

    ``function`` gets a dict of Arrow arrays and returns a dict of equally long
    columns. Workers are Spark's tasks.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                columns = function(dict(zip(part.schema.names, part.columns)))
                arrays = [pa.array(columns[f.name], type=f.type) for f in out_schema]
                if any(len(a) != part.num_rows for a in arrays):
                    raise ValueError("a batched function has to return one row per input row")
                yield pa.RecordBatch.from_arrays(arrays, schema=out_schema)

    return df.mapInArrow(run, schema)


def length_buckets(
    lengths: DataFrame,
    model_gb: float,
    device_gb: float,
    width: int = 256,
    max_length: int = MAX_LENGTH,
    n_tokens: str = "n_tokens",
) -> DataFrame:
    """Group texts by padded length and size a batch for each group."""
    from corpusflow.functions.values import batch_size_estimate

    capped = F.greatest(F.lit(1), F.least(F.col(n_tokens), F.lit(max_length)))
    bucket = F.least(F.ceil(capped / width) * width, F.lit(max_length)).cast("int")
    grouped = lengths.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_texts"), F.max(n_tokens).alias("longest")
    )
    return grouped.withColumn(
        "batch_size", batch_size_estimate(model_gb, device_gb, F.col("bucket"))
    ).withColumn("n_batches", F.ceil(F.col("n_texts") / F.col("batch_size")))


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Bucket bounds, at most ``buckets``, for which texts padded to their bucket's bound have the fewest tokens.

    ``lengths`` ascend. A bound is always a length that occurs; of equally good
    bounds the smaller one is taken, from the longest bucket down.
    """
    upto = np.concatenate([[0], np.cumsum(counts)])
    cost = upto[1:] * lengths  # of one bucket for the first lengths
    chosen = []
    for _ in range(min(buckets, len(lengths)) - 1):
        # the last bucket takes the lengths behind ``before``
        total = cost[:, None] + (upto[None, 1:] - upto[1:, None]) * lengths[None, :]
        total[np.tril_indices(len(lengths))] = np.iinfo(np.int64).max >> 1
        before = total.argmin(axis=0)
        cost = total[before, np.arange(len(lengths))]
        chosen.append(before)
    bounds, at = [], len(lengths) - 1
    for before in reversed(chosen):
        bounds.append(int(lengths[at]))
        at = before[at]
    return sorted([*bounds, int(lengths[at])]) if len(lengths) else []


def optimal_buckets(
    lengths: DataFrame,
    model_gb: float,
    device_gb: float,
    buckets: int = 8,
    max_length: int = MAX_LENGTH,
    n_tokens: str = "n_tokens",
) -> DataFrame:
    """As :func:`length_buckets`, with the bounds that need the fewest padded tokens, counted in ``padded_tokens``.

    Texts are counted by length in Spark; the choice is made over that
    histogram, which has ``max_length`` rows at most. Texts without tokens count
    as one token long; rows without a length are left out.
    """
    from corpusflow.functions.values import batch_size_estimate

    capped = F.greatest(F.lit(1), F.least(F.col(n_tokens), F.lit(max_length))).cast("int")
    known = lengths.where(F.col(n_tokens).isNotNull())
    histogram = known.groupBy(capped.alias("length")).agg(F.count(F.lit(1)).alias("n"), F.max(n_tokens).alias("longest"))
    rows = sorted((r.length, r.n, r.longest) for r in histogram.collect())
    sizes, counts = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    bounds = best_bounds(sizes, counts, buckets)
    # a row per bucket, of sums over the histogram
    found = []
    for low, bound in zip([0, *bounds], bounds):
        own = [r for r in rows if low < r[0] <= bound]
        found.append((bound, sum(r[1] for r in own), max(r[2] for r in own), sum(r[1] for r in own) * bound))
    table = lengths.sparkSession.createDataFrame(found, "bucket int, n_texts bigint, longest int, padded_tokens bigint")
    return table.withColumn("batch_size", batch_size_estimate(model_gb, device_gb, F.col("bucket"))).withColumn(
        "n_batches", F.ceil(F.col("n_texts") / F.col("batch_size"))
    )
