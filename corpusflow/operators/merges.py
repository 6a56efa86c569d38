"""Subword ids by ranked merges.

A text is cut into words in the JVM. Each few megabytes of words are reduced to the distinct
ones, these are merged side by side, and their ids are taken back to the places of
the words: a narrow map without a shuffle, and a frequent word is merged once for
many texts. Merges travel with the tasks, so their number is checked.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.settings import MAX_LENGTH
from corpusflow.sources.corpus import text_column

# Fixed value: the usual cut of byte-level vocabularies into words, with Unicode classes.
WORD_PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MOST_MERGES = 2_000_000
SLICE_BYTES = 4 << 20
NO_RANK = np.iinfo(np.int64).max


@dataclass
class Merges:
    """``byte_ids``: the id of each single byte; ``pairs``: sorted keys of two ids; their ``ranks`` and the ids they ``become``."""

    byte_ids: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    become: np.ndarray

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and the places between the words.

        In every round each word merges its pair of lowest rank, everywhere it
        stands, from the left; words without a pair that merges are done.
        """
        sizes = pa.compute.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        data = np.frombuffer(b"".join(words.to_pylist()), np.uint8)
        ids, word = self.byte_ids[data], np.repeat(np.arange(len(sizes)), sizes)
        done_ids, done_word = [], []
        while len(ids):
            rank, become = self._ranks(ids, word)
            heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(ids))))
            finished = lowest == NO_RANK
            if finished.any():
                done_ids.append(ids[finished])
                done_word.append(word[finished])
            at = _leftmost((rank == lowest) & ~finished)
            merged = ids.copy()
            merged[at] = become[at]
            finished[at + 1] = True  # swallowed by its left neighbour
            ids, word = merged[~finished], word[~finished]
        if done_ids:
            ids, word = np.concatenate(done_ids), np.concatenate(done_word)
            order = np.argsort(word, kind="stable")
            ids, word = ids[order], word[order]
        return ids, np.searchsorted(word, np.arange(len(sizes) + 1))

    def _ranks(self, ids: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the pair that begins at each place, and what it becomes."""
        rank, become = np.full(len(ids), NO_RANK), np.zeros(len(ids), np.int64)
        if not len(self.pairs):
            return rank, become
        inside = np.flatnonzero(word[1:] == word[:-1])
        key = (ids[inside] << 32) | ids[inside + 1]
        found = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        known = self.pairs[found] == key
        rank[inside[known]] = self.ranks[found[known]]
        become[inside[known]] = self.become[found[known]]
        return rank, become


def _leftmost(wanted: np.ndarray) -> np.ndarray:
    """Places to merge; of a run of overlapping pairs (as in ``aaa``) the first, third, and so on."""
    at = np.flatnonzero(wanted)
    if not len(at):
        return at
    starts = np.append(True, np.diff(at) != 1)
    run_start = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - run_start) % 2 == 0]


def byte_names() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is visible, else one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_merges(spark: SparkSession, path: str) -> tuple[dict[int, int], DataFrame]:
    """Byte ids and the merge table (``left, right, rank, id``) of a byte-level vocabulary file with ``vocab`` and ``merges``."""
    model = json.loads(spark.read.option("wholetext", True).text(path).head()[0])["model"]
    vocab, names = model["vocab"], byte_names()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    rows = [(vocab[a], vocab[b], rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)]
    table = spark.createDataFrame(rows, "left bigint, right bigint, rank bigint, id bigint")
    return {b: vocab[name] for name, b in names.items()}, table


def load_merges(byte_ids: dict[int, int], table: DataFrame, most: int = MOST_MERGES) -> Merges:
    """The merge table as arrays; one with more than ``most`` rows is refused, as every task gets it."""
    rows = table.select("left", "right", "rank", "id").limit(most + 1).toArrow()
    if rows.num_rows > most:
        raise ValueError(f"more than {most} merges do not travel with every task")
    left, right, rank, become = (rows.column(c).to_numpy().astype(np.int64) for c in ("left", "right", "rank", "id"))
    key = (left << 32) | right
    order = np.lexsort((rank, key))
    key, rank, become = key[order], rank[order], become[order]
    first = np.append(True, key[1:] != key[:-1])[: len(key)]  # the best rank of a pair counts
    return Merges(np.array([byte_ids[b] for b in range(256)], np.int64), key[first], rank[first], become[first])


def subword_ids(
    df: DataFrame,
    keys: list[str],
    merges: Merges,
    max_length: int = MAX_LENGTH,
    text: str | None = None,
    pattern: str = WORD_PATTERN,
) -> DataFrame:
    """``keys``, ``n_tokens`` of the whole text and at most ``max_length`` unpadded ``ids``.

    As :func:`corpusflow.operators.tokenize.token_ids`, with subwords: rows
    without a text are rejected, an empty text has no ids.
    """
    text = text or text_column(df)
    words = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)).cast("array<binary>")
    split = df.where(F.col(text).isNotNull()).select(*keys, words.alias("_words"))
    kept = [split.schema[k] for k in keys]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_tokens int", "ids array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in word_slices(batches, "_words"):
            column = batch.column("_words")
            coded = column.flatten().dictionary_encode()
            ids, bounds = merges.encode(coded.dictionary)
            sizes = np.diff(bounds)
            code = coded.indices.to_numpy()
            ends = np.append(0, np.cumsum(sizes[code]))[np.append(0, np.cumsum(_lengths(column)))]
            lengths = np.diff(ends)
            taken = np.minimum(lengths, max_length)
            own = np.repeat(np.append(0, np.cumsum(sizes[code]))[:-1], sizes[code])
            place = np.repeat(bounds[code], sizes[code]) + np.arange(len(own)) - own
            inside = np.arange(len(own)) - np.repeat(ends[:-1], lengths) < max_length
            offsets = pa.array(np.append(0, np.cumsum(taken)), pa.int32())
            found = pa.ListArray.from_arrays(offsets, pa.array(ids[place[inside]], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array(lengths, pa.int32()), found], [*keys, "n_tokens", "ids"]
            )

    return split.mapInArrow(run, schema)


def word_slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``max_bytes`` of the words in a column of lists (one row at least).

    Ids take some times the memory of their words, and a batch has as many rows as the session says, however long.
    """
    for batch in batches:
        lists = batch.column(column)
        sizes = pa.compute.binary_length(lists.flatten()).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.append(0, np.cumsum(sizes))[np.cumsum(_lengths(lists))]
        start, taken = 0, 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(ends, taken + max_bytes, side="right")))
            yield batch.slice(start, end - start)
            start, taken = end, ends[end - 1]


def _lengths(lists: pa.Array) -> np.ndarray:
    return pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
