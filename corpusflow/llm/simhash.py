"""Near-duplicates by SimHash: BK-trees over shards of fingerprints.

Two fingerprints that differ in at most ``radius`` of 64 bits agree in at least
one of ``radius + 1`` blocks, so a shard is the set of fingerprints that share a
block's value, and every link lies in a shard. A shard's BK-tree is built by the
task that holds the shard; its fingerprints are looked up in it while it grows.
The trees are not broadcast: together they are as large as the corpus has
fingerprints, which has no bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import doc_texts, parallelism, slices, sorted_groups, table
from corpusflow.llm.components import Forest, components
from corpusflow.session import stored

RADIUS = 3
SHINGLE = 3
SEED = 42
SHARD_ROWS = 4096
LEVELS = 4


def simhash(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of a text: majority of each bit over the hashes of its word shingles (none: 0)."""
    from xxhash import xxh64_digest

    words = text.lower().split()  # bytes: lowers A-Z, splits at 20 and 09-0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        digests = [xxh64_digest(joined, seed)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = sizes.cumsum()
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        digests = [xxh64_digest(joined[s:e], seed) for s, e in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1)
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(digests)
    return int.from_bytes(np.packbits(majority).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id`` and its fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            prints = np.array([simhash(t, shingle, seed) for t in part.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    return doc_texts(docs).mapInArrow(run, "doc_id bigint, fp bigint")


class BKTree:
    """Fingerprints by Hamming distance: a node's children are keyed by their distance to it."""

    def __init__(self):
        self.prints: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, fp: int) -> None:
        new, at = len(self.prints), 0
        self.prints.append(fp)
        self.children.append({})
        while new:
            distance = (self.prints[at] ^ fp).bit_count()
            child = self.children[at].setdefault(distance, new)
            if child == new:
                return
            at = child

    def within(self, fp: int, radius: int) -> list[int]:
        """Numbers of the nodes at most ``radius`` away, following only edges that can lead to one."""
        found, todo = [], [0] if self.prints else []
        while todo:
            at = todo.pop()
            distance = (self.prints[at] ^ fp).bit_count()
            if distance <= radius:
                found.append(at)
            low, high = distance - radius, distance + radius
            todo += [child for edge, child in self.children[at].items() if low <= edge <= high]
        return found


def shard_keys(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Rows ``fp, rep, mask`` once for each block of the bits not in ``mask``.

    ``key`` stands for the block and its value (and for the key before it),
    ``mask`` for all bits that rows of one key share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            mask = batch.column("mask").to_numpy().view(np.uint64)
            before = batch.column("key").to_numpy().view(np.uint64)
            for shared in np.unique(mask):
                at = np.flatnonzero(mask == shared)
                free = [b for b in range(64) if not int(shared) >> b & 1]
                for block in np.array_split(np.array(free), radius + 1):
                    bits = np.uint64(sum(1 << int(b) for b in block))
                    name = np.uint64(xxh64_intdigest(int(bits).to_bytes(8, "big")))
                    value = ((fp[at] & bits) ^ name ^ before[at]) * np.uint64(0x9E3779B97F4A7C15)
                    key = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                    columns = [key.view(np.int64), np.full(len(at), shared | bits, np.uint64).view(np.int64)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in columns] + [batch.column(n).take(pa.array(at)) for n in ("fp", "rep")],
                        ["key", "mask", "fp", "rep"],
                    )

    return rows.select("key", "mask", "fp", "rep").mapInArrow(run, "key bigint, mask bigint, fp bigint, rep bigint")


def shards(reps: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS, levels: int = LEVELS) -> DataFrame:
    """Shards of at most about ``shard_rows`` fingerprints that contain every link.

    The bits that a larger shard does not share yet are cut into blocks again:
    the same argument holds for them. At the last level 20 bits at most are
    left, hence a million fingerprints.
    """
    rows = reps.select(F.lit(0).cast("bigint").alias("key"), F.lit(0).cast("bigint").alias("mask"), "fp", "rep")
    done = None
    for level in range(levels):
        rows = stored(shard_keys(rows, radius), "shards")
        large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_rows).select("key")
        if level == levels - 1 or large.isEmpty():
            return rows if done is None else done.union(rows)
        large = stored(large, "large_shards")
        small = rows.join(large, "key", "left_anti")
        done = small if done is None else done.union(small)
        rows = rows.join(large, "key", "left_semi")
    return rows


def links(sharded: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``a, b`` between representatives that join what each shard's tree links, a star for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "key"):
            keys = group.column("key").to_numpy()
            fps = group.column("fp").to_numpy().view(np.uint64).tolist()
            reps = group.column("rep").to_numpy().tolist()
            cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])).tolist()
            a, b = [], []
            for start, end in zip(cuts, cuts[1:]):
                if end - start < 2:
                    continue
                tree, forest = BKTree(), Forest(end - start)
                for i in range(end - start):
                    for j in tree.within(fps[start + i], radius):
                        forest.join(i, j)
                    tree.add(fps[start + i])
                for i in range(end - start):
                    root = forest.root(i)
                    if root != i:
                        a.append(reps[start + i])
                        b.append(reps[start + root])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    dealt = sharded.repartition(parallelism(sharded.sparkSession), "key").sortWithinPartitions("key", "fp")
    return dealt.select("key", "fp", "rep").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` for every row of ``docs``.

    Equal fingerprints meet in one representative (their smallest doc_id) before
    anything is compared. A null or blank text has fingerprint 0 and is linked
    like any other. Repeated rows get equal results. A row without doc_id is
    linked through rows with the same fingerprint; if none of those has an id,
    its component is null.
    """
    prints = stored(fingerprints(docs, shingle, seed), "fingerprints")
    reps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "representatives")
    found = components(links(shards(reps.where("rep IS NOT NULL"), radius), radius))
    labelled = reps.join(found, reps["rep"] == found["node"], "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return prints.join(labelled, "fp").select("doc_id", "fp", "component_id")


def op2_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash_bk_trees": op2_simhash_bk_trees}
ORACLE: dict[str, str] = {}
