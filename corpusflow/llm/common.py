"""Small helpers the operators share: Arrow slices, task partitions, worker caches, columns of ids."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text as UTF-8 bytes (null: empty); every other column is left out."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )


def remainder_of(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(divisor)


def held_out(column: str, divisor: int, value: int) -> Column:
    return F.coalesce(remainder_of(column, divisor) == value, F.lit(False))


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the cluster's own measure of how finely work is dealt out."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", max_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``max_bytes`` of a binary column (one row at least)."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size) + 64
        if start < batch.num_rows:
            yield batch.slice(start)


def filter_rows(docs: DataFrame, decider: Callable[[], Callable[[list[bytes | None]], Iterable[bool]]]) -> DataFrame:
    """Rows of ``docs`` for whose text the decision is true; ``decider`` makes a task's deciding function.

    Only the text goes to Python, a megabyte at a time, and only the decision comes back.
    """

    def keep(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decide = decider()
        for texts in arrays:
            whole = pa.RecordBatch.from_arrays([texts], ["text"])
            found = [pa.array(decide(p.column("text").to_pylist()), pa.bool_()) for p in slices([whole], max_bytes=1 << 20)]
            yield pa.concat_arrays(found) if found else pa.array([], pa.bool_())

    return docs.where(F.arrow_udf(keep, "boolean")(F.col("text").cast("binary")))


def sorted_groups(
    batches: Iterable[pa.RecordBatch], key: str, min_rows: int = 1 << 15, measure: str | None = None, limit: int = 0
) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key``.

    A table holds at least ``min_rows`` rows (or ``limit`` bytes of the binary
    column ``measure``) and ends where the key changes; only the last one may be
    smaller.
    """
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if measure:
            size += batch.column(measure).nbytes
        if rows < min_rows and not (limit and size >= limit):
            continue
        full = pa.Table.from_batches(held).combine_chunks()
        keys = full.column(key)
        last = keys[full.num_rows - 1]
        cut = pa.compute.index(keys, last).as_py()
        if cut > 0:
            yield full.slice(0, cut)
        rest = full.slice(cut).combine_chunks()
        held = rest.to_batches()
        rows = rest.num_rows
        size = rest.column(measure).nbytes if measure else 0
    if held and rows:
        yield pa.Table.from_batches(held).combine_chunks()


def worker_cache(owner: str, name: str) -> dict:
    """A dict that a Python worker keeps from task to task, until another owner asks for one.

    Functions travel to the workers by value, so their own globals start anew
    in each task. Whoever fills the dict bounds its size; as only one owner's
    dicts are kept, operators that follow one another do not add up.
    """
    module = sys.modules.setdefault("_corpusflow_worker_cache", ModuleType("_corpusflow_worker_cache"))
    kept = vars(module)
    if kept.get("owner") != owner:
        kept["owner"], kept["entries"] = owner, {}
        return_memory()
    return kept["entries"].setdefault(name, {})


def return_memory() -> None:
    """Hand freed memory back to the system: a worker outlives the operator that needed it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def release_caches() -> None:
    """Free what earlier operators have kept in this worker; for tasks that keep nothing themselves."""
    worker_cache("", "")


class Recent:
    """Memory of computed values with two generations of at most ``limit`` entries each.

    A value asked for again moves to the young generation; when that is full it
    becomes the old one and the values not asked for since are forgotten.
    """

    def __init__(self, owner: str, name: str, limit: int):
        self.kept, self.limit = worker_cache(owner, name), limit
        self.kept.setdefault("young", {})
        self.kept.setdefault("old", {})

    def values(self, keys: set, make) -> dict:
        """A dict with the values of ``keys`` (and others); ``make`` turns a list of unknown keys into theirs."""
        young, old = self.kept["young"], self.kept["old"]
        missing = keys.difference(young)
        if missing:
            unknown = missing.difference(old)
            young.update((k, old[k]) for k in missing - unknown)
            asked = list(unknown)
            young.update(zip(asked, make(asked)))
        if len(young) > self.limit:
            self.kept["old"], self.kept["young"] = young, {}
        return young
