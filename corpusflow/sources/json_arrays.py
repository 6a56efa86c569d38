"""Large top-level JSON arrays of objects, read by as many tasks as the files have ranges.

Spark's line reader cuts a file into byte ranges and, with ``}`` for a line end,
each range into fragments. Whether a fragment lies in a string, and how deeply it is
nested, depends on all text before it: a first pass finds what each range does to
that state (quotes open or not, change of depth in either case), a prefix sum over
the ranges of a file gives the state at the start of each, and a second pass cuts
the items out. Only the two ends of a range, parts of items that lie across its
border, are moved, to be put together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.session import stored

MARK = b"}"
MOST_BROADCAST = 1_000_000
_TOKENS = re.compile(rb'\\.|["{}\[\]]', re.DOTALL)
_DELTA = {b"{": 1, b"[": 1, b"}": -1, b"]": -1}
_HEAD, _TAIL, _MIDDLE = 0, 1, 2


def _fragments(spark: SparkSession, path: str, range_bytes: int | None) -> DataFrame:
    """``file, start, place, value``: fragments, with the start of their range and their place in the task.

    Small ranges do not mean many tasks: a task reads several, about as many as it would read by the session's settings.
    """
    tasks = max(3 * spark.sparkContext.defaultParallelism, spark.read.text(path).rdd.getNumPartitions())
    if range_bytes:
        spark = spark.newSession()
        spark.conf.set("spark.sql.files.maxPartitionBytes", range_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        spark.conf.set("spark.sql.files.minPartitionNum", 1)
    found = spark.read.option("lineSep", MARK.decode()).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").cast("binary").alias("value"),
    )
    return found.coalesce(tasks) if range_bytes else found


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, bool]]:
    """Rows one by one, with whether the next one is of another range."""
    held = None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if held is not None:
                yield held, held[:2] != row[:2]
            held = row
    if held is not None:
        yield held, True


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: whether quotes end up turned, and the change of depth if it starts outside or inside a string."""
    turned, change = False, [0, 0]
    for (file, start, value), ends in _rows(batches, ["file", "start", "value"]):
        for token in _TOKENS.findall(value + MARK):
            if token == b'"':
                turned = not turned
            elif token in _DELTA:
                change[turned] += _DELTA[token]
        if ends:
            columns = [pa.array([x]) for x in (file, start, turned, *change)]
            yield pa.RecordBatch.from_arrays(columns, ["file", "start", "turned", "outside", "inside"])
            turned, change = False, [0, 0]


def _states(effects: DataFrame) -> DataFrame:
    """``file, start, quoted, depth, last``: the state in which each range starts, and whether it is its file's last."""
    ranges = Window.partitionBy("file").orderBy("start")
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(F.col("turned").cast("int")).over(before), F.lit(0))
    known = effects.withColumn("quoted", turns % 2 == 1)
    change = F.when(F.col("quoted"), F.col("inside")).otherwise(F.col("outside"))
    depth = F.coalesce(F.sum(change).over(before), F.lit(0)).alias("depth")
    return known.select("file", "start", "quoted", depth, F.lead("start").over(ranges).isNull().alias("last"))


def _after(text: bytes, quoted: bool, depth: int) -> tuple[bool, int]:
    for token in _TOKENS.findall(text):
        if token == b'"':
            quoted = not quoted
        elif not quoted:
            depth += _DELTA.get(token, 0)
    return quoted, depth


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items of each range (``part`` null), and the head, tail or middle that belongs to items across its borders."""
    out: list[tuple] = []
    held: list[bytes] = []
    current, closed, quoted, depth = None, False, False, 0
    for row, ends in _rows(batches, ["file", "start", "value", "quoted", "depth", "last"]):
        file, start, value, first_quoted, first_depth, last = row
        if current != (file, start):
            current, closed, quoted, depth = (file, start), False, first_quoted, first_depth
        quoted, depth = _after(value, quoted, depth)
        # what stands behind the file's last mark has none itself; then nothing is open any more
        if not (last and ends and not quoted and depth == 0):
            value += MARK
            depth -= not quoted
        held.append(value)
        if not quoted and depth <= 1 and value.endswith(MARK):
            out.append((file, start, None if closed else _HEAD, b"".join(held)))
            held, closed = [], True
        if ends and held:
            out.append((file, start, _TAIL if closed else _MIDDLE, b"".join(held)))
            held = []
        if len(out) >= 4096:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["file", "start", "part", "text"])


def array_items(
    spark: SparkSession, path: str, range_bytes: int | None = None, most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """``value``: every object of the top-level arrays in the files of ``path``, each on one line.

    A file with one object gives that object, an empty one or an empty array
    nothing. An object may lie across any number of ranges. What stands between
    objects, as a number or null, stays with the next object, which is then
    unreadable. ``range_bytes`` sets the size of a range; Spark's own by
    default. A compressed file is one range.
    """
    fragments = _fragments(spark, path, range_bytes)
    found = fragments.mapInArrow(_effects, "file string, start bigint, turned boolean, outside bigint, inside bigint")
    states = stored(_states(stored(found, "json_ranges")), "json_states")
    if states.count() <= most_broadcast:  # a row per range: the text stays where it was read
        started = fragments.join(F.broadcast(states), ["file", "start"])
    else:
        started = fragments.join(states.hint("merge"), ["file", "start"]).sortWithinPartitions("file", "start", "place")
    columns = ["file", "start", "value", "quoted", "depth", "last"]
    cut = stored(started.select(columns).mapInArrow(_cut, "file string, start bigint, part int, text binary"), "json_items")
    pieces = cut.where("part IS NOT NULL")
    before = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, -1)
    number = F.coalesce(F.sum((F.col("part") == _HEAD).cast("int")).over(before), F.lit(0))
    numbers = pieces.select("file", "start", "part", number.alias("item"))
    grouped = pieces.join(numbers, ["file", "start", "part"]).groupBy("file", "item")
    joined = grouped.agg(F.array_sort(F.collect_list(F.struct("start", "part", "text"))).alias("parts")).select(
        F.aggregate("parts", F.lit(b""), lambda whole, p: F.concat(whole, p["text"])).alias("text")
    )
    lines = cut.where("part IS NULL").select("text").union(joined)
    text = F.regexp_replace(F.col("text").cast("string"), r"[\r\n]+", " ")
    return lines.select(F.regexp_replace(text, r"^[\s\[,\uFEFF]*", "").alias("value")).where(F.contains("value", F.lit("{")))
