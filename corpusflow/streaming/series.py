"""Streams of series, worked on in event-time order by Spark's own state.

A row waits in its series' state until the watermark has passed its time: until a
row has arrived whose time is ``delay`` later. Then a timer brings the waiting rows
of the series in order to a :class:`Step`, together with the little that the series
carries over. So results do not depend on how arrivals are cut into micro-batches,
and a micro-batch costs what its own rows and due series cost, however many series
lie idle. Rows without a time, and rows that come when the watermark has passed
their time, are written apart.

The state of a series lies in one partition; what a micro-batch takes of a very long
series is bounded by the arrivals a trigger admits (see ``read_landing``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import LongType, StructField, StructType

from corpusflow.functions.values import from_micros, micros
from corpusflow.operators import telemetry as tm
from corpusflow.settings import BLOCK_SIZE, THROTTLE_SECONDS
US = 1_000_000
NONE_YET = -(1 << 63)


class Step:
    """What is done with the rows of a series that are complete up to a time."""

    keys: list[str]
    ts: str
    tie: str

    def needed(self, rows: StructType) -> StructType:
        """The columns that have to wait with a row; by default all."""
        return rows

    def result(self, rows: StructType) -> StructType:
        raise NotImplementedError

    def carried(self, rows: StructType) -> StructType:
        """What a series carries from one call to the next."""
        raise NotImplementedError

    def advance(self, carry: tuple | None, rows: list[Row]) -> tuple[tuple, list[tuple]]:
        """New carry and result rows of rows in order; ``_us`` is a row's time in microseconds."""
        raise NotImplementedError


@dataclass
class Throttle(Step):
    """Rows more than ``seconds`` after the last kept one of their series; a series carries that row's time."""

    keys: list[str]
    ts: str
    tie: str
    seconds: float = THROTTLE_SECONDS

    def result(self, rows):
        return rows

    def carried(self, rows):
        return StructType([StructField("last", LongType())])

    def advance(self, carry, rows):
        last, gap, kept = carry[0] if carry else None, round(self.seconds * US), []
        for row in rows:
            if last is None or row._us - last > gap:
                last = row._us
                kept.append(tuple(row)[:-1])
        return (last,), kept


@dataclass
class BlockMeans(Step):
    """Mean of every ``size`` rows of a series; it carries the sums of its unfinished block and the number of finished ones."""

    keys: list[str]
    value: str
    ts: str
    tie: str
    size: int = BLOCK_SIZE

    def needed(self, rows):
        return StructType([rows[c] for c in dict.fromkeys([*self.keys, self.value, self.ts, self.tie])])

    def result(self, rows):
        named = [rows[k] for k in self.keys]
        fields = StructType(named).add("block", "long").add("block_mean", "double")
        return StructType([*fields.fields, rows[self.ts], rows[self.tie]])

    def carried(self, rows):
        return StructType().add("blocks", "long").add("rows", "long").add("values", "long").add("total", "double")

    def advance(self, carry, rows):
        blocks, n, values, total = carry or (0, 0, 0, 0.0)
        found = []
        for row in rows:
            n += 1
            if row[self.value] is not None:
                values, total = values + 1, total + row[self.value]
            if n == self.size:
                mean = total / values if values else None
                found.append((*[row[k] for k in self.keys], blocks, mean, row[self.ts], row[self.tie]))
                blocks, n, values, total = blocks + 1, 0, 0, 0.0
        return (blocks, n, values, total), found


@dataclass
class AsofLast(Step):
    """Each record with the latest earlier (or simultaneous, lower ``tie``) sample of its series; see :func:`asof_stream`."""

    keys: list[str]
    value: str
    ts: str
    tie: str
    sample: str = "_sample"

    def result(self, rows):
        return StructType([f for f in rows if f.name != self.sample])

    def carried(self, rows):
        return StructType([StructField("value", rows[self.value].dataType)])

    def advance(self, carry, rows):
        last, found = carry[0] if carry else None, []
        for row in rows:
            if not row[self.sample]:
                found.append(tuple(last if c == self.value else row[c] for c in row.asDict() if c not in (self.sample, "_us")))
            elif row[self.value] is not None:
                last = row[self.value]
        return (last,), found


class _InOrder(StatefulProcessor):
    """Rows wait in a list; a timer at the earliest one's time hands those that are due to the step."""

    def __init__(self, step: Step, rows: StructType):
        self.step, self.names = step, rows.fieldNames()
        self.waiting = StructType([*step.needed(rows).fields, StructField("_us", LongType())])
        self.carries = step.carried(rows)

    def init(self, handle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", self.waiting)
        self.carry = handle.getValueState("carry", self.carries)

    def _wake(self, earliest: int) -> None:
        self.handle.registerTimer(-(-earliest // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000 or NONE_YET
        fresh = []
        for row in rows:
            if row._us is None or row._us <= mark:
                yield Row(kind="late", row=None, late=tuple(row[c] for c in self.names))
            else:
                fresh.append(tuple(row[c] for c in self.waiting.fieldNames()))
        if fresh:
            self.pending.appendList(fresh)
            self._wake(min(r[-1] for r in fresh))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        named = Row(*self.waiting.fieldNames())
        every = [named(*r) for r in self.pending.get()] if self.pending.exists() else []
        due = [r for r in every if r._us <= mark]
        if not due:  # an earlier timer of this micro-batch has done the work
            return
        tie = self.step.tie
        due.sort(key=lambda r: (r._us, r[tie] is not None, r[tie]))
        carry, found = self.step.advance(tuple(self.carry.get()) if self.carry.exists() else None, due)
        self.carry.update(carry)
        rest = [tuple(r) for r in every if r._us > mark]
        if rest:
            self.pending.put(rest)
            self._wake(min(r[-1] for r in rest))
        else:
            self.pending.clear()
        for row in found:
            yield Row(kind="row", row=row, late=None)


def _watched(stream: DataFrame, ts: str, delay: float) -> DataFrame:
    """The stream with ``_us``; its times move the watermark, but no operator drops its late rows."""
    timed = stream.withColumn("_us", micros(stream, ts)).withColumn("_time", F.timestamp_micros("_us"))
    return timed.withWatermark("_time", f"{round(delay * 1000)} milliseconds").drop("_time")


def in_order(stream: DataFrame, delay: float, step: Step, watched: bool = False) -> DataFrame:
    """Rows ``kind, row, late``: what the step gives for settled rows, and the rows that came too late."""
    rows = StructType([f for f in stream.schema if f.name != "_us"])
    out = StructType().add("kind", "string").add("row", step.result(rows)).add("late", rows)
    timed = stream if watched else _watched(stream, step.ts, delay)
    return timed.groupBy(*step.keys).transformWithState(_InOrder(step, rows), out, "append", "eventTime")


def _tagged(records: DataFrame, samples: DataFrame, step: AsofLast) -> tuple[DataFrame, DataFrame]:
    empty = F.lit(None).cast(samples.schema[step.value].dataType)
    left = records.withColumn(step.value, empty).withColumn(step.sample, F.lit(False))
    return left, samples.select(*step.keys, step.ts, step.tie, step.value, F.lit(True).alias(step.sample))


def asof_rows(records: DataFrame, samples: DataFrame, step: AsofLast) -> DataFrame:
    """Records and samples in one table, as :func:`asof_stream` works on them; for its schema."""
    left, right = _tagged(records, samples, step)
    return left.unionByName(right, allowMissingColumns=True)


def asof_stream(records: DataFrame, samples: DataFrame, delay: float, step: AsofLast) -> DataFrame:
    """Live as-of lookup: each record of one stream waits until no earlier sample of the other can come.

    The watermark is that of the stream that is behind.
    """
    left, right = (_watched(part, step.ts, delay) for part in _tagged(records, samples, step))
    return in_order(left.unionByName(right, allowMissingColumns=True), delay, step, watched=True)


def run(rows: DataFrame, out: str, checkpoint: str, interval: str | None = None):
    """Write what :func:`in_order` or :func:`late_by_window` gives, exactly once across restarts; read it with :func:`results`."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    writer = writer.partitionBy("kind")
    if interval:
        return writer.trigger(processingTime=interval).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _kind(spark: SparkSession, out: str, kind: str, column: str, schema: StructType) -> DataFrame:
    whole = StructType().add(column, schema).add("kind", "string")
    return spark.read.schema(whole).parquet(out).where(F.col("kind") == kind).select(f"{column}.*")


def results(spark: SparkSession, out: str, step: Step, rows: StructType) -> DataFrame:
    """Settled results of a stream whose rows have the schema ``rows``."""
    return _kind(spark, out, "row", "row", step.result(rows))


def late_rows(spark: SparkSession, out: str, rows: StructType) -> DataFrame:
    return _kind(spark, out, "late", "late", rows)


def end_of_stream(spark: SparkSession, schema: StructType, ts: str, path: str, after: float) -> None:
    """Land a file of one row without any value but a time, ``after`` seconds behind the last one landed.

    Once it has been read, every series and window that ends before it is settled; it is never settled itself.
    """
    landed = spark.read.schema(schema).parquet(path)
    last = landed.agg(F.max(micros(landed, ts)).alias("us")).where("us IS NOT NULL")
    last = last.withColumn("us", F.col("us") + round(after * US))
    time = from_micros("us", schema[ts].dataType)
    columns = [time.alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    last.select(*columns).write.mode("append").parquet(path)


# -- windows ----------------------------------------------------------------


def window_means(stream: DataFrame, keys: list[str], value: str, ts: str, width: float, delay: float) -> DataFrame:
    """Count and mean of ``value`` per window of ``width`` seconds and ``keys``, once the watermark has passed the window."""
    timed = stream.withColumn("_time", F.timestamp_micros(micros(stream, ts)))
    watched = timed.withWatermark("_time", f"{round(delay * 1000)} milliseconds")
    window = F.window("_time", f"{round(width * 1000)} milliseconds").alias("window")
    means = tm.snapshot_means(watched, [window, *keys], value).withColumn("_start", F.unix_micros("window.start"))
    snapshot = from_micros("_start", stream.schema[ts].dataType).alias("snapshot")
    return means.select(snapshot, *keys, "n_samples", "avg_utilization")


class _LateByWindow(StatefulProcessor):
    """Keeps nothing: rows whose window the watermark has passed are given out."""

    def __init__(self, width_us: int, names: list[str]):
        self.width, self.names = width_us, names

    def init(self, handle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000 or NONE_YET
        for row in rows:
            if row._us is None or (row._us // self.width + 1) * self.width <= mark:
                yield Row(kind="late", late=tuple(row[c] for c in self.names))


def late_by_window(stream: DataFrame, ts: str, width: float, delay: float) -> DataFrame:
    """``kind, late``: the rows that :func:`window_means` leaves out, in a query of its own.

    It goes by the same rule and the same times, so over the same arrivals (the
    same limits per trigger) it finds the same rows.
    """
    timed = _watched(stream, ts, delay).withColumn("_part", F.pmod(F.xxhash64("_us"), F.lit(1 << 10)))
    out = StructType().add("kind", "string").add("late", stream.schema)
    processor = _LateByWindow(round(width * US), stream.columns)
    return timed.groupBy("_part").transformWithState(processor, out, "append", "eventTime")
