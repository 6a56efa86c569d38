"""Places of rows in a total order, without a task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import parallelism
from corpusflow.session import stored

POSITION_BITS = 33


def ranked(rows: DataFrame, keys: list[str], order: list[str], label: str) -> DataFrame:
    """``rows`` with ``rank``, the place (from 0) among the rows of equal ``keys`` in the order of ``order``.

    Rows are dealt by ranges of keys and order, so a hot key fills as many
    tasks as its rows need, provided that ``order`` tells its rows apart. Each
    task numbers its sorted rows; the counts of a key's earlier tasks, one row
    per task and key, are added. Keys must not be null; nulls come first in
    ``order``. Needs input that is the same when read again (``stored``).
    """
    dealt = rows.repartitionByRange(parallelism(rows.sparkSession), *keys, *order).sortWithinPartitions(*keys, *order)
    placed = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("_task", F.shiftright("_at", POSITION_BITS))
    spans = placed.groupBy(*keys, "_task").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    spans = spans.select(*keys, "_task", shift.alias("_shift"))
    return placed.join(spans, [*keys, "_task"]).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("rank"))
