"""Batches handed to the ranks: every rank's micro-batches in order, all ranks or none.

A run is cut into segments of some optimizer steps. The tasks that write a segment
are one barrier stage, a task per rank (or per few ranks, if the cluster has fewer
cores than ranks): they start together, tell each other at the end how many batches
each rank got, and if one fails (Spark then gives up the stage, as it writes files) the
segment is written again by all. A segment counts from the
moment it is in the log, so a rank never sees batches that another rank lacks, and
a run that was stopped goes on at the first segment that is not in the log.

Barrier stages need as many free cores as tasks, and do not go with dynamic allocation.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.plans import order
from corpusflow.settings import WORLD_SIZE

SEGMENT_STEPS = 250
GROUPS = (
    "epoch int, segment bigint, step bigint, micro_batch bigint, rank int, "
    "rows array<struct<slot:int,ids:array<int>>>"
)
FEED = f"{GROUPS}, place bigint"
LOG = "epoch int, segment bigint, n_batches bigint"


class UnequalRanks(ValueError):
    """Ranks would get different numbers of batches, or one of them batches with a gap."""


def store_segments(plan: DataFrame, path: str, segment_steps: int = SEGMENT_STEPS) -> None:
    """Write the micro-batches of a plan that carries ``ids`` below ``path``, a folder for each segment of an epoch.

    One shuffle brings the rows of a segment and rank together, and both the
    grouping and the files use it; a plan in blocks has them together already.
    A segment holds ``segment_steps`` steps' rows, however long the run.
    """
    cut = plan.withColumn("segment", F.expr(f"step div {segment_steps}"))
    if "block" not in cut.columns:
        cut = cut.repartition("epoch", "segment", "rank")
    groups = order.group_batches(cut, "segment")
    groups.write.mode("overwrite").partitionBy("epoch", "segment").parquet(path)


def _hand_over(world_size: int):
    """Number every rank's batches as they pass; fail unless each rank has the same, without a gap and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext

        seen: dict[int, list[int]] = {}  # rank: first micro-batch, number of them
        fault = None
        for batch in batches:
            place = np.empty(batch.num_rows, np.int64)
            keys = zip(batch.column("rank").to_pylist(), batch.column("micro_batch").to_pylist())
            for i, (rank, micro_batch) in enumerate(keys):
                first, count = seen.setdefault(rank, [micro_batch, 0])
                if micro_batch != first + count:
                    fault = fault or f"rank {rank} has micro-batch {micro_batch} instead of {first + count}"
                place[i], seen[rank][1] = count, count + 1
            yield batch.append_column("place", pa.array(place))
        # every task takes part, also one that has found a fault: the others wait for it
        told = [json.loads(m) for m in BarrierTaskContext.get().allGather(json.dumps([fault, sorted(seen.items())]))]
        faults = [f for f, _ in told if f]
        ranks = sorted((rank, *extent) for _, extents in told for rank, extent in extents)
        if not faults and ([r[0] for r in ranks] != list(range(world_size)) or len({r[1:] for r in ranks}) != 1):
            faults = [f"ranks differ (rank, first micro-batch, batches): {ranks}"]
        if faults:
            raise UnequalRanks(faults[0])

    return run


def finished_segments(spark: SparkSession, path: str) -> list[tuple[int, int, int]]:
    """Epoch, segment and batches per rank of all segments in the log below ``path``; a row per segment, so few."""
    log = spark.read.schema(LOG).option("recursiveFileLookup", True).json(f"{path}/log")
    return sorted({tuple(r) for r in log.collect()})


def write_feeds(spark: SparkSession, segments: str, path: str, world_size: int = WORLD_SIZE, attempts: int = 4) -> list[tuple[int, int]]:
    """Feed all segments stored at ``segments`` that are not in the log yet, in order; returns which.

    A segment that was cut off is written again from its start. A file holds whole
    ranks, sorted, so a rank's reader skips the other ranks by the statistics of
    row groups. An empty plan has no segments and writes nothing. A segment that
    fails is written up to ``attempts`` times; ranks with different numbers of
    batches, or a gap between them, fail it at once and leave the log as it was.
    """
    groups = spark.read.schema(GROUPS).parquet(segments)
    wanted = sorted(tuple(r) for r in groups.select("epoch", "segment").distinct().collect())
    spark.createDataFrame([], LOG).write.mode("ignore").json(f"{path}/log/start")
    done = {(epoch, segment) for epoch, segment, _ in finished_segments(spark, path)}
    tasks = min(world_size, spark.sparkContext.defaultParallelism)
    written = []
    for epoch, segment in wanted:
        if (epoch, segment) in done:
            continue
        mine = groups.where((F.col("epoch") == epoch) & (F.col("segment") == segment))
        mine = mine.select("epoch", "segment", "step", "micro_batch", "rank", "rows")
        dealt = mine.repartitionById(tasks, F.col("rank") % tasks).sortWithinPartitions("rank", "micro_batch")
        feed = dealt.mapInArrow(_hand_over(world_size), FEED, barrier=True)
        target = f"{path}/feeds/{epoch}-{segment}"
        for attempt in range(attempts):
            try:
                feed.write.mode("overwrite").parquet(target)
                break
            except (Py4JJavaError, PySparkException) as error:
                if attempt + 1 == attempts or UnequalRanks.__name__ in str(error):
                    raise
        count = spark.read.schema(FEED).parquet(target).where("rank = 0").count()
        record = spark.createDataFrame([(epoch, segment, count)], LOG).coalesce(1)
        record.write.mode("overwrite").json(f"{path}/log/{epoch}-{segment}")
        written.append((epoch, segment))
    return written


def read_feeds(spark: SparkSession, path: str, rank: int | None = None) -> DataFrame:
    """The batches of all segments in the log (of one rank), each with its ``place`` in the rank's segment.

    The rows of a rank lie in a segment's file in that order.
    """
    folders = [f"{path}/feeds/{epoch}-{segment}" for epoch, segment, _ in finished_segments(spark, path)]
    feed = spark.read.schema(FEED).parquet(*folders) if folders else spark.createDataFrame([], FEED)
    return feed if rank is None else feed.where(F.col("rank") == rank)
