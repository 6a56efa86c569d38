"""Feeds hold what the collated plan holds, rank by rank and in order; all ranks or none."""

import pytest
from pyspark.sql import functions as F

from corpusflow.plans import feeds, order

WORLD = 4  # as many as the session's cores


def planned(spark, rows, epochs=2, world=WORLD):
    df = spark.range(rows).select(F.col("id").alias("doc_id"), F.array(F.col("id").cast("int"), F.lit(7)).alias("ids"))
    assigned = order.shard_assignment(df, ["doc_id"], epochs, world_size=world)
    return order.batch_plan(assigned, world, per_device=2, accumulation=2)


def stored_plan(spark, tmp_path, rows, world=WORLD, steps=3):
    plan, segments = planned(spark, rows, world=world), str(tmp_path / "segments")
    feeds.store_segments(plan, segments, steps)
    return plan, segments


def batches(df):
    return sorted((r.epoch, r.step, r.micro_batch, r.rank, tuple(map(tuple, r.rows))) for r in df.collect())


@pytest.mark.parametrize("world", [1, 3, 4, 6])
def test_feeds_are_the_plan_in_order(spark, tmp_path, world):
    plan, segments = stored_plan(spark, tmp_path, 101, world, steps=101 // (world * 8) + 1)
    path = str(tmp_path / "feeds")
    written = feeds.write_feeds(spark, segments, path, world)
    assert written == [(e, s) for e in range(2) for s in range(written[-1][1] + 1)] and len(written) > 2
    assert batches(feeds.read_feeds(spark, path)) == batches(order.group_batches(plan))
    lying = feeds.read_feeds(spark, path).select("*", "_metadata.file_path", F.col("_metadata.row_index").alias("at")).collect()
    cells = {}
    for r in sorted(lying, key=lambda r: r["at"]):
        cells.setdefault((r.epoch, r.segment, r["rank"]), []).append(r)
    for cell in cells.values():
        assert len({r.file_path for r in cell}) == 1  # a rank's segment is one file,
        assert [r.place for r in cell] == list(range(len(cell)))  # its rows lie in order
        assert [r.micro_batch for r in cell] == sorted(r.micro_batch for r in cell)
    assert len({(r.epoch, r.segment, len(cells[r.epoch, r.segment, r["rank"]])) for r in lying}) == len(written)
    one = feeds.read_feeds(spark, path, rank=world - 1)
    assert batches(one) == [b for b in batches(order.group_batches(plan)) if b[3] == world - 1]


def test_a_stopped_run_goes_on(spark, tmp_path):
    plan, segments = stored_plan(spark, tmp_path, 90)
    path = str(tmp_path / "feeds")
    wanted = feeds.write_feeds(spark, segments, str(tmp_path / "other"), WORLD)
    # a segment whose files are there but that is not in the log: written again
    spark.range(3).write.parquet(f"{path}/feeds/{wanted[1][0]}-{wanted[1][1]}")
    first = spark.read.parquet(segments).where("epoch = 0 AND segment = 0")
    first.write.partitionBy("epoch", "segment").parquet(str(tmp_path / "part"))
    assert feeds.write_feeds(spark, str(tmp_path / "part"), path, WORLD) == wanted[:1]
    assert feeds.write_feeds(spark, segments, path, WORLD) == wanted[1:]
    assert feeds.write_feeds(spark, segments, path, WORLD) == []
    assert batches(feeds.read_feeds(spark, path)) == batches(order.group_batches(plan))


@pytest.mark.parametrize(
    "lost", ["rank = 1 AND micro_batch = 3", "rank = 2", "rank = 0 AND micro_batch = 5", "rank = 3 AND micro_batch = 0"]
)
def test_no_rank_gets_a_segment_that_another_lacks(spark, tmp_path, lost):
    whole = planned(spark, 90, epochs=1)
    feeds.store_segments(whole.where(f"NOT ({lost})"), str(tmp_path / "segments"), 100)
    path = str(tmp_path / "feeds")
    with pytest.raises(Exception, match="UnequalRanks.*rank"):
        feeds.write_feeds(spark, str(tmp_path / "segments"), path, WORLD)
    assert feeds.finished_segments(spark, path) == []
    assert feeds.read_feeds(spark, path).collect() == []
    feeds.store_segments(whole, str(tmp_path / "segments"), 100)
    assert feeds.write_feeds(spark, str(tmp_path / "segments"), path, WORLD) == [(0, 0)]
    assert batches(feeds.read_feeds(spark, path)) == batches(order.group_batches(whole))


def test_a_failed_task_restarts_all(spark, tmp_path):
    """The task of one rank fails once: all write again, the feed has each batch once."""
    plan, segments = stored_plan(spark, tmp_path, 90, steps=100)
    mark, path, honest = str(tmp_path / "mark"), str(tmp_path / "feeds"), feeds._hand_over

    def failing(world_size):
        run = honest(world_size)

        def once(rows):
            import os

            from pyspark import BarrierTaskContext

            if BarrierTaskContext.get().partitionId() == 2 and not os.path.exists(mark):
                open(mark, "w").close()
                raise RuntimeError("lost")
            yield from run(rows)

        return once

    feeds._hand_over = failing
    try:
        assert feeds.write_feeds(spark, segments, path, WORLD) == [(0, 0), (1, 0)]
    finally:
        feeds._hand_over = honest
    assert (tmp_path / "mark").exists()
    assert batches(feeds.read_feeds(spark, path)) == batches(order.group_batches(plan))


def test_empty_plan(spark, tmp_path):
    _, segments = stored_plan(spark, tmp_path, 0)
    path = str(tmp_path / "feeds")
    assert feeds.write_feeds(spark, segments, path, WORLD) == []
    assert feeds.read_feeds(spark, path).collect() == []
