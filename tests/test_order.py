import hashlib
import math

import pytest
from pyspark.sql import functions as F

from corpusflow.plans import order
from corpusflow.session import stored


def ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "doc_id")


def expected_order(n, epoch, seed=42):
    return sorted(range(n), key=lambda i: (hashlib.md5(f"{seed}:{epoch}:{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("partitions", [1, 7])
def test_order_does_not_depend_on_partitioning(spark, partitions):
    df = order.seeded_order(order.expand_epochs(ids(spark, 200).repartition(partitions), 2), ["doc_id"])
    rows = df.collect()
    for epoch in (0, 1):
        placed = {r.position: r.doc_id for r in rows if r.epoch == epoch}
        assert [placed[i] for i in range(200)] == expected_order(200, epoch)
    assert expected_order(200, 0) != expected_order(200, 1)


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_any_number_of_buckets_gives_the_same_order(spark, digits):
    df = order.seeded_order(order.expand_epochs(ids(spark, 100), 1), ["doc_id"], digits=digits)
    assert [r.doc_id for r in df.orderBy("position").collect()] == expected_order(100, 0)


@pytest.mark.parametrize("n,per_rank", [(5, 1), (10, 1), (33, 3), (16, 1), (1000, 63)])
def test_shards_are_equal_and_wrap_round(spark, n, per_rank):
    rows = order.shard_assignment(ids(spark, n), ["doc_id"], epochs=1).collect()
    shuffled = expected_order(n, 0)
    assert len(rows) == math.ceil(n / 16) * 16
    assert sorted(r.position for r in rows) == list(range(len(rows)))
    for r in rows:
        assert r.rank == r.position % 16 and r.doc_id == shuffled[r.position % n]
    assert {sum(r.rank == k for r in rows) for k in range(16)} == {per_rank}


def test_batches_and_steps(spark):
    plan = order.batch_plan(order.shard_assignment(ids(spark, 1300), ["doc_id"], epochs=1)).collect()
    per_step = {}
    for r in plan:
        local = r.position // 16
        assert (r.micro_batch, r.slot, r.step) == (local // 4, local % 4, local // 32)
        per_step.setdefault((r.step, r.is_partial), []).append(r)
    assert {k: len(v) for k, v in per_step.items()} == {(0, False): 512, (1, False): 512, (2, True): 288}


def test_full_last_step_is_not_partial(spark):
    plan = order.batch_plan(order.shard_assignment(ids(spark, 1024), ["doc_id"], epochs=1))
    found = order.effective_batches(plan).collect()
    assert {(r.step, r.n_rows, r.is_partial, r.effective_batch) for r in found} == {
        (0, 512, False, 512), (1, 512, False, 512),
    }


def test_calendar(spark):
    rows = order.step_calendar(spark, 512 * 400, epochs=3).orderBy("global_step").collect()
    assert len(rows) == 1200 and rows[400].epoch == 1
    assert [r.global_step for r in rows if r.save_due] == [500, 1000]
    assert sum(r.log_due for r in rows) == 120 and all(r.save_due == r.eval_due for r in rows)
    assert order.step_calendar(spark, 0).count() == 0


def test_collated_batches_are_padded_in_slot_order(spark):
    tokens = ids(spark, 5).withColumn("ids", F.transform(F.sequence(F.lit(1), F.col("doc_id") + 1), lambda x: x.cast("int")))
    plan = order.batch_plan(order.shard_assignment(tokens, ["doc_id"], epochs=1, world_size=2), world_size=2)
    rows = order.collate_batches(plan, max_length=6, pad_id=0).collect()
    shuffled = expected_order(5, 0)
    assert len(rows) == 2
    for r in rows:
        docs = [shuffled[p % 5] for p in range(r.rank, 6, 2)]
        assert r.input_ids == [list(range(1, d + 2)) + [0] * (5 - d) for d in docs]
        assert r.attention_mask == [[1] * (d + 1) + [0] * (5 - d) for d in docs]
        assert r.labels == [list(range(1, d + 2)) + [-100] * (5 - d) for d in docs]
    by_mask = order.collate_batches(plan, max_length=6, pad_id=1, mask="attention").collect()
    assert all(1 in labels for r in by_mask for labels in r.labels)


def test_keep_latest(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 1)], "run string, step int")
    kept = order.keep_latest(df, ["run"], ["step"], 3).collect()
    assert sorted((r.run, r.step) for r in kept) == [("a", 2), ("a", 3), ("a", 4), ("b", 1)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_moves_rows_once_and_reads_keys_only(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = plan_of(order.batch_plan(order.shard_assignment(documents.select("doc_id"), ["doc_id"])))
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # rows by bucket; bucket counts; their running sum
    assert plan.count("Exchange hashpartitioning") == 3
    assert "ReadSchema: struct<doc_id:bigint,text" not in plan


def test_counting_buckets_reads_keys_only(spark, sf_dir):
    from corpusflow.operators.tokenize import token_ids

    tokens = stored(token_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"]), "tokens")
    plan = plan_of(order.collate_batches(order.batch_plan(order.shard_assignment(tokens, ["doc_id"], epochs=1))))
    assert plan.count("ReadSchema: struct<doc_id:bigint,ids:array<int>>") == 1
    assert plan.count("ReadSchema: struct<doc_id:bigint>") == 1
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 4


def test_latest_k_prunes_before_the_shuffle(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = plan_of(order.keep_latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], 3))
    assert plan.count("WindowGroupLimit") == 2


def test_blocks_hold_the_same_rows_at_the_same_places(spark):
    """Whatever the sizes; also where the order wraps round, and with ids that repeat."""
    for n, world, digits, block_rows in ((1, 16, 4, 64), (5, 16, 1, 4096), (1000, 16, 3, 64), (1003, 3, 2, 12)):
        rows = ids(spark, n).withColumn("ids", F.array("doc_id"))
        columns = ["epoch", "position", "rank", "n_rows", "doc_id", "ids"]
        want = order.shard(order.seeded_order(order.expand_epochs(rows, 2), ["doc_id"], digits=digits), world).select(columns)
        found = order.blocked_assignment(rows, ["doc_id"], 2, world_size=world, block_rows=block_rows, digits=digits)
        assert sorted(found.select(columns).collect()) == sorted(want.collect())
        plan = order.batch_plan(found, world)
        assert plan.groupBy("epoch", "micro_batch").agg(F.countDistinct("block").alias("n")).where("n > 1").count() == 0
    twice = spark.createDataFrame([(i // 3, [i]) for i in range(600)], "doc_id bigint, ids array<bigint>")
    found = order.blocked_assignment(twice, ["doc_id"], 1, world_size=2, per_device=1, block_rows=2, digits=2).collect()
    assert sorted(r.position for r in found) == list(range(600)) and sorted(r.ids[0] for r in found) == list(range(600))


def test_collation_moves_the_rows_of_a_plan_in_blocks_once(spark, sf_dir):
    from corpusflow.queries.order import collate_batches

    plan = plan_of(collate_batches(spark, sf_dir))
    # rows by block; bucket counts; their running sum
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 3
