"""Training order: seeded shuffle, rank shards, micro-batches, optimizer steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.settings import (
    BATCH_PER_DEVICE,
    EPOCHS,
    EVAL_STEPS,
    GRADIENT_ACCUMULATION,
    LOGGING_STEPS,
    MAX_LENGTH,
    PAD_ID,
    SAVE_STEPS,
    SEED,
    WORLD_SIZE,
)


BLOCK_ROWS = 4096


def expand_epochs(df: DataFrame, epochs: int = EPOCHS, first: int = 0) -> DataFrame:
    """Every row once per epoch, as a narrow generator."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(first), F.lit(first + epochs - 1))))


def seeded_order(df: DataFrame, keys: list[str], seed: int = SEED, digits: int = 4) -> DataFrame:
    """Add ``position`` (0-based place in the shuffled epoch) and ``n_rows`` of the epoch.

    ``df`` needs an ``epoch`` column, and ``keys`` have to identify a row within
    it. Rows are ordered by a digest of seed, epoch and key, so the order does
    not depend on how the data is partitioned or on retries. The digest spreads
    evenly whatever the keys look like: its first hex ``digits`` form buckets
    that are sorted in parallel and shifted by the number of rows in earlier
    buckets. Only that table of at most ``16**digits`` rows per epoch is
    broadcast, and counting it reads the key columns alone.
    """
    keyed = _keyed(df, keys, seed, digits)
    return _numbered(keyed, _offsets(keyed), keys).drop("_n")


def _keyed(df: DataFrame, keys: list[str], seed: int, digits: int) -> DataFrame:
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), *[F.col(k).cast("string") for k in keys]))
    return df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, digits))


def _offsets(keyed: DataFrame) -> DataFrame:
    """Per epoch and bucket: its number of rows ``_n``, those of earlier buckets, and those of the epoch."""
    counts = keyed.groupBy("epoch", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    per_epoch = Window.partitionBy("epoch")
    earlier = per_epoch.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        F.col("epoch").alias("_epoch"),
        F.col("_bucket").alias("_in"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_n").over(per_epoch).alias("n_rows"),
        "_n",
    )


def _with_offsets(keyed: DataFrame, offsets: DataFrame) -> DataFrame:
    return keyed.join(F.broadcast(offsets), (F.col("epoch") == F.col("_epoch")) & (F.col("_bucket") == F.col("_in"))).drop("_epoch", "_in")


def _numbered(keyed: DataFrame, offsets: DataFrame, keys: list[str]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("epoch", "_bucket").orderBy("_digest", *keys))
    placed = _with_offsets(keyed.withColumn("_place", place), offsets)
    return placed.withColumn("position", F.col("_offset") + F.col("_place") - 1).drop("_digest", "_bucket", "_place", "_offset")


def _rows_per_rank(world_size: int) -> Column:
    return F.expr(f"(n_rows + {world_size - 1}) div {world_size}")


def shard(ordered: DataFrame, world_size: int = WORLD_SIZE) -> DataFrame:
    """Deal the shuffled rows to ranks: rank r takes positions r, r + world_size, ...

    The order wraps round until all ranks have the same number of rows. A row
    emits its own extra positions, so this adds no join and no shuffle.
    """
    total = _rows_per_rank(world_size) * world_size
    wrapped = F.explode(F.sequence(F.col("position"), total - 1, F.col("n_rows")))
    return (
        ordered.withColumn("_position", wrapped)
        .drop("position")
        .withColumnRenamed("_position", "position")
        .withColumn("rank", (F.col("position") % world_size).cast("int"))
    )


def shard_assignment(
    df: DataFrame,
    keys: list[str],
    epochs: int = EPOCHS,
    first_epoch: int = 0,
    seed: int = SEED,
    world_size: int = WORLD_SIZE,
) -> DataFrame:
    """Shuffle and deal all epochs; columns other than ``keys`` travel along."""
    return shard(seeded_order(expand_epochs(df, epochs, first_epoch), keys, seed), world_size)


def blocked_assignment(
    df: DataFrame,
    keys: list[str],
    epochs: int = EPOCHS,
    first_epoch: int = 0,
    seed: int = SEED,
    world_size: int = WORLD_SIZE,
    per_device: int = BATCH_PER_DEVICE,
    block_rows: int = BLOCK_ROWS,
    digits: int = 4,
) -> DataFrame:
    """The rows of :func:`shard_assignment` with their ``block`` of consecutive positions, dealt to tasks by epoch and block.

    For rows that carry much: a block holds whole micro-batches of all ranks, so
    :func:`group_batches` needs no other shuffle. The positions that a bucket of
    :func:`seeded_order` gets are known up to the order in the bucket. Its rows go
    to every block they may lie in (mostly one, as a block has 16 times as many
    rows as a bucket or more), are numbered there, and stay where they belong.
    """
    unit = world_size * per_device
    least = -(-block_rows // unit) * unit
    total = _rows_per_rank(world_size) * world_size
    rows = F.expr(f"greatest({least}, cast(ceil(n_rows * 16 / {16**digits * unit}) AS bigint) * {unit})")
    rounds = F.sequence(F.lit(0), F.floor((total - 1 - F.col("_offset")) / F.col("n_rows")))  # the order wraps round

    def blocks(turn: Column) -> Column:
        first = F.col("_offset") + turn * F.col("n_rows")
        last = F.least(first + F.col("_n") - 1, total - 1)
        return F.sequence(F.floor(first / F.col("_block_rows")), F.floor(last / F.col("_block_rows")))

    keyed = _keyed(expand_epochs(df, epochs, first_epoch), keys, seed, digits)
    offsets = _offsets(keyed).withColumn("_block_rows", rows)
    offsets = offsets.withColumn("_blocks", F.array_distinct(F.flatten(F.transform(rounds, blocks)))).drop("_n")
    dealt = _with_offsets(keyed, offsets).withColumn("block", F.explode("_blocks")).drop("_blocks").repartition("epoch", "block")
    # all columns, so that rows of one key are numbered alike in all blocks of their bucket
    rest = [c for c in df.columns if c not in keys]
    place = F.row_number().over(Window.partitionBy("epoch", "block", "_bucket").orderBy("_digest", *keys, *rest))
    placed = shard(dealt.withColumn("position", F.col("_offset") + place - 1), world_size)
    return placed.where(F.floor(F.col("position") / F.col("_block_rows")) == F.col("block")).drop(
        "_digest", "_bucket", "_offset", "_block_rows"
    )


def rank_gate(df: DataFrame, rank: int = 0) -> DataFrame:
    """Only the rows of the reporting rank."""
    return df.where(F.col("rank") == rank)


def batch_plan(
    sharded: DataFrame,
    world_size: int = WORLD_SIZE,
    per_device: int = BATCH_PER_DEVICE,
    accumulation: int = GRADIENT_ACCUMULATION,
) -> DataFrame:
    """Add ``micro_batch``, ``slot``, optimizer ``step`` and ``is_partial`` (short last step).

    All of it follows from the position: no shuffle.
    """
    per_step = per_device * accumulation
    planned = (
        sharded.withColumn("_local", F.expr(f"position div {world_size}"))
        .withColumn("micro_batch", F.expr(f"_local div {per_device}"))
        .withColumn("slot", (F.col("_local") % per_device).cast("int"))
        .withColumn("step", F.expr(f"_local div {per_step}"))
    )
    short = (F.col("step") + 1) * per_step > _rows_per_rank(world_size)
    return planned.withColumn("is_partial", short).drop("_local")


def effective_batches(
    plan: DataFrame,
    world_size: int = WORLD_SIZE,
    per_device: int = BATCH_PER_DEVICE,
    accumulation: int = GRADIENT_ACCUMULATION,
) -> DataFrame:
    """Rows consumed by each optimizer step next to the nominal effective batch."""
    return (
        plan.groupBy("epoch", "step")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.bool_or("is_partial").alias("is_partial"))
        .withColumn("effective_batch", F.lit(per_device * world_size * accumulation))
    )


def step_calendar(
    spark: SparkSession,
    n_examples: int,
    epochs: int = EPOCHS,
    world_size: int = WORLD_SIZE,
    per_device: int = BATCH_PER_DEVICE,
    accumulation: int = GRADIENT_ACCUMULATION,
    logging_steps: int = LOGGING_STEPS,
    save_steps: int = SAVE_STEPS,
    eval_steps: int = EVAL_STEPS,
) -> DataFrame:
    """One row per optimizer step of the run, with what is due after it.

    Needs only the number of examples, so the plan itself is not computed again.
    """
    per_rank = -(-n_examples // world_size)
    per_epoch = -(-per_rank // (per_device * accumulation))
    step = F.col("global_step")
    return (
        spark.range(1, epochs * per_epoch + 1)
        .withColumnRenamed("id", "global_step")
        .select(
            F.expr(f"(global_step - 1) div {max(per_epoch, 1)}").cast("int").alias("epoch"),
            "global_step",
            (step % logging_steps == 0).alias("log_due"),
            (step % save_steps == 0).alias("save_due"),
            (step % eval_steps == 0).alias("eval_due"),
        )
    )


def group_batches(plan: DataFrame, *more: str) -> DataFrame:
    """One row per micro-batch, with ``rows`` (``slot``, unpadded ``ids``) in slot order; at most ``per_device`` of them.

    A plan in blocks (:func:`blocked_assignment`) is grouped where its rows lie.
    """
    where = ["block"] if "block" in plan.columns else []
    groups = plan.groupBy("epoch", *where, *more, "step", "micro_batch", "rank")
    return groups.agg(F.array_sort(F.collect_list(F.struct("slot", "ids"))).alias("rows")).drop(*where)


def pad_batches(
    groups: DataFrame,
    max_length: int = MAX_LENGTH,
    pad_id: int = PAD_ID,
    mask: str = "pad_id",
    side: str = "right",
    more: tuple[str, ...] = (),
) -> DataFrame:
    """Input ids, masks and labels of the rows of :func:`group_batches`, and ``more`` of its columns; a narrow map."""
    return groups.select(
        "epoch",
        "step",
        "micro_batch",
        "rank",
        *more,
        F.transform("rows", lambda r: tx.pad(r["ids"], max_length, pad_id, side)).alias("input_ids"),
        F.transform("rows", lambda r: tx.attention_mask(F.size(r["ids"]), max_length, side)).alias("attention_mask"),
        F.transform("rows", lambda r: tx.padded_labels(r["ids"], max_length, mask, pad_id, side)).alias("labels"),
    )


def collate_batches(
    plan: DataFrame, max_length: int = MAX_LENGTH, pad_id: int = PAD_ID, mask: str = "pad_id", side: str = "right"
) -> DataFrame:
    """One row per micro-batch: input ids, masks and labels of its rows, in slot order.

    ``plan`` carries unpadded ``ids``. A group holds at most ``per_device`` rows;
    padding is added only after the shuffle, which therefore moves real tokens.
    """
    return pad_batches(group_batches(plan), max_length, pad_id, mask, side)


def keep_latest(df: DataFrame, keys: list[str], order: list[str], k: int) -> DataFrame:
    """The last ``k`` rows per key. Spark prunes to ``k`` per task before it shuffles."""
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= k).drop("_n")
