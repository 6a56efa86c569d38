"""Training order over the documents: shuffle, shards, batches, steps."""

from pyspark.sql import DataFrame, SparkSession

from corpusflow.operators.tokenize import token_ids
from corpusflow.plans import bijection, feeds, order
from corpusflow.queries.tables import table
from corpusflow.queries.tokens import DOCUMENT_IDS
from corpusflow.session import spread, stored, work_dir
from corpusflow.settings import EPOCHS


# other intervals than the default, so that saving and evaluation come due at different steps
CALENDAR_SAVE, CALENDAR_EVAL = 500, 300


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id")


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.batch_plan(order.shard_assignment(_ids(spark, sf_dir), ["doc_id"]))


def epoch_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.expand_epochs(_ids(spark, sf_dir)).select("epoch", "doc_id")


def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    expanded = order.expand_epochs(_ids(spark, sf_dir))
    return order.seeded_order(expanded, ["doc_id"]).select("epoch", "position", "doc_id")


def indexed_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three epochs in an order that needs no sort once the rows are numbered."""
    numbered = stored(bijection.number_rows(_ids(spark, sf_dir), "doc_id"), "numbered")
    places = bijection.Bijection(numbered.count())
    return bijection.indexed_order(numbered, places, EPOCHS).select("epoch", "position", "doc_id")


def shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = order.shard_assignment(_ids(spark, sf_dir), ["doc_id"])
    return assigned.select("epoch", "position", "rank", "doc_id")


def rank_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the reporting rank sees, after all ranks were planned."""
    assigned = order.shard_assignment(_ids(spark, sf_dir), ["doc_id"])
    return order.rank_gate(assigned).select("epoch", "position", "doc_id")


def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).select(
        "epoch", "position", "rank", "micro_batch", "slot", "step", "is_partial", "doc_id"
    )


def effective_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.effective_batches(_plan(spark, sf_dir))


def step_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The steps of a run over all line items on two ranks: long enough for saving and evaluation to come due."""
    return order.step_calendar(
        spark, table(spark, sf_dir, "lineitem").count(), world_size=2, save_steps=CALENDAR_SAVE, eval_steps=CALENDAR_EVAL
    )


def _token_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = token_ids(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), ["doc_id"])
    # texts are read and tokenised once, however often the order is computed
    tokens = stored(tokens, "tokens")
    return order.batch_plan(order.blocked_assignment(tokens, ["doc_id"]))


def collate_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus to labelled micro-batches of all epochs, placed on ranks and optimizer steps."""
    return order.collate_batches(_token_plan(spark, sf_dir))


def rank_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same micro-batches as handed to the ranks, padded when they are read."""
    base = work_dir(spark, "feeds")
    feeds.store_segments(_token_plan(spark, sf_dir), f"{base}/segments")
    feeds.write_feeds(spark, f"{base}/segments", f"{base}/ranks")
    return order.pad_batches(feeds.read_feeds(spark, f"{base}/ranks"), more=("place",))


def keep_latest_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusflow.settings import SAVE_TOTAL_LIMIT

    saved = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return order.keep_latest(saved, ["o_custkey"], ["o_orderdate", "o_orderkey"], SAVE_TOTAL_LIMIT)


QUERIES = {
    "epoch_expand": epoch_expand,
    "seeded_shuffle": seeded_shuffle,
    "indexed_shuffle": indexed_shuffle,
    "shard_assignment": shard_assignment,
    "rank_gate": rank_gate,
    "batch_plan": batch_plan,
    "effective_batch": effective_batch,
    "step_calendar": step_calendar,
    "collate_batches": collate_batches,
    "rank_feeds": rank_feeds,
    "keep_latest_k": keep_latest_k,
}

# Seed 42, 3 epochs, 16 ranks, 4 rows per micro-batch, 8 micro-batches per step.
_SHUFFLED = """
    keyed AS (
        SELECT CAST(e.epoch AS INTEGER) AS epoch, d.doc_id,
               md5('42:' || CAST(e.epoch AS VARCHAR) || ':' || CAST(d.doc_id AS VARCHAR)) AS digest
        FROM documents d, range(3) AS e(epoch)),
    shuffled AS (
        SELECT epoch, doc_id, row_number() OVER (PARTITION BY epoch ORDER BY digest, doc_id) - 1 AS place,
               count(*) OVER (PARTITION BY epoch) AS n
        FROM keyed)"""

_SHARDED = f"""{_SHUFFLED},
    totals AS (SELECT count(*) AS n, CAST(ceil(count(*) / 16.0) * 16 AS BIGINT) AS total FROM documents),
    positions AS (SELECT unnest(range(total)) AS position, n FROM totals),
    sharded AS (
        SELECT s.epoch, p.position, CAST(p.position % 16 AS INTEGER) AS rank, s.doc_id, p.n
        FROM positions p JOIN shuffled s ON s.place = p.position % p.n)"""

_PLANNED = f"""{_SHARDED},
    planned AS (
        SELECT epoch, position, rank, (position // 16) // 4 AS micro_batch,
               CAST((position // 16) % 4 AS INTEGER) AS slot, ((position // 16) // 4) // 8 AS step, doc_id
        FROM sharded),
    steps AS (SELECT epoch, step, count(*) AS n_rows, count(*) < 512 AS is_partial FROM planned GROUP BY ALL)"""

_COLLATED = f"""
    WITH {_PLANNED}, {DOCUMENT_IDS},
    rows AS (
        SELECT p.epoch, p.step, p.micro_batch, p.rank, p.slot, t.ids
        FROM planned p JOIN token_ids t ON t.doc_id = p.doc_id)
    SELECT epoch, step, micro_batch, rank,
           list(list_resize(ids, 2048, 0) ORDER BY slot) AS input_ids,
           list(list_resize(list_transform(ids, lambda x: CAST(1 AS INTEGER)), 2048, 0) ORDER BY slot)
               AS attention_mask,
           list(list_resize(ids, 2048, -100) ORDER BY slot) AS labels
    FROM rows GROUP BY epoch, step, micro_batch, rank"""

ORACLE = {
    "epoch_expand": """
        SELECT CAST(e.epoch AS INTEGER) AS epoch, d.doc_id FROM documents d, range(3) AS e(epoch)""",
    "seeded_shuffle": f"WITH {_SHUFFLED} SELECT epoch, place AS position, doc_id FROM shuffled",
    "indexed_shuffle": """
        WITH RECURSIVE numbered AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM documents),
        bases AS (SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS height,
                         ceil(count(*) / ceil(sqrt(count(*))))::BIGINT AS width FROM documents),
        steps AS (
            SELECT doc_id, epoch, n, height, width, row // width AS high, row % width AS low, 0 AS i
            FROM numbered, bases, range(3) epochs(epoch)
            UNION ALL
            SELECT doc_id, epoch, n, height, width,
                   CASE WHEN i % 2 = 0 THEN (high + square * square % 2147483647) % height ELSE high END,
                   CASE WHEN i % 2 = 1 THEN (low + square * square % 2147483647) % width ELSE low END, i + 1
            FROM (SELECT *, (once * once % 2147483647 * 69621 + key) % 2147483647 AS square
                  FROM (SELECT *, (CASE WHEN i % 2 = 0 THEN low ELSE high END + key) % 2147483647 AS once
                        FROM (SELECT *, (epoch * 8191 + i * 131071 + 42 * 1000003) % 2147483647 AS key
                              FROM (SELECT * REPLACE (i % 6 AS i) FROM steps
                                    WHERE NOT (i = 6 AND high * width + low < n))))))
        SELECT epoch::INTEGER AS epoch, high * width + low AS position, doc_id FROM steps WHERE i = 6 AND high * width + low < n""",
    "shard_assignment": f"WITH {_SHARDED} SELECT epoch, position, rank, doc_id FROM sharded",
    "rank_gate": f"WITH {_SHARDED} SELECT epoch, position, doc_id FROM sharded WHERE rank = 0",
    "batch_plan": f"""
        WITH {_PLANNED}
        SELECT p.epoch, position, rank, micro_batch, slot, p.step, s.is_partial, doc_id
        FROM planned p JOIN steps s ON s.epoch = p.epoch AND s.step = p.step""",
    "effective_batch": f"""
        WITH {_PLANNED}
        SELECT epoch, step, n_rows, is_partial, CAST(512 AS INTEGER) AS effective_batch FROM steps""",
    # 2 ranks of 4 rows and 8 micro-batches: 64 rows a step
    "step_calendar": f"""
        WITH steps AS (SELECT CAST(ceil(ceil(count(*) / 2.0) / 32.0) AS BIGINT) AS per_epoch FROM lineitem),
        numbered AS (SELECT unnest(range(1, 3 * per_epoch + 1)) AS global_step, per_epoch FROM steps)
        SELECT CAST((global_step - 1) // per_epoch AS INTEGER) AS epoch, global_step,
               global_step % 10 = 0 AS log_due, global_step % {CALENDAR_SAVE} = 0 AS save_due,
               global_step % {CALENDAR_EVAL} = 0 AS eval_due
        FROM numbered""",
    "collate_batches": _COLLATED,
    # fixed value: 250 steps a segment
    "rank_feeds": f"""
        SELECT *, micro_batch - min(micro_batch) OVER (PARTITION BY epoch, step // 250) AS place FROM ({_COLLATED})""",
    "keep_latest_k": """
        SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 3""",
}
