"""Mixing sources to target weights by capped water-filling.

Sources share a number of words in proportion to their weights. A source whose
share is above ``epochs`` times its own words is clamped there, and what it leaves
is shared again by the others, until none is above. A source's documents are then
taken as often as its target asks: every document a whole number of times, and a
seeded choice of them once more. One document per source, the one at which the
target is reached, gives only its first words to this last repetition, so that a
source's words equal its target to the nearest word.

The choice goes by a hash of seed, id and text, so it depends neither on files nor
on tasks. Where in the order of hashes a source's target is reached is found by
sums over cells of 15 bits of the hash, then over cells of the one cell in which it
lies, and so on: no task sorts a source, however large.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import table
from corpusflow.llm.ranks import ranked
from corpusflow.session import stored

WEIGHTS = (5, 2, 1)
TOTAL = Fraction(3, 2)
EPOCHS = 2
SEED = 42
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]*"
CELL_BITS = 15
HASH_BITS = 60
CELL_ROWS = 4096


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def seeded_hash(seed: int) -> Column:
    """60 bits of the MD5 of seed, id and text."""
    said = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(said), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def water_fill(sources: DataFrame, total: Fraction = TOTAL, epochs: int = EPOCHS) -> DataFrame:
    """``sources`` (with ``size`` and ``weight``) and their ``target``, a double.

    Each round shares what the clamped sources leave among the others in
    proportion to their weights and clamps those that it lifts above
    ``epochs`` times their size. Rounds compare whole numbers, so no rounding
    decides. A round is one aggregate over the table of sources.
    """
    wide = "decimal(38,0)"
    sources = stored(sources.withColumn("cap", (F.col("size") * epochs).cast(wide)), "mix_sources")
    whole = sources.agg(F.sum(F.col("size").cast(wide)), F.collect_set("weight")).head()
    wanted = total * int(whole[0] or 0)
    level, before = None, -1
    while True:
        clamped = F.lit(False) if level is None else F.col("cap") * level.denominator <= F.col("weight").cast(wide) * level.numerator
        row = sources.agg(
            F.coalesce(F.sum(F.when(clamped, F.col("cap"))), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~clamped, F.col("weight").cast(wide))), F.lit(0)).alias("weight"),
            F.count(F.when(clamped, F.lit(1))).alias("n"),
        ).head()
        if row.n == before or not row.weight:
            break
        before, level = row.n, (wanted - int(row.full)) / int(row.weight)
    if not row.weight:  # all are full, or none has a word
        return sources.withColumn("target", F.col("cap").cast("double")).drop("cap")
    share = F.lit(None).cast("double")
    for weight in whole[1]:
        share = F.when(F.col("weight") == weight, F.lit(float(level * weight))).otherwise(share)
    return sources.withColumn("target", F.when(clamped, F.col("cap").cast("double")).otherwise(share)).drop("cap")


def _cells() -> list[Column]:
    """Cells of the order of a source's rows, coarse to fine: of the hash, then of the row number that breaks ties."""
    mask = (1 << CELL_BITS) - 1
    hashed = [F.shiftright("hash", s).bitwiseAND(mask) for s in range(HASH_BITS - CELL_BITS, -1, -CELL_BITS)]
    return hashed + [F.shiftright("copy", s).bitwiseAND(mask) for s in range(4 * CELL_BITS, -1, -CELL_BITS)]


def _turning_points(rows: DataFrame, need: DataFrame) -> DataFrame:
    """``known, name, hash, copy, part``: the row of each source at which ``need`` words are reached, and its share of them.

    Sources that need nothing have none.
    """
    keys, cells = ["known", "name"], _cells()
    places = [f"cell{i}" for i in range(len(cells))]
    asked = need.where("need > 0")
    for i, cell in enumerate(cells):
        narrowed = _matching(rows, asked, keys, cells[:i], places[:i])
        sums = narrowed.groupBy(*keys, *places[:i], "need", cell.alias(places[i])).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy(*keys).orderBy(places[i])
        counted = sums.withColumn("upto", F.sum("words").over(upto))
        hit = counted.where("upto >= need AND upto - words < need")
        asked = stored(hit.select(*keys, *places[: i + 1], (F.col("need") - F.col("upto") + F.col("words")).alias("need"), "n"), "mix_cells")
        if (asked.agg(F.max("n")).head()[0] or 0) <= CELL_ROWS:
            break
        asked = asked.drop("n")
    last = _matching(rows, asked.drop("n"), keys, cells[: i + 1], places[: i + 1])
    upto = Window.partitionBy(*keys).orderBy("hash", "copy").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = last.withColumn("upto", F.sum("size").over(upto)).where("upto >= need AND upto - size < need")
    return reached.select(*keys, "hash", "copy", (F.col("need") - F.col("upto") + F.col("size")).alias("part"))


def _matching(rows: DataFrame, asked: DataFrame, keys: list[str], cells: list[Column], places: list[str]) -> DataFrame:
    """Rows that lie in the cell their source asks for."""
    named = rows.select("*", *[c.alias(f"own_{p}") for c, p in zip(cells, places)])
    found = named.join(asked, keys)
    for p in places:
        found = found.where(F.col(f"own_{p}") == F.col(p))
    return found.drop(*[f"own_{p}" for p in places])


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    total: Fraction = TOTAL,
    epochs: int = EPOCHS,
    seed: int = SEED,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """What the mix takes of every row: ``doc_id, carry, size, source_size, target, repetitions``.

    ``repetitions`` lists the words of each time the row is taken: ``size`` for
    a whole one, fewer for the one row per source at which the target is
    reached; empty for a row that is left out, as for one without words. Sources
    by code point, null last, weigh ``weights``, repeating; together they take
    ``total`` of all words. Rows equal in id and text are told apart only by
    their order in the input, and give the same rows whichever of them is
    taken. An empty table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").isNotNull().alias("known"),
        F.coalesce("source", F.lit("")).alias("name"),
        word_count(F.col("text")).alias("size"),
        seeded_hash(seed).alias("hash"),
        *[F.col(c).alias(f"carried_{c}") for c in carry],
    )
    rows = stored(rows.withColumn("copy", F.monotonically_increasing_id()), "mix_rows")
    sizes = stored(rows.groupBy("known", "name").agg(F.sum("size").alias("size")), "mix_sizes")
    unknown = (~F.col("known")).alias("unknown")
    order = ranked(sizes.select("*", unknown), [], ["unknown", "name"], "mix_order")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    filled = stored(water_fill(order.select("known", "name", "size", turn.alias("weight")), total, epochs), "mix_targets")
    plan = filled.select(
        "known", "name", F.col("size").alias("source_size"), "target", F.round("target").cast("bigint").alias("taken")
    )
    plan = plan.withColumn("whole", F.expr("CAST(CASE WHEN source_size > 0 THEN taken div source_size ELSE 0 END AS INT)"))
    plan = plan.withColumn("need", F.expr("taken - whole * source_size"))
    turning = _turning_points(rows.select("known", "name", "hash", "copy", "size"), plan.select("known", "name", "need"))
    turning = turning.select("known", "name", F.col("hash").alias("last_hash"), F.col("copy").alias("last_copy"), "part")
    plan = stored(plan.join(turning, ["known", "name"], "left"), "mix_plan")
    placed = rows.join(plan, ["known", "name"])
    row, last = F.struct("hash", "copy"), F.struct(F.col("last_hash").alias("hash"), F.col("last_copy").alias("copy"))
    extra = F.when(F.col("part").isNull(), 0).when(row < last, F.col("size")).when(row == last, F.col("part")).otherwise(0)
    times = F.concat(F.array_repeat("size", F.col("whole")), F.array(extra.cast("bigint")))
    return placed.select(
        "doc_id", *[F.col(f"carried_{c}").alias(c) for c in carry], "size", "source_size", "target",
        F.filter(times, lambda words: words > 0).alias("repetitions"),
    )


def repeated_texts(mixed: DataFrame) -> DataFrame:
    """The rows of a mix that carries ``text``, once per repetition: ``text`` ends after the words taken, counted in ``words``."""
    each = mixed.select("*", F.posexplode("repetitions").alias("repetition", "words"))
    pieces = F.regexp_extract_all("text", F.lit(f"{SPACE}{WORD}"), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    return each.withColumn("text", F.when(F.col("words") < F.col("size"), cut).otherwise(F.col("text"))).drop("repetitions")


def op13_capped_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    words = F.aggregate("repetitions", F.lit(0).cast("bigint"), lambda total, n: total + n)
    return mixed.select("doc_id", "size", "source_size", "target", words.alias("taken"))


ORACLE = {
    "op13_capped_mixture": f"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
                   ('0x' || md5('{SEED}:' || coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, ''))[:15])::BIGINT AS hash
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sized GROUP BY source),
        filling AS (
            SELECT *, 3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER (
                        ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
                   sum(weight) OVER (ORDER BY source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavy
            FROM sources),
        clamped AS (SELECT *, 4 * source_size * heavy <= left_over * weight AS is_full FROM filling),
        level AS (
            SELECT 3 * sum(source_size) - 4 * coalesce(sum(source_size) FILTER (is_full), 0) AS num,
                   2 * sum(weight) FILTER (NOT is_full) AS den
            FROM clamped),
        targets AS (
            SELECT source, source_size,
                   CASE WHEN is_full THEN (2 * source_size)::DOUBLE ELSE (num * weight)::DOUBLE / den::DOUBLE END AS target
            FROM clamped, level),
        plans AS (
            SELECT *, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS whole,
                   CASE WHEN source_size > 0 THEN round(target)::BIGINT % source_size ELSE 0 END AS need
            FROM targets),
        ordered AS (
            SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, p.need,
                   sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash ROWS UNBOUNDED PRECEDING) - s.size AS before
            FROM sized s JOIN plans p ON s.source IS NOT DISTINCT FROM p.source)
        SELECT doc_id, size, source_size, target,
               (whole * size + greatest(0, least(size, need - before)))::BIGINT AS taken
        FROM ordered"""
}
QUERIES = {"op13_capped_mixture": op13_capped_mixture}
