"""Ordered per-key work that stays parallel when one key holds a large share of the rows.

Keys are counted first (a combined aggregate of the key columns). A key with
more than ``rows_per_chunk`` rows is cut into consecutive slices of its order;
every slice is worked on by its own task, and the little that has to pass from
one slice to the next (a count, the last value) goes through a summary of one
row per slice. Cuts are quantiles of the order itself, so crowded times are cut
as evenly as others, and a time that fills slices by itself is cut by the column
that breaks ties. Without such keys nothing is added to the plan. Rows without a
time come first, as Spark sorts them. Both paths give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.settings import ROWS_PER_CHUNK

MAX_SLICES = 4096
NO_TIME = -(1 << 63)
EVERY = 8


def join_small(df: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a summary on keys that may be NULL; how it is done is the planner's choice."""
    renamed = small.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in small.columns if c not in keys]
    )
    condition = F.lit(True)
    for k in keys:
        condition = condition & df[k].eqNullSafe(renamed[f"_key_{k}"])
    return df.join(renamed, condition, "left").drop(*[f"_key_{k}" for k in keys])


def _cut_bounds(df: DataFrame, keys: list[str], place: str, rows: int, limit: int, min_width: int) -> DataFrame | None:
    """``_cuts``, the last ``place`` of all slices but the last, for groups of more than ``limit`` rows; None without any.

    Percentiles have to be constants: as many as the largest group needs, of
    which smaller groups take a part. Sketches are merged, so no task sees a
    whole group.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    largest = counted.agg(F.max("_n")).head()[0]
    if largest is None:
        return None
    most = min(MAX_SLICES, -(-largest // rows))
    slices = F.least(F.lit(most), F.ceil(F.col("_n") / rows)).cast("int")
    rows_of_large = join_small(df.select(*keys, place), counted, keys).where("_n IS NOT NULL")
    points = rows_of_large.groupBy(*keys).agg(
        F.max(slices).alias("_slices"),
        F.percentile_approx(place, [i / most for i in range(1, most)], max(10_000, 50 * most)).alias("_points"),
    )
    nearest = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("_slices") - 1)),
        lambda i: F.element_at(
            "_points", F.least(F.lit(most - 1), F.greatest(F.lit(1), F.round(i * most / F.col("_slices")).cast("int")))
        ),
    )
    cuts = F.array_distinct(nearest)
    if min_width > 1:  # wider slices, of up to eight times as many rows
        cuts = F.filter(
            cuts, lambda c, i: (i % EVERY == 0) | (c - F.get(F.col("_all"), i - 1) >= min_width)
        )
    return points.withColumn("_all", F.array_distinct(nearest)).select(*keys, cuts.alias("_cuts"))


def _slice_of(df: DataFrame, bounds: DataFrame, keys: list[str], place: str, name: str) -> DataFrame:
    """Add the number of cuts below ``place``, NULL for groups without cuts."""
    below = F.size(F.filter("_cuts", lambda c: c < F.col(place))).cast("bigint")
    return join_small(df, bounds, keys).withColumn(name, F.when(F.col("_cuts").isNotNull(), below)).drop("_cuts")


def split_hot_keys(
    df: DataFrame,
    keys: list[str],
    along: str,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    min_width: int = 1,
    tie: str | None = None,
) -> DataFrame:
    """Add ``chunk``: NULL for ordinary keys, the slice number along ``along`` (an integer column) for hot ones.

    Numbers grow along ``along`` and then ``tie``, a number that orders rows of
    one time. ``min_width`` asks for wider slices, of up to eight times as many
    rows.
    """
    timed = df.withColumn("_place", F.coalesce(F.col(along), F.lit(NO_TIME)))
    bounds = _cut_bounds(timed, keys, "_place", rows_per_chunk, rows_per_chunk, min_width)
    if bounds is None:
        return df.withColumn("chunk", F.lit(None).cast("bigint"))
    split = _slice_of(timed, bounds, keys, "_place", "_outer")
    if tie is None:
        return split.drop("_place").withColumnRenamed("_outer", "chunk")
    ranked = split.withColumn("_rank", F.coalesce(F.col(tie).cast("bigint"), F.lit(NO_TIME)))
    # slices of one time only: their rows are told apart by the tie
    inside = [*keys, "_outer", "_place"]
    bounds = _cut_bounds(
        ranked.where("_outer IS NOT NULL"), inside, "_rank", rows_per_chunk, 2 * rows_per_chunk * (EVERY if min_width > 1 else 1), 1
    )
    if bounds is None:
        chunk = F.col("_outer")
        return split.withColumn("chunk", chunk).drop("_place", "_outer")
    inner = _slice_of(ranked, bounds, inside, "_rank", "_inner")
    # before, inside and after the crowded time of a slice
    crowded = bounds.select(*keys, "_outer", F.col("_place").alias("_crowded")).groupBy(*keys, "_outer").agg(F.collect_list("_crowded").alias("_crowds"))
    marked = join_small(inner, crowded, [*keys, "_outer"])
    before = F.size(F.filter("_crowds", lambda c: c < F.col("_place"))) + F.size(F.filter("_crowds", lambda c: c <= F.col("_place")))
    step = F.when(F.col("_crowds").isNull(), F.lit(0)).otherwise(before).cast("bigint")
    chunk = F.col("_outer") * (1 << 40) + step * (1 << 20) + F.coalesce("_inner", F.lit(0))
    return marked.withColumn("chunk", chunk).drop("_place", "_outer", "_inner", "_rank", "_crowds")


def number_chunks(split: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Add ``idx``, the 0-based place of each row within its key, to rows that know their ``chunk``."""
    counts = split.where(F.col("chunk").isNotNull()).groupBy(*keys, "chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "chunk", F.sum("_n").over(earlier).alias("_offset"))
    local = Window.partitionBy(*keys, "chunk").orderBy(*order)
    numbered = split.withColumn("idx", F.row_number().over(local).cast("bigint") - 1)
    return (
        join_small(numbered, offsets, [*keys, "chunk"])
        .withColumn("idx", F.col("idx") + F.coalesce("_offset", F.lit(0)))
        .drop("_offset", "chunk")
    )


def index_within(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    along: str,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Number the rows of each key.

    ``along`` has to be the leading ordering column, as an integer; the next
    column of ``order`` breaks ties and, if it is a number, cuts crowded times.
    """
    return number_chunks(split_hot_keys(df, keys, along, rows_per_chunk, tie=tie_number(df, order)), keys, order)


def tie_number(df: DataFrame, order: list[str]) -> str | None:
    """The column after the first of ``order`` if it is an integer."""
    integer = {"tinyint", "smallint", "int", "bigint"}
    return order[1] if len(order) > 1 and dict(df.dtypes)[order[1]] in integer else None
