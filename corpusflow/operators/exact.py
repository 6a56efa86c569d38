"""Sums of doubles that do not depend on the order of addition, in batch and in streams.

A double is a whole number of units of 2**-1074. It is cut into four limbs of 20
bits, each a whole number at a place of its own; sums of whole numbers are exact in
any order and merge in any tree, so Spark sums the limbs per key and place (partial
sums in every task: a hot key costs a few rows per task). Only the limbs of a key,
105 at most, are put together again, and rounded once.

A limb's sum is a BIGINT: it holds 2**43 values of one key, and more of them end
the query with an overflow error (under ANSI mode, Spark's default).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

BITS = 20
LIMBS = 4
LOWEST = -1074
TOP = (1023 - LOWEST) // BITS
# places that no limb has
COUNT, NAN, PLUS, MINUS = -1, -2, -3, -4


def exact_parts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys, place, part``: the limbs of every value that is not null, and a one to count it. A narrow map.

    Dividing by a power of two, cutting off the fraction and taking away what was
    cut are exact operations on doubles. The logarithm may miss the first place
    by one at a border; four limbs hold the 53 bits then too.
    """
    if {"place", "part"} & set(keys):
        raise ValueError("keys may not be called place or part")
    units = F.array(*[F.lit(math.ldexp(1.0, BITS * place + LOWEST)) for place in range(TOP + 1)])
    number = F.col(value).cast("double")
    kind = F.when(F.isnan(number), NAN).when(number == math.inf, PLUS).when(number == -math.inf, MINUS).otherwise(COUNT)
    rows = df.select(*keys, kind.alias("_exact_kind"), number.alias("_exact_rest")).where(F.col("_exact_rest").isNotNull())
    rows = rows.withColumn("_exact_rest", F.when(F.col("_exact_kind") == COUNT, F.col("_exact_rest")).otherwise(0.0))
    first = F.coalesce(F.floor((F.log2(F.abs("_exact_rest")) - LOWEST) / BITS), F.lit(0))
    rows = rows.withColumn("_exact_place", F.least(F.greatest(first, F.lit(LIMBS - 1)), F.lit(TOP)).cast("int"))
    for limb in range(LIMBS):
        unit = F.element_at(units, F.col("_exact_place") + (1 - limb))
        rows = rows.withColumn(f"_exact_part{limb}", (F.col("_exact_rest") / unit).cast("bigint"))
        rows = rows.withColumn("_exact_rest", F.col("_exact_rest") - F.col(f"_exact_part{limb}") * unit)
    limbs = [F.struct((F.col("_exact_place") - limb).alias("place"), F.col(f"_exact_part{limb}").alias("part")) for limb in range(LIMBS)]
    one = F.lit(1).cast("bigint").alias("part")
    counted = F.struct(F.lit(COUNT).alias("place"), one)
    odd = F.struct(F.col("_exact_kind").alias("place"), F.when(F.col("_exact_kind") != COUNT, 1).otherwise(0).cast("bigint").alias("part"))
    return rows.select(*keys, F.inline(F.array(*limbs, counted, odd))).where(F.col("part") != 0)


def _sums(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys, "place").agg(F.sum("part").alias("part"))


def rounded_sum(places: Sequence[int], parts: Sequence[int]) -> float:
    """The double nearest to the sum of limbs (ties to even); NaN and infinities as IEEE addition has them."""
    limbs = {int(place): int(part) for place, part in zip(places, parts)}
    if NAN in limbs or (PLUS in limbs and MINUS in limbs):
        return math.nan
    if PLUS in limbs or MINUS in limbs:
        return math.inf if PLUS in limbs else -math.inf
    units = sum(part << BITS * place for place, part in limbs.items() if place >= 0)
    try:
        return units / (1 << -LOWEST)  # whole numbers are divided with one correct rounding
    except OverflowError:
        return math.inf if units > 0 else -math.inf


@F.pandas_udf(DoubleType())
def _rounded(places: pd.Series, parts: pd.Series) -> pd.Series:
    return pd.Series([rounded_sum(a, b) for a, b in zip(places, parts)], dtype="float64")


def exact_totals(sums: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, n_values, exact_sum, exact_mean`` from the summed limbs of each key (one row per key and place)."""
    whole = sums.groupBy(*keys).agg(
        F.max(F.when(F.col("place") == COUNT, F.col("part"))).alias("n_values"),
        F.collect_list(F.struct("place", "part")).alias("_limbs"),
    )
    # a NaN comes back from pandas as a null
    total = F.coalesce(_rounded("_limbs.place", "_limbs.part"), F.lit(math.nan))
    totals = whole.select(*keys, "n_values", total.alias("exact_sum"))
    return totals.withColumn("exact_mean", F.col("exact_sum") / F.col("n_values"))


def exact_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Count, sum and mean of each series, the same to the last bit however the rows are partitioned or ordered.

    The sum is the exact one, rounded once; the mean is this sum divided by the
    count. Nulls do not count, and a series of nothing else has no row. A null
    key is a key. The sum of negative zeros is zero. NaN, infinities, and sums
    beyond the largest double give what IEEE addition gives.
    """
    return exact_totals(_sums(exact_parts(df, keys, value), keys), keys)


def running_limbs(events: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The limbs so far, for streams in update mode; the state is a number per key and place.

    Keep the newest with ``run_updates`` by ``[*keys, "place"]`` and turn them
    into statistics with :func:`exact_totals`.
    """
    return _sums(exact_parts(events, keys, value), keys)
