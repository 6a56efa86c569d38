"""A shuffle without a sort: a keyed bijection between row numbers and positions.

Row and position are pairs of digits (``high * width + low``); rounds add to one
digit a hash of the other, of the seed and of the epoch, which can be undone. The
product of both bases is a little larger than the number of rows: what lands beyond
is sent through again until it is a row. Any row's position, and the row at any
position, of any epoch is so computed on its own, and a run resumes in the middle of
an epoch without planning what lies before.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.hot_keys import index_within
from corpusflow.settings import SEED, WORLD_SIZE

ROUNDS = 6
PRIME = (1 << 31) - 1
FACTOR = 69621
MOST_WALKS = 64


@dataclass
class Bijection:
    """Of the numbers below ``rows``, for each seed and epoch another one."""

    rows: int
    seed: int = SEED

    def __post_init__(self):
        self.height = max(1, math.isqrt(max(0, self.rows - 1)) + 1)
        self.width = max(1, -(-self.rows // self.height))

    def _mixed(self, digit: Column, epoch: Column, step: Column) -> Column:
        key = (epoch * 8191 + step * 131071 + (self.seed * 1000003) % PRIME) % PRIME
        once = (digit + key) % PRIME
        square = (once * once % PRIME * FACTOR + key) % PRIME
        return square * square % PRIME

    def _pass(self, number: Column, epoch: Column, back: bool) -> Column:
        sign = -1 if back else 1

        def step(pair: Column, i: Column) -> Column:
            high, low = pair["high"], pair["low"]
            new_high = F.pmod(high + sign * self._mixed(low, epoch, i), F.lit(self.height))
            new_low = F.pmod(low + sign * self._mixed(high, epoch, i), F.lit(self.width))
            even = i % 2 == 0
            return F.struct(F.when(even, new_high).otherwise(high).alias("high"), F.when(even, low).otherwise(new_low).alias("low"))

        first = F.struct(F.floor(number / self.width).alias("high"), (number % self.width).alias("low"))
        if self.rows > 1 << 52:
            raise ValueError("too many rows")
        steps = [F.lit(i).cast("bigint") for i in range(ROUNDS)]
        return F.aggregate(F.array(*(reversed(steps) if back else steps)), first, step, lambda p: p["high"] * self.width + p["low"])

    def _walk(self, number: Column, epoch: Column, back: bool) -> Column:
        number, epoch = number.cast("bigint"), epoch.cast("bigint")
        again = F.array(*[F.lit(0)] * (MOST_WALKS - 1))
        end = F.aggregate(
            again,
            self._pass(number, epoch, back),
            lambda found, _: F.when(found >= self.rows, self._pass(found, epoch, back)).otherwise(found),
        )
        inside = (number >= 0) & (number < self.rows)
        return F.when(inside, F.when(end < self.rows, end).otherwise(F.raise_error(F.lit("no row found")).cast("bigint")))

    def position_of(self, row: Column, epoch: Column) -> Column:
        """Place of a row in an epoch; null for a number that is no row."""
        return self._walk(row, epoch, back=False)

    def row_at(self, position: Column, epoch: Column) -> Column:
        """The row at a place of an epoch."""
        return self._walk(position, epoch, back=True)


def number_rows(df: DataFrame, key: str) -> DataFrame:
    """Add ``row``, the 0-based place in the order of the integer column ``key``; done once for a dataset."""
    every = df.withColumn("_all", F.lit(0))
    return index_within(every, ["_all"], [key], key).drop("_all").withColumnRenamed("idx", "row")


def indexed_order(numbered: DataFrame, bijection: Bijection, epochs: int, first: int = 0) -> DataFrame:
    """Rows once per epoch with their ``position``: a narrow map."""
    each = numbered.withColumn("epoch", F.explode(F.sequence(F.lit(first), F.lit(first + epochs - 1))))
    return each.withColumn("position", bijection.position_of(F.col("row"), F.col("epoch")))


def rows_from(spark, bijection: Bijection, epoch: int, start: int, rank: int, world_size: int = WORLD_SIZE) -> DataFrame:
    """``position, row`` of what a rank still has to read of an epoch from position ``start`` on."""
    mine = start + (rank - start) % world_size
    places = spark.range(mine, max(mine, bijection.rows), world_size).withColumnRenamed("id", "position")
    return places.withColumn("row", bijection.row_at(F.col("position"), F.lit(epoch)))
