"""The keyed order is a permutation that can be entered anywhere."""

import pytest
from pyspark.sql import functions as F

from corpusflow.plans import bijection as bj


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 10, 101, 5000])
def test_permutations_and_their_inverse(spark, rows):
    order, numbers = bj.Bijection(rows, seed=7), spark.range(rows).withColumnRenamed("id", "row")
    seen = {}
    for r in bj.indexed_order(numbers, order, 3).withColumn("back", order.row_at(F.col("position"), F.col("epoch"))).collect():
        assert r.back == r.row
        seen.setdefault(r.epoch, {})[r.row] = r.position
    assert all(sorted(places.values()) == list(range(rows)) for places in seen.values())
    if rows >= 101:
        assert len({tuple(sorted(p.items())) for p in seen.values()}) == 3
        moved = sum(abs(p - row) for row, p in seen[0].items()) / rows
        assert 0.25 * rows < moved < 0.42 * rows  # a third for a random order
        follow = sum(seen[0][r + 1] == seen[0][r] + 1 for r in range(rows - 1))
        assert follow < 0.05 * rows


def test_a_rank_resumes_in_the_middle(spark):
    order = bj.Bijection(1000)
    whole = {r.position: r.row for r in bj.indexed_order(spark.range(1000).withColumnRenamed("id", "row"), order, 1, 2).collect()}
    for start, rank in ((0, 0), (417, 5), (999, 3), (1000, 1)):
        found = {r.position: r.row for r in bj.rows_from(spark, order, 2, start, rank, 16).collect()}
        assert found == {p: whole[p] for p in range(start, 1000) if p % 16 == rank}


def test_numbers_that_are_no_rows(spark):
    order = bj.Bijection(10)
    df = spark.createDataFrame([(-1,), (10,), (None,)], "row bigint")
    assert [r[0] for r in df.select(order.position_of(F.col("row"), F.lit(0))).collect()] == [None] * 3
    assert bj.rows_from(spark, bj.Bijection(0), 0, 0, 0).collect() == []
