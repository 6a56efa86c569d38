"""Sums of doubles are exact, whatever the partitioning, and equal in streams."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from corpusflow.operators import exact as ex
from corpusflow.streaming import streams as st

SCHEMA = "k string, v double"


def brute(values):
    """The exact sum by fractions, rounded once."""
    total = sum((Fraction(v) for v in values), Fraction(0))
    try:
        return total.numerator / total.denominator
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def stats(spark, rows, tasks=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(tasks)
    return {r.k: (r.n_values, r.exact_sum, r.exact_mean) for r in ex.exact_stats(df, ["k"], "v").collect()}


def test_random_magnitudes(spark):
    rng = random.Random(5)
    rows = [(f"k{i % 7}", rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.randint(-1100, 1000))) for i in range(3000)]
    rows += [(f"near{i % 3}", rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-3, 16)) for i in range(3000)]
    found = stats(spark, rows)
    for k in {k for k, _ in rows}:
        values = [v for key, v in rows if key == k]
        assert found[k][:2] == (len(values), brute(values)), k
        assert found[k][2] == found[k][1] / len(values)


def test_borders_of_limbs(spark):
    """Powers of two at the start of each limb and their neighbours, where the logarithm may round to the other side."""
    values = []
    for place in range(ex.TOP + 1):
        power = math.ldexp(1.0, ex.BITS * place + ex.LOWEST)
        values += [power, math.nextafter(power, 0), math.nextafter(power, math.inf), -3 * power]
    values += [1.7976931348623157e308, 5e-324, -5e-324, 0.0, -0.0]
    assert stats(spark, [(str(i), v) for i, v in enumerate(values)]) == {
        str(i): (1, v, v) for i, v in enumerate(values)
    }


@settings(max_examples=200, deadline=None)
@given(hs.lists(hs.floats(allow_nan=False, allow_infinity=False), max_size=20))
def test_rounding_of_limbs(values):
    """The step at the end, on limbs cut with fractions."""
    limbs = {}
    for v in values:
        units = int(Fraction(v) * 2 ** -ex.LOWEST)
        sign = -1 if units < 0 else 1
        for place in range(ex.TOP + 2):
            limbs[place] = limbs.get(place, 0) + sign * (abs(units) >> ex.BITS * place & (1 << ex.BITS) - 1)
    assert ex.rounded_sum(limbs.keys(), limbs.values()) == brute(values)


def test_cancellation_that_plain_addition_loses(spark):
    rows = [("a", 1e16), ("a", 1.0), ("a", -1e16), ("b", 1e308), ("b", 1e308), ("b", -1e308), ("c", 1e308), ("c", 1e308)]
    found = stats(spark, rows)
    assert found["a"][1] == 1.0
    assert found["b"][1] == 1e308
    assert found["c"][1] == math.inf


def test_odd_rows(spark):
    rows = [("nan", math.nan), ("nan", 1.0), ("inf", math.inf), ("inf", 2.0), ("low", -math.inf), ("both", math.inf)]
    rows += [("both", -math.inf), ("null", None), ("some", None), ("some", 0.25), (None, 1.5), (None, 2.0), ("zero", -0.0)]
    found = stats(spark, rows)
    assert math.isnan(found["nan"][1]) and found["nan"][0] == 2
    assert found["inf"] == (2, math.inf, math.inf) and found["low"][1] == -math.inf
    assert math.isnan(found["both"][1])
    assert "null" not in found and found["some"] == (1, 0.25, 0.25)
    assert found[None] == (2, 3.5, 1.75)
    assert found["zero"] == (1, 0.0, 0.0)
    assert stats(spark, []) == {}


def test_names_that_cannot_be_told_apart(spark):
    with pytest.raises(ValueError):
        ex.exact_stats(spark.createDataFrame([(1, 1.0)], "place int, v double"), ["place"], "v")


def test_any_type_of_number_and_clashing_names(spark):
    df = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.25)], "place int, part int, _kind float")
    assert [tuple(r) for r in ex.exact_stats(df.withColumnRenamed("part", "v"), ["_kind"], "v").orderBy("_kind").collect()] == [
        (0.25, 1, 3.0, 3.0), (0.5, 1, 2.0, 2.0)
    ]


@pytest.mark.parametrize("tasks", [1, 2, 13])
def test_bitwise_equal_for_any_partitioning(spark, sf_dir, tasks):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("v", F.col("value") / 3)
    whole = {tuple(r) for r in ex.exact_stats(events, ["event_type"], "v").collect()}
    order = F.xxhash64("event_id", F.lit(tasks))
    dealt = events.repartition(tasks, order).sortWithinPartitions(order)
    assert {tuple(r) for r in ex.exact_stats(dealt, ["event_type"], "v").collect()} == whole
    values = {}
    for r in events.collect():
        values.setdefault(r.event_type, []).append(r.v)
    assert {(k, len(v), brute(v), brute(v) / len(v)) for k, v in values.items()} == whole


def test_stream_of_several_batches_and_a_restart(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("v", F.col("value") / 7)
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    keys = ["event_type", "place"]
    for part in range(4):
        share = events.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == part)
        share.coalesce(1).write.mode("append").parquet(landing)
        if part % 2:  # two files for each run of the query, one micro-batch each
            arriving = st.read_landing(st.stream_session(spark, 3), landing, events.schema, files_per_trigger=1)
            st.run_updates(ex.running_limbs(arriving, ["event_type"], "v"), out, str(tmp_path / "checkpoint"), keys)
    found = ex.exact_totals(st.current_rows(spark, out, keys), ["event_type"])
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in ex.exact_stats(events, ["event_type"], "v").collect()}
