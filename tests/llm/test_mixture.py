"""Targets against water-filling by hand; words taken against the targets and over reruns."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import mixture as mx

from .conftest import make_documents


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def targets_by_hand(sizes, total=Fraction(3, 2), epochs=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mx.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, open_, target = total * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if epochs * sizes[s] <= level * weight[s]}
        if not full:
            target.update((s, float(level * weight[s])) for s in open_)
            break
        target.update((s, float(epochs * sizes[s])) for s in full)
        left -= sum(epochs * sizes[s] for s in full)
        open_ -= full
    return target


def check(docs, cell_rows=None):
    given = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    sizes, total = defaultdict(int), Counter()
    for _, source, text in given:
        sizes[source] += len(words(text))
    target = targets_by_hand(sizes)
    found = mx.mix(docs, carry=("source", "text")).collect()
    assert Counter((r.doc_id, r.source, r.text) for r in found) == Counter(given)
    parts = Counter()
    for r in found:
        assert (r.size, r.source_size, r.target) == (len(words(r.text)), sizes[r.source], target[r.source])
        assert all(0 < n <= r.size for n in r.repetitions) and len(r.repetitions) <= 2
        total[r.source] += sum(r.repetitions)
        parts[r.source] += sum(n < r.size for n in r.repetitions)
    for source in sizes:
        assert abs(total[source] - target[source]) <= 0.5
    assert max(parts.values(), default=0) <= 1
    return found


@pytest.mark.parametrize("sources", [1, 2, 7])
@pytest.mark.parametrize("cell_rows", [1, 4096])
def test_odd_rows(spark, rows, sources, cell_rows, monkeypatch):
    """Null ids, texts and sources, blank and very long texts, repeated rows; cells narrowed to the end or not."""
    monkeypatch.setattr(mx, "CELL_ROWS", cell_rows)
    docs = make_documents(spark, rows + rows[:5])
    number = F.pmod(F.xxhash64("text", "doc_id"), F.lit(sources))
    docs = mx.stored(docs.withColumn("source", F.when(number > 0, F.concat(F.lit("s"), number.cast("string")))), "named")
    first = check(docs)
    again = check(docs.repartition(7))
    assert Counter((r.doc_id, r.text, tuple(r.repetitions)) for r in first) == Counter(
        (r.doc_id, r.text, tuple(r.repetitions)) for r in again
    )


def test_equal_rows_without_id_fill_a_source(spark):
    """A third of all rows are one row: some of its copies are taken, one in part."""
    docs = make_documents(spark, [(None, "one two three", "en")] * 400 + [(i, f"text {i} " * (i % 9), "en") for i in range(800)])
    docs = docs.withColumn("source", F.when(F.col("doc_id").isNull(), "a").otherwise(F.concat(F.lit("b"), (F.col("doc_id") % 4).cast("string"))))
    check(mx.stored(docs, "copies"))


def test_many_rounds_of_redistribution(spark):
    """Sizes that double: each round lifts further sources above their limit."""
    rows = [(i, "w " * (2**i), "en") for i in range(12)]
    docs = make_documents(spark, rows).withColumn("source", F.format_string("%02d", 11 - F.col("doc_id")))
    check(docs)


def test_texts_of_repetitions(spark, documents):
    mixed = mx.mix(documents, carry=("text",))
    whole = {(r.doc_id, r.text): r.size for r in mixed.collect()}
    taken = sum(sum(r.repetitions) for r in mixed.collect())
    texts = mx.repeated_texts(mixed).collect()
    assert sum(r.words for r in texts) == taken
    for r in texts:
        assert len(words(r.text)) == r.words
        assert r.words == r.size or any(t is not None and t.startswith(r.text) for i, t in whole if i == r.doc_id)


def test_another_seed_takes_other_documents(spark, documents):
    def chosen(seed):
        return sorted((r.doc_id or -1, r.repetitions) for r in mx.mix(documents, seed=seed, total=Fraction(1, 2)).collect())

    assert chosen(1) == chosen(1) != chosen(2)


def test_empty_table(spark, no_documents):
    assert mx.mix(no_documents).collect() == []
