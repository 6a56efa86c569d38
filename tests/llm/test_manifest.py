"""Proofs against a manifest built by hand in plain Python."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import manifest as mf

from .conftest import make_documents


def hexed(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    shown = [None if v is None else str(v) for v in values]
    return hexed(["-" if v is None else f"{len(v.encode())}:{v}" for v in shown])


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([hexed(levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def way_up(levels, at):
    steps = []
    for level in levels[:-1]:
        run = level[at // 3 * 3 : at // 3 * 3 + 3]
        steps.append((run, at % 3))
        at //= 3
    return steps


def brute_force(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row["source"], []).append((row, leaf_of(row, row["text"])))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        sources[name].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        trees.append(levels_of([leaf for _, leaf in sources[name]]))
    upper = levels_of([t[-1][0] for t in trees])
    root, out = upper[-1][0], []
    for i, name in enumerate(names):
        for at, (row, leaf) in enumerate(sources[name]):
            steps = way_up(trees[i], at) + way_up(upper, i)
            siblings = [d for run, k in steps for j, d in enumerate(run) if j != k]
            crc = None if row["doc_id"] is None else zlib.crc32(str(row["doc_id"]).encode())
            now = leaf
            if crc is not None and crc % 2 == 0 and row["text"] is not None:
                now = leaf_of(row, row["text"].replace("\n", ""))
            for run, k in steps:
                now = hexed([*run[:k], now, *run[k + 1 :]])
            out.append((row["doc_id"], leaf, trees[i][-1][0], root, hexed(siblings), now, now == root))
    return sorted(out, key=repr)


def proofs(docs, levels):
    manifest = mf.make_manifest(docs, levels, carry={"changed": mf.tampered_leaf(docs)})
    found = mf.check_proofs(mf.prove(manifest))
    digests = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    rows = found.select("doc_id", *digests, (F.col("folded_root") == F.col("root")).alias("verified")).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 7])
@pytest.mark.parametrize("sources", [1, 3, 40])
def test_proofs_of_odd_rows(spark, rows, levels, sources):
    """Null ids, sources and texts, repeated rows, pages of several heights, few and many sources."""
    named = make_documents(spark, rows + rows[:9] + [rows[20]] * 4)
    number = F.pmod(F.xxhash64("text", "doc_id"), F.lit(sources))
    named = named.withColumn("source", F.when(number > 0, F.concat(F.lit("é "), number.cast("string"))))
    named = mf.stored(named, "named")
    want = brute_force([r.asDict() for r in named.collect()])
    assert proofs(named.repartition(3), levels) == want
    assert {w[-1] for w in want} == {True, False}


def test_lone_rows(spark):
    one = make_documents(spark, [(5, "a\nb", "en")])
    [found] = proofs(one, 7)
    assert found == brute_force([r.asDict() for r in one.collect()])[0]
    assert found[1] == found[2] == found[3] and found[4] == hexed([])


def test_empty_table(spark, no_documents):
    assert proofs(no_documents, 7) == []


def test_a_request_for_a_few_leaves(spark, documents):
    manifest = mf.make_manifest(documents, 1)
    some = manifest.leaves.where("doc_id IN (3, 30, 38)")
    found = {r.doc_id: r for r in mf.prove(manifest, some).collect()}
    assert set(found) == {3, 30, 38}
    for row in found.values():
        assert row.digest == row.leaf
        assert mf.fold(bytes(row.leaf), mf.siblings_upwards(bytes(row.path))) == bytes(row.root)


def test_a_source_of_many_pages(spark):
    docs = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text\n"), (F.col("id") % 7).cast("string")).alias("text"),
        F.lit("en").alias("lang"), F.when(F.col("id") % 50 > 0, "big").otherwise("small").alias("source"), F.lit(6).alias("n_chars"),
    )
    want = brute_force([r.asDict() for r in docs.collect()])
    assert proofs(docs, 3) == want


def test_unknown_leaves_are_refused():
    with pytest.raises(KeyError):
        mf.descend_page({b"t" * 32: b"c" * 32}, b"t" * 32, [1])
