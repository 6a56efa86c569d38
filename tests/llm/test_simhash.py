import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusflow.llm import shingles, simhash
from corpusflow.llm.components import components


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_components(prints, radius):
    """Smallest member that each distinct fingerprint can reach."""
    label = {p: p for p in prints}
    todo = list(prints)
    while todo:
        p = todo.pop()
        for q in prints:
            if (p ^ q).bit_count() <= radius and label[q] != min(label[p], label[q]):
                label[q] = min(label[p], label[q])
                todo.append(q)
    return label


def test_fingerprints_and_components(documents, rows):
    found = simhash.near_duplicates(documents).collect()
    assert len(found) == len(rows)
    prints = {brute_print(t) for _, t, _ in rows}
    label = brute_components(prints, simhash.RADIUS)
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            key = label[brute_print(t)]
            smallest[key] = min(smallest.get(key, i), i)
    want = sorted(repr((i, brute_print(t), smallest.get(label[brute_print(t)]))) for i, t, _ in rows)
    assert sorted(repr((r.doc_id, r.fp % (1 << 64), r.component_id)) for r in found) == want


def test_links_within_three_bits_only_and_crowded_shards_split(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = {centre}
    for _ in range(300):  # a crowd around one fingerprint, chains of close ones, and strangers
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 9))))
        prints.add(rng.getrandbits(64))
    base = rng.getrandbits(64)
    prints |= {base ^ ((1 << k) - 1) for k in range(0, 64, 3)}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)]
    reps = spark.createDataFrame(signed, "fp bigint, rep bigint")
    label = brute_components(prints, 3)
    for shard_rows in (4096, 20):
        found = components(simhash.links(simhash.shards(reps, shard_rows=shard_rows))).collect()
        got = {r.node: r.component for r in found}
        least = {}
        for i, p in enumerate(prints):
            least[label[p]] = min(least.get(label[p], i), i)
        assert {i: got.get(i, i) for i in range(len(prints))} == {i: least[label[p]] for i, p in enumerate(prints)}


def test_tree_finds_what_a_scan_finds():
    rng = random.Random(5)
    prints = [rng.getrandbits(16) for _ in range(400)]
    tree = simhash.BKTree()
    for p in prints:
        tree.add(p)
    for q in prints[:50] + [rng.getrandbits(16) for _ in range(50)]:
        near = sorted(tree.prints[i] for i in tree.within(q, 3))
        assert near and sorted(set(near)) == sorted({p for p in prints if (p ^ q).bit_count() <= 3}) or not near


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(200, 260)] + [(5, 5), (1, 9), (9, 1), (None, 3)] + [(1000, 1000 + i) for i in range(1, 50)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    want = {i: 200 for i in range(200, 261)} | {1: 1, 9: 1} | {1000 + i: 1000 for i in range(50)}
    assert sorted((r.node, r.component) for r in found) == sorted(want.items())
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_no_documents(no_documents):
    assert simhash.near_duplicates(no_documents).count() == 0


def test_sketches_let_pairs_through_that_are_alike():
    """No pair at 0.8 or more goes, nearly every pair at 0.3 does; the bound is the binomial's."""
    rng = np.random.default_rng(3)
    most = shingles.most_differences()
    assert most == 38 and shingles.most_differences(1.0) == 0

    def unlike(jaccard, size=300):
        shared = round(2 * size * jaccard / (1 + jaccard))
        found = rng.integers(0, 1 << 63, 2 * size - shared).astype(np.uint64)
        a, b = found[:size], found[size - shared :]
        assert shingles.jaccard(np.sort(a), np.sort(b)) == pytest.approx(jaccard, abs=0.01)
        one, other = (np.frombuffer(shingles.sketch(shingles.minima(s)), np.uint8) for s in (a, b))
        return int(shingles.differences(one, other[None, :])[0])

    assert max(unlike(0.8) for _ in range(300)) <= most
    assert sum(unlike(0.3) <= most for _ in range(300)) <= 6
    assert unlike(1.0) == 0


def test_a_pair_is_found_in_the_first_band_that_it_shares():
    rng = np.random.default_rng(5)
    least = rng.integers(0, 4, (200, shingles.BANDS, shingles.ROWS)).astype(np.uint64)
    least[:, 20:] = least[0, 20:]
    ends = np.stack([np.frombuffer(shingles.sketch(m), np.uint8) for m in least])
    keys = shingles.band_keys(ends)
    first = shingles.first_shared(ends[0], ends)
    for i in range(200):
        assert first[i] == min(np.flatnonzero(keys[0] == keys[i]))
    assert (keys >> 8 * shingles.ROWS == np.arange(shingles.BANDS)).all() and len(set(first.tolist())) > 2


def test_crowded_pairs_leave_their_bands_once(spark):
    """Texts just below the bound share several bands; one row a pair comes out of the comparison."""
    rng = np.random.default_rng(6)
    same = rng.integers(0, 1 << 63, 230).astype(np.uint64)
    rows = []
    for node in range(12):
        m = shingles.minima(np.unique(np.concatenate([same, rng.integers(0, 1 << 63, 40).astype(np.uint64)])))
        rows.append((node, 270, bytearray(shingles.sketch(m))))
    sketches = spark.createDataFrame(rows, "node bigint, size bigint, ends binary")
    bands = shingles.banded(sketches).join(sketches, "node").withColumn("component", F.col("node"))
    assert bands.groupBy("key").count().where("count > 1").count() >= 24
    found = shingles.candidates(bands)
    assert found.count() == 66
    assert python_rows(found) == 66


def python_rows(found):
    """Rows that the Python step made when the plan ran."""
    plan = found._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    todo = [plan]
    while todo:
        node = todo.pop()
        if "MapInArrow" in node.nodeName():
            return node.metrics().apply("pythonNumRowsReceived").value()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        todo += [node.children().apply(i) for i in range(node.children().size())]
