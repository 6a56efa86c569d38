import math
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from corpusflow.llm import embeddings
from corpusflow.llm.hnsw import Graph


def brute(rows, threshold):
    """Links and smallest reachable id of usable vectors."""
    usable = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    label, count = {i: i for i, _ in rows}, {i: 0 for i, _ in rows}
    edges = []
    for a, (i, u) in enumerate(usable):
        for j, v in usable[a + 1 :]:
            if len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= threshold:
                edges.append((i, j))
                count[i] += 1
                count[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in edges:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return {i: (count[i], label[i], label[i] == i) for i in label}


def test_links_and_components(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(300):
        rows.append((k, rng.normal(size=16).astype(np.float32).tolist()))
    centre = rng.normal(size=16)
    rows += [(1000 + k, (centre + rng.normal(size=16) * 0.25).astype(np.float32).tolist()) for k in range(120)]
    rows += [(2000 + k, rows[5][1]) for k in range(40)]  # copies
    rows += [(3000, [2 * x for x in rows[6][1]]), (3001, [1.0, 0.0]), (3002, [1.0, 0.1]), (3003, [0.0] * 16), (3004, None), (3005, [])]
    rows += [(3006, [float("nan")] + [1.0] * 15), (3007, [None] + [1.0] * 15), (3008, [float("inf")] + [1.0] * 15), (3009, [1e-30] * 16), (3010, [1e30] * 16)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id bigint, embedding array<float>, label int, node string")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df.repartition(4), shards=3).collect()}
    assert found == brute(rows, embeddings.THRESHOLD)


def test_no_vectors_and_rows_without_id(spark):
    ddl = "vec_id bigint, embedding array<float>"
    assert embeddings.near_duplicates(spark.createDataFrame([], ddl)).count() == 0
    found = embeddings.near_duplicates(spark.createDataFrame([(None, [1.0, 2.0]), (4, [1.0, 2.0]), (4, [1.0, 2.0])], ddl)).collect()
    assert len(found) == 3 and {r.component_id for r in found if r.vec_id == 4} == {4}


def test_recall_of_the_graph():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, 4000)] + 0.3 * rng.normal(size=(4000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph.load(Graph.build(x).dump())
    q = x[::50].astype(np.float32)
    ids, _ = graph.nearest(q, 32)
    truth = np.argsort(-(q @ graph.vectors.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids.tolist(), truth.tolist())]) >= 0.95


def test_graphs_travel_in_small_pieces(spark):
    rng = np.random.default_rng(4)
    rows = [(k, 1, rng.normal(size=24).tolist()) for k in range(1200)] + [(k, 1, rng.normal(size=3).tolist()) for k in range(1200, 1300)]
    each = spark.createDataFrame(rows, "node bigint, copies bigint, v array<double>").repartition(3)
    graphs = embeddings.build_shards(each, 2)
    found = graphs.groupBy("key").agg(F.count("*").alias("pieces"), F.max(F.length("graph")).alias("largest")).collect()
    assert len(found) == 4 and max(r.pieces for r in found) > 2
    assert max(r.largest for r in found) <= embeddings.PIECE_BYTES
    links = embeddings.query_shards(each, graphs, 2, 0.7, 3).where("kind = 0").groupBy("a").agg(F.sum("n").alias("n")).collect()
    truth = {}
    for size in (24, 3):
        own = [(i, v) for i, _, v in rows if len(v) == size]
        x = embeddings._unit([v for _, v in own])
        truth |= {i: int(n) - 1 for (i, _), n in zip(own, (x @ x.T >= 0.7).sum(axis=1)) if n > 1}
    assert {r.a: r.n for r in links} == truth


def test_memory_of_a_crowd_is_bounded():
    rng = np.random.default_rng(6)
    x = embeddings._unit(rng.normal(size=64) + 0.02 * rng.normal(size=(1500, 64)))
    ids, copies = np.arange(1500), np.ones(1500, np.int64)
    work = embeddings._Work(embeddings.Shard.build(ids, copies, x), 0.9)
    tracemalloc.start()
    asked = [b.to_pydict() for b in [*(work.ask(ids[:512], copies[:512], x[:512]) or []), *work.out()]]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {a: n for b in asked for k, a, n in zip(b["kind"], b["a"], b["n"]) if k == 0} == {i: 1499 for i in range(512)}
    assert {a: n for b in asked for k, a, n in zip(b["kind"], b["a"], b["n"]) if k == 1} == {i: 512 - (i < 512) for i in range(1500)}
    assert peak < 300 << 20
