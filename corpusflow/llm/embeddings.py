"""Near-duplicate embeddings: one navigable small-world graph per shard, every shard queried."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import parallelism, release_caches, return_memory, table
from corpusflow.llm.components import Forest, components
from corpusflow.llm.hnsw import Graph
from corpusflow.session import bound_batches, stored

THRESHOLD = 0.9
SHARDS = 4
SHARD_ROWS = 250_000
SHARD_NUMBERS = 64 * SHARD_ROWS
BEAM = 32
AUDIT_ROWS = 128
AUDIT_RECALL = 0.995
QUERY_ROWS = 1024
PIECE_BYTES = 128 << 10
ROW_GROUP_BYTES = 8 << 20
BLOCK_NUMBERS = 2 << 20
SPARE = 4  # partitions for each key, so that few keys meet in one


def representatives(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows ``vec_id, node`` of usable vectors, and ``node, copies, vector`` once for each different vector.

    ``node`` is the smallest vec_id of equal vectors.
    """
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"  # floats travel as they are
    usable = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("v")).where(
        "v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(v, x -> x <> 0)"
    )
    usable = stored(usable, "vectors")
    each = stored(usable.groupBy("v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "distinct_vectors")
    return usable.join(each, "v").select("vec_id", "node"), each.where("node IS NOT NULL")


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Lists of one length without nulls, in the type they have."""
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def _unit(rows: list | np.ndarray) -> np.ndarray:
    v = np.array(rows, np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _pieces(arrays: dict[str, np.ndarray]) -> Iterator[bytes]:
    """The arrays' names, types and shapes, then their bytes, little at a time."""
    yield json.dumps([(name, a.dtype.str, a.shape) for name, a in arrays.items()]).encode()
    for a in arrays.values():
        raw = np.ascontiguousarray(a).reshape(-1).view(np.uint8)
        for start in range(0, len(raw), PIECE_BYTES):
            yield raw[start : start + PIECE_BYTES].tobytes()


class _Arrays:
    """Puts together what ``_pieces`` has cut, in its order."""

    def __init__(self):
        self.found: dict[str, np.ndarray] | None = None
        self.open: list[np.ndarray] = []

    def add(self, piece: pa.Buffer) -> None:
        if self.found is None:
            self.found = {name: np.empty(shape, kind) for name, kind, shape in json.loads(piece.to_pybytes())}
            self.open = [a.reshape(-1).view(np.uint8) for a in self.found.values() if a.size]
            return
        raw = np.frombuffer(piece, np.uint8)
        self.open[0][: len(raw)] = raw
        self.open[0] = self.open[0][len(raw) :]
        if not len(self.open[0]):
            del self.open[0]


class Shard:
    """A graph with its nodes' ids, copies and vectors as given; exact ones are made of these for the rows in question."""

    def __init__(self, graph: Graph, ids: np.ndarray, copies: np.ndarray, given: np.ndarray):
        self.graph, self.ids, self.copies, self.given = graph, ids, copies, given
        self.beam = BEAM

    @property
    def block(self) -> int:
        """Rows whose vectors a task computes on at a time."""
        return max(1, BLOCK_NUMBERS // self.given.shape[1])

    @classmethod
    def build(cls, ids: np.ndarray, copies: np.ndarray, given: np.ndarray) -> Shard:
        order, sizes = Graph.numbered(len(ids))
        given = given[order]
        return cls(Graph.grown(cls._single(given), sizes), ids[order], copies[order], given)

    @staticmethod
    def _single(given: np.ndarray) -> np.ndarray:
        out = np.empty(given.shape, np.float32)
        step = max(1, BLOCK_NUMBERS // given.shape[1])
        for start in range(0, len(given), step):
            out[start : start + step] = _unit(given[start : start + step])
        return out

    def dump(self) -> dict[str, np.ndarray]:
        links = {name: a for name, a in self.graph.dump().items() if name != "vectors"}
        return {"ids": self.ids, "copies": self.copies, "given": self.given} | links

    @classmethod
    def load(cls, arrays: dict[str, np.ndarray]) -> Shard:
        graph = Graph.load(arrays | {"vectors": cls._single(arrays["given"])})
        return cls(graph, arrays["ids"], arrays["copies"], arrays["given"])

    def links(self, q: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Query rows and nodes of all links found: a query whose whole beam links is asked again with twice the beam.

        The links of a query come together, those of all queries in blocks.
        """
        todo, beam = np.arange(len(q)), self.beam
        near_enough = np.float32(threshold - 1e-4)
        while len(todo):
            beam, again = min(beam, len(self.ids)), []
            step = max(1, self.block // beam)
            for start in range(0, len(todo), step):
                rows = todo[start : start + step]
                ids, sims = self.graph.nearest(q[rows].astype(np.float32), beam)
                full = (sims[:, -1] >= near_enough) & (beam < len(self.ids))
                r, c = np.nonzero((sims >= near_enough) & (ids >= 0) & ~full[:, None])
                row, node = rows[r], ids[r, c]
                if len(row):
                    cosine = np.einsum("ij,ij->i", q[row], _unit(self.given[node]))
                    yield row[cosine >= threshold], node[cosine >= threshold]
                again.append(rows[full])
            todo, beam = np.concatenate(again), beam * 2

    def audit(self, q: np.ndarray, threshold: float, recall: float) -> float:
        """Compare with all nodes and widen the beam until enough links are found; the recall reached."""
        step = max(1, self.block // 2)
        truth = sum(int((q @ _unit(self.given[i : i + step]).T >= threshold).sum()) for i in range(0, len(self.ids), step))
        while True:
            reached = sum(len(row) for row, _ in self.links(q, threshold)) / truth if truth else 1.0
            if reached >= recall or self.beam >= len(self.ids):
                return reached
            self.beam *= 2


def build_shards(each: DataFrame, shards: int) -> DataFrame:
    """``key, piece, graph``: an index of the vectors of one length that fall into a shard by the hash of their id, in pieces."""
    shard = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches()
        key, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            ids, copies, given = (np.concatenate(parts) for parts in zip(*held))
            held.clear()
            for i, piece in enumerate(_pieces(Shard.build(ids, copies, given).dump())):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key], pa.int64()), pa.array([i], pa.int64()), pa.array([piece], pa.binary())], ["key", "piece", "graph"]
                )

        for batch in batches:
            keys = batch.column("key").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])).tolist()
            for a, b in zip(cuts, cuts[1:]):
                if keys[a] != key:
                    yield from flush()
                key, part = int(keys[a]), batch.slice(a, b - a)
                held.append((part.column("node").to_numpy().copy(), part.column("copies").to_numpy().copy(), _matrix(part.column("v")).copy()))
        yield from flush()
        return_memory()

    keyed = each.select((F.size("v").cast("bigint") * F.lit(1 << 32) + shard).alias("key"), "node", "copies", "v")
    return (
        keyed.repartition(min(SPARE * shards, parallelism(each.sparkSession)), "key")
        .sortWithinPartitions("key", "node")
        .mapInArrow(run, "key bigint, piece bigint, graph binary")
    )


FOUND = "kind int, a bigint, b bigint, n bigint"


def query_shards(each: DataFrame, graphs: DataFrame, shards: int, threshold: float, splits: int) -> DataFrame:
    """Every vector against every shard of its length: rows ``kind, a, b, n``.

    Kind 0: ``n`` vectors found to link with query ``a``. Kind 1: queries found
    to link with node ``a`` have ``n`` copies. Kind 2: ``a`` and ``b`` hang
    together; a forest of each task, not all its pairs.

    A shard's queries are dealt to ``splits`` tasks, each of which gets the
    shard's graph, piece by piece. Before anything else a task audits the recall
    on its first queries and widens the beam if need be.
    """
    split = F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split")
    each_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    kind = each.schema["v"].dataType.simpleString()
    indexes = graphs.select("key", split, "piece", "graph").select(
        "key", "split", F.lit(0).alias("kind"), F.col("piece").alias("node"), F.lit(None).cast("bigint").alias("copies"), F.lit(None).cast(kind).alias("v"), "graph"
    )
    asked = each.select("node", "copies", "v", each_shard).select(
        (F.size("v").cast("bigint") * F.lit(1 << 32) + F.col("shard")).alias("key"),
        F.pmod(F.xxhash64("node", F.lit("split")), F.lit(splits)).cast("int").alias("split"),
        F.lit(1).alias("kind"), "node", "copies", "v", F.lit(None).cast("binary").alias("graph"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches()
        place, arrays, work = None, None, None
        for batch in batches:
            for start in range(0, batch.num_rows, QUERY_ROWS):
                part = batch.slice(start, QUERY_ROWS)
                kinds, keys, splits_ = (part.column(c).to_numpy() for c in ("kind", "key", "split"))
                new = (kinds[1:] != kinds[:-1]) | (keys[1:] != keys[:-1]) | (splits_[1:] != splits_[:-1])
                cuts = [0, *(np.flatnonzero(new) + 1).tolist(), part.num_rows]
                for a, b in zip(cuts, cuts[1:]):
                    run_ = part.slice(a, b - a)
                    if kinds[a] == 0:
                        if place != (keys[a], splits_[a]):
                            if work:
                                yield from work.out()
                            place, arrays, work = (keys[a], splits_[a]), _Arrays(), None
                        for piece in run_.column("graph"):
                            arrays.add(piece.as_buffer())
                    elif place == (keys[a], splits_[a]):  # a shard without vectors has no graph
                        work = work or _Work(Shard.load(arrays.found), threshold)
                        q = _unit(_matrix(run_.column("v")))
                        yield from work.ask(run_.column("node").to_numpy(), run_.column("copies").to_numpy(), q)
        if work:
            yield from work.out()
        place, arrays, work = None, None, None
        return_memory()

    dealt = (
        indexes.union(asked)
        .repartition(SPARE * shards * splits, "key", "split")
        .sortWithinPartitions("key", "split", "kind", "node")
    )
    return dealt.select("key", "split", "kind", "node", "copies", "v", "graph").mapInArrow(run, FOUND)


def _found(kind: int, a: np.ndarray, b: np.ndarray | None, n: np.ndarray | None) -> pa.RecordBatch:
    size = len(a)
    columns = [
        pa.array(np.full(size, kind, np.int32)),
        pa.array(a, pa.int64()),
        pa.nulls(size, pa.int64()) if b is None else pa.array(b, pa.int64()),
        pa.nulls(size, pa.int64()) if n is None else pa.array(n, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["kind", "a", "b", "n"])


class _Work:
    """What one task finds in one shard. It keeps a number and a tree's edge for each node, and hands on the rest as it comes."""

    def __init__(self, shard: Shard, threshold: float):
        self.shard, self.threshold, self.audited = shard, threshold, False
        self.copies_of_queries = np.zeros(len(shard.ids), np.int64)
        self.forest = Forest(len(shard.ids))

    def _tie(self, row: np.ndarray, node: np.ndarray) -> None:
        """The nodes of a query hang together."""
        nodes, back = np.unique(node, return_inverse=True)
        roots = np.array([self.forest.root(i) for i in nodes.tolist()])
        pairs = np.unique(row * len(self.shard.ids) + roots[back])
        row, root = np.divmod(pairs, len(self.shard.ids))
        same = row[1:] == row[:-1]
        for i, j in zip(root[:-1][same].tolist(), root[1:][same].tolist()):
            self.forest.join(i, j)

    def ask(self, nodes: np.ndarray, copies: np.ndarray, q: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not self.audited:
            self.shard.audit(q[:AUDIT_ROWS], self.threshold, AUDIT_RECALL)
            self.audited = True
        n, one = np.zeros(len(q), np.int64), np.full(len(q), -1)
        for row, node in self.shard.links(q, self.threshold):
            other = nodes[row] != self.shard.ids[node]
            row, node = row[other], node[other]
            if len(row):
                n += np.bincount(row, weights=self.shard.copies[node], minlength=len(q)).astype(np.int64)
                np.add.at(self.copies_of_queries, node, copies[row])
                one[row] = node
                self._tie(row, node)
        hit = np.flatnonzero(n)
        yield _found(0, nodes[hit], None, n[hit])
        yield _found(2, nodes[hit], self.shard.ids[one[hit]], None)

    def out(self) -> Iterator[pa.RecordBatch]:
        hit = np.flatnonzero(self.copies_of_queries)
        yield _found(1, self.shard.ids[hit], None, self.copies_of_queries[hit])
        roots = np.array([self.forest.root(i) for i in range(len(self.shard.ids))], np.int64)
        tied = np.flatnonzero(roots != np.arange(len(roots)))
        yield _found(2, self.shard.ids[tied], self.shard.ids[roots[tied]], None)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, shards: int = SHARDS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id``, ``embedding``).

    Equal vectors are indexed once and link with each other. Vectors of
    different lengths never link; a vector that is null, zero, or holds null or
    non-finite components links with nothing. Rows with equal vec_id count as one
    node with the most links of any and the smallest component. A row without
    vec_id has no links counted for itself, and no component.

    There are ``shards`` shards, and more once they would hold over
    ``shard_rows`` vectors or ``SHARD_NUMBERS`` numbers each, which bounds the
    memory of a task; as every vector asks every shard, work then grows with
    their number.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    rows, each = representatives(vectors)
    size = each.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("v")), F.lit(0)).alias("numbers")).head()
    shards = max(shards, -(-size.rows // shard_rows), -(-size.numbers // SHARD_NUMBERS))
    graphs = stored(build_shards(each, shards), "graphs", ROW_GROUP_BYTES)
    tasks = min(parallelism(spark), 4 * spark.sparkContext.defaultParallelism)  # each carries a copy of a graph
    found = stored(query_shards(each, graphs, shards, threshold, max(1, tasks // shards)), "links")
    ahead = found.where("kind = 0").groupBy("a").agg(F.sum("n").alias("ahead"))
    back = found.where("kind = 1").groupBy("a").agg(F.sum("n").alias("back"))
    linked = components(found.where("kind = 2").select("a", "b")).withColumnRenamed("node", "a")
    copies = each.groupBy(F.col("node").alias("a")).agg(F.sum("copies").alias("copies"))
    nodes = copies.join(ahead, "a", "left").join(back, "a", "left").join(linked, "a", "left")
    zero = F.lit(0).cast("bigint")
    nodes = nodes.select(
        F.col("a").alias("node"),
        (F.col("copies") - 1 + F.greatest(F.coalesce("ahead", zero), F.coalesce("back", zero))).alias("n_links"),
        F.coalesce("component", "a").alias("component_id"),
    )
    usable = rows.join(nodes, "node", "left").select("vec_id", "n_links", "component_id")
    per_id = usable.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    every = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    return every.join(per_id.where("vec_id IS NOT NULL"), "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", zero).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def op8_hnsw_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op8_hnsw_shards": op8_hnsw_shards}
ORACLE: dict[str, str] = {}
