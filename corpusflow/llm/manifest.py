"""Content-addressed manifest of a dataset: digest-to-children records and proofs by descent.

Every row is a leaf; per source, runs of three consecutive nodes become one until
one is left; the sources' roots, in order, become the root the same way. What is
stored are records ``digest -> children``, in pages: a page is the part of a tree
below a node that lies ``levels`` levels above the page's leaves, and is looked up
by that node's digest. Requests for leaves descend from the root by the digits of
their rank in base three. Requests whose leading digits agree descend as one row, so
the rows above the lowest pages are a small fraction of the leaves, and a path is
carried once per page. The siblings passed on the way are collected root first;
reversed, they are the proof.

No task sees more than a page at once, whatever share of the rows a source has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import parallelism, remainder_of, table
from corpusflow.llm.ranks import ranked
from corpusflow.session import stored

FANOUT = 3
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32
TOP = -1
ROWS_OUT = 4096


def hashed(fields: list[Column]) -> Column:
    """SHA-256 of the fields: ``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    texts = [f.cast("string") for f in fields]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def parent(children: list[bytes]) -> bytes:
    return sha256("".join(c.hex() for c in children).encode()).digest()


@dataclass
class Trees:
    """Pages of trees, lowest first: per round the pages' leaves and the records above them."""

    nodes: list[DataFrame]
    records: list[DataFrame]
    roots: DataFrame
    levels: int


def build(leaves: DataFrame, levels: int = LEVELS) -> Trees:
    """Trees over ``leaves`` (``tree, rank, width, digest``; ``width``: the tree's number of leaves).

    ``roots`` has ``tree``, ``digest`` and ``round``, the round in which the
    tree's topmost page was built.
    """
    spark, page_size = leaves.sparkSession, FANOUT**levels
    widest = leaves.agg(F.max("width")).head()[0] or 0
    nodes, records, roots, n = [], [], [], 0
    while widest:
        paged = leaves.select("tree", F.expr(f"rank div {page_size}").alias("page"), "rank", "width", "digest")
        dealt = paged.repartition(parallelism(spark), "tree", "page").sortWithinPartitions("tree", "page", "rank")
        built = stored(dealt.mapInArrow(_build_pages(levels), _RECORDS), "manifest_records")
        tops = built.where("is_top")
        nodes.append(leaves.select("tree", "rank"))
        records.append(built.select("top", "digest", "children"))
        roots.append(tops.where("single").select("tree", F.col("top").alias("digest"), F.lit(n).alias("round")))
        higher = F.expr(f"(width + {page_size - 1}) div {page_size}")
        leaves = tops.where("NOT single").select("tree", F.col("page").alias("rank"), higher.alias("width"), F.col("top").alias("digest"))
        widest = -(-widest // page_size) if widest > page_size else 0
        n += 1
    if not roots:
        empty = spark.createDataFrame([], "tree bigint, digest binary, round int")
        return Trees([], [], empty, levels)
    every = roots[0]
    for more in roots[1:]:
        every = every.union(more)
    return Trees(nodes, records, every, levels)


_RECORDS = "tree bigint, page bigint, width bigint, top binary, digest binary, children binary, is_top boolean, single boolean"
_RECORD_NAMES = [c.split()[0] for c in _RECORDS.split(", ")]
_RECORD_TYPES = [pa.int64()] * 3 + [pa.binary()] * 3 + [pa.bool_()] * 2


def _build_pages(levels: int):
    def page_records(tree: int, page: int, width: int, level: list[bytes]) -> list[tuple]:
        single = width <= FANOUT**levels
        found = []
        for _ in range(levels):
            if single and len(level) == 1:
                break
            runs = [level[i : i + FANOUT] for i in range(0, len(level), FANOUT)]
            level = [parent(run) for run in runs]
            found += [(d, b"".join(run)) for d, run in zip(level, runs)]
        top = level[0]
        if not found:  # the tree is a lone leaf
            found = [(top, b"")]
        last = len(found) - 1
        return [(tree, page, width, top, d, c, i == last, single) for i, (d, c) in enumerate(found)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, level = [], None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("tree", "page", "width", "digest")]
            for tree, page, width, digest in zip(*columns):
                if key and key[:2] != (tree, page):
                    out += page_records(*key, level)
                    level = []
                key = (tree, page, width)
                level.append(digest)
                if len(out) >= ROWS_OUT:
                    yield _batch(out, _RECORD_TYPES, _RECORD_NAMES)
                    out = []
        if key:
            out += page_records(*key, level)
        if out:
            yield _batch(out, _RECORD_TYPES, _RECORD_NAMES)

    return run


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def descend_page(records: dict[bytes, bytes], top: bytes, digits: list[int]) -> tuple[bytes, bytes]:
    """The node reached from ``top`` by ``digits``, and the path's segment: per step digit, number of siblings, siblings."""
    path = []
    for digit in digits:
        children = records[top]
        at = digit * DIGEST
        siblings = children[:at] + children[at + DIGEST :]
        path.append(bytes((digit, len(siblings) // DIGEST)) + siblings)
        top = children[at : at + DIGEST]
        if len(top) != DIGEST:
            raise KeyError("no such leaf")
    return top, b"".join(path)


def base_digits(rank: int, count: int) -> list[int]:
    """The last ``count`` digits of a rank, first digit first."""
    digits = []
    for _ in range(count):
        rank, digit = divmod(rank, FANOUT)
        digits.append(digit)
    return digits[::-1]


def siblings_upwards(path: bytes) -> list[tuple[int, list[bytes]]]:
    """Digit and siblings of every step of a path, leaf first."""
    steps, at = [], 0
    while at < len(path):
        digit, count = path[at], path[at + 1]
        at += 2
        steps.append((digit, [path[at + DIGEST * i : at + DIGEST * (i + 1)] for i in range(count)]))
        at += DIGEST * count
    return steps[::-1]


def fold(leaf: bytes, steps: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and the siblings on its way make."""
    for digit, siblings in steps:
        leaf = parent([*siblings[:digit], leaf, *siblings[digit:]])
    return leaf


def descend(trees: Trees, start: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (``tree, rank`` and more) with ``digest``, the leaf reached, and ``path`` from the root down.

    ``start`` has the trees to descend: ``tree, digest`` of their roots and the
    ``path`` so far. Each round looks the pages' records up by digest, then
    brings them, the path and the requests of a page together.
    """
    begun = start.join(trees.roots.select("tree", "round"), "tree")
    found = None
    for n in reversed(range(len(trees.records))):
        pages = begun.where(F.col("round") == n).select("tree", F.lit(0).cast("bigint").alias("page"), "digest", "path")
        if found is not None:
            pages = pages.union(found.select("tree", F.col("rank").alias("page"), "digest", "path"))
        asked = requests if n == 0 else trees.nodes[n]
        found = _descend_round(trees, pages, trees.records[n], asked)
        if n:
            found = stored(found, "manifest_paths")
    return found if found is not None else requests.select("*", F.lit(b"").alias("digest"), F.lit(b"").alias("path"))


def _descend_round(trees: Trees, pages: DataFrame, records: DataFrame, asked: DataFrame) -> DataFrame:
    spark, levels = pages.sparkSession, trees.levels
    extra = [c for c in asked.columns if c not in ("tree", "rank")]
    nothing = [F.lit(None).cast(t).alias(n) for n, t in asked.select(extra).dtypes]
    none = F.lit(None).cast("binary")
    number = F.lit(None).cast("bigint")
    unique = records.repartition(parallelism(spark), "top").dropDuplicates(["top", "digest"])
    looked_up = unique.withColumnRenamed("digest", "node").join(pages.select("tree", "page", F.col("digest").alias("top")), "top")
    rows = (
        pages.select("tree", "page", F.lit(0).alias("kind"), number.alias("rank"), "digest", none.alias("children"), "path", *nothing)
        .union(looked_up.select("tree", "page", F.lit(1), number, "node", "children", none, *nothing))
        .union(asked.select("tree", F.expr(f"rank div {FANOUT**levels}"), F.lit(2), "rank", none, none, none, *extra))
    )
    dealt = rows.repartition(parallelism(spark), "tree", "page").sortWithinPartitions("tree", "page", "kind")
    found = [f for f in asked.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found) + ", digest binary, path binary"
    names = [f.name for f in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = path = b""
        children: dict[bytes, bytes] = {}
        depth = 0
        for batch in batches:
            kinds = batch.column("kind").to_pylist()
            columns = [batch.column(c).to_pylist() for c in ("rank", "digest", "children", "path")]
            at, reached, paths = [], [], []
            for i, (kind, rank, digest, below, way) in enumerate(zip(kinds, *columns)):
                if kind == 0:
                    top, path, children, depth = digest, way, {}, -1
                elif kind == 1:
                    children[digest] = below
                else:
                    if depth < 0:
                        depth = _depth(children, top)
                    node, segment = descend_page(children, top, base_digits(rank, depth))
                    at.append(i)
                    reached.append(node)
                    paths.append(path + segment)
            if at:
                kept = batch.take(pa.array(at, pa.int64()))
                made = [pa.array(reached, pa.binary()), pa.array(paths, pa.binary())]
                yield pa.RecordBatch.from_arrays([kept.column(c) for c in names] + made, [*names, "digest", "path"])

    return dealt.mapInArrow(run, schema)


def _depth(children: dict[bytes, bytes], top: bytes) -> int:
    """Levels of a page: all its leaves are equally far from its top."""
    depth = 0
    while children.get(top):
        top = children[top][:DIGEST]
        depth += 1
    return depth


@dataclass
class Manifest:
    """Leaves with their places, the trees of the sources, and the tree over their roots."""

    leaves: DataFrame
    sources: Trees
    top: Trees


def make_manifest(docs: DataFrame, levels: int = LEVELS, leaf: Column | None = None, carry: dict[str, Column] | None = None) -> Manifest:
    """Manifest of all rows of ``docs``.

    Leaves of a source ascend by doc_id (null first), then by digest; rows that
    are equal in both are the same leaf several times. ``carry`` names columns
    to keep with the leaves. Null fields have a digest of their own; an empty
    table gives a manifest without records.
    """
    leaf = hashed([F.col(f) for f in FIELDS]) if leaf is None else leaf
    carry = carry or {}
    rows = docs.select(
        F.col("source").isNotNull().alias("known"),
        F.coalesce("source", F.lit("")).alias("name"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf.alias("leaf"),
        *[c.alias(n) for n, c in carry.items()],
    )
    rows = stored(rows.withColumn("copy", F.monotonically_increasing_id()), "manifest_leaves")
    counts = stored(rows.groupBy("known", "name").agg(F.count(F.lit(1)).alias("width")), "manifest_sources")
    numbered = ranked(counts, [], ["known", "name"], "manifest_order").withColumnRenamed("rank", "tree")
    placed = ranked(rows.join(numbered, ["known", "name"]).drop("known", "name"), ["tree"], ["doc_id", "leaf", "copy"], "manifest_ranks")
    leaves = placed.drop("copy")
    sources = build(leaves.select("tree", "rank", "width", F.col("leaf").alias("digest")), levels)
    total = F.lit(numbered.count())
    top = sources.roots.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("rank"), total.alias("width"), "digest")
    return Manifest(leaves, sources, build(top, levels))


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """``requests`` (rows of ``manifest.leaves``; all of them by default) with ``subroot``, ``root`` and ``path``.

    ``path`` holds digits and siblings from the root down, through the source's
    root; :func:`siblings_upwards` reads it leaf first.
    """
    requests = manifest.leaves if requests is None else requests
    root = manifest.top.roots.select("digest").head()
    start = manifest.top.roots.select("tree", "digest", F.lit(b"").alias("path"))
    every_source = manifest.sources.roots.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("rank"))
    reached = descend(manifest.top, start, every_source)
    begin = stored(reached.select(F.col("rank").alias("tree"), "digest", "path"), "manifest_subroots")
    subroots = begin.select("tree", F.col("digest").alias("subroot"))
    asked = requests.join(subroots, "tree").withColumn("root", F.lit(bytes(root.digest) if root else None).cast("binary"))
    return descend(manifest.sources, begin, asked)


def check_proofs(proofs: DataFrame, changed: str = "changed") -> DataFrame:
    """The proofs with ``proof_sha256`` (digest of the siblings, leaf first) and ``folded_root``.

    The root is made from the column ``changed``, the digest of a row as it is
    now, or from ``leaf`` where that is null.
    """
    names = [f.name for f in proofs.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in proofs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, roots = [], []
            columns = [batch.column(c).to_pylist() for c in ("path", "leaf", changed)]
            for path, leaf, other in zip(*columns):
                steps = siblings_upwards(path)
                digests.append(parent([s for _, siblings in steps for s in siblings]))
                roots.append(fold(leaf if other is None else other, steps))
            made = [pa.array(digests, pa.binary()), pa.array(roots, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + made, [*names, "proof_sha256", "folded_root"])

    return proofs.mapInArrow(run, schema + ", proof_sha256 binary, folded_root binary")


def tampered_leaf(docs: DataFrame) -> Column:
    """Digest of a row whose text lost its newlines, where 2 divides the crc32 of the id; null where nothing changes."""
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    other = hashed([text if f == "text" else F.col(f) for f in FIELDS])
    return F.when((remainder_of("doc_id", 2) == 0) & F.col("text").contains("\n"), other)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    proofs = check_proofs(prove(make_manifest(docs, carry={"changed": tampered_leaf(docs)})))
    digests = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    return proofs.select("doc_id", *digests, (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_nodes(name: str, first: str, tree: str) -> str:
    """Recursive CTE of all levels of trees: ``tree, level, rank, digest, width``."""
    return f"""
        {name} AS (
            {first}
            UNION ALL
            SELECT tree, any_value(level) + 1, rank // 3,
                   sha256(string_agg(digest, '' ORDER BY rank)), (any_value(width) + 2) // 3
            FROM {name} WHERE width > 1 GROUP BY tree, rank // 3)"""


_CRC_SQL = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
                lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                    lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))"""


def _sql_fields(text: str) -> str:
    shown = {f: f"CAST({f} AS VARCHAR)" for f in FIELDS} | {"text": text}
    return " || ".join(f"coalesce(strlen({s}) || ':' || {s}, '-')" for s in shown.values())


ORACLE = {
    "op12_merkle_manifest": f"""
        WITH RECURSIVE hashed_rows AS (
            SELECT doc_id, source, sha256({_sql_fields("text")}) AS leaf,
                   CASE WHEN xor({_CRC_SQL}, 4294967295) % 2 = 0
                        THEN sha256({_sql_fields("replace(text, chr(10), '')")}) END AS changed
            FROM documents),
        leaves AS (
            SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
                   count(*) OVER (PARTITION BY source) AS width
            FROM hashed_rows),
        {_sql_nodes("nodes", "SELECT tree, 0 AS level, rank, leaf AS digest, width FROM leaves", "tree")},
        subroots AS (SELECT tree, digest AS subroot, level AS depth FROM nodes WHERE width = 1),
        {_sql_nodes("upper_nodes", "SELECT 0 AS tree, 0 AS level, tree AS rank, subroot AS digest, (SELECT count(*) FROM subroots) AS width FROM subroots", "tree")},
        top AS (SELECT digest AS root, level AS depth FROM upper_nodes WHERE width = 1),
        every AS (
            SELECT tree, level, rank, digest FROM nodes WHERE width > 1
            UNION ALL
            SELECT s.tree, s.depth + u.level, u.rank, u.digest FROM subroots s, upper_nodes u),
        steps AS (
            SELECT tree, level, rank,
                   string_agg(digest, '' ORDER BY sibling) FILTER (sibling < rank) AS before,
                   string_agg(digest, '' ORDER BY sibling) FILTER (sibling > rank) AS after
            FROM (SELECT a.tree, a.level, a.rank, b.rank AS sibling, b.digest
                  FROM every a JOIN every b ON a.tree = b.tree AND a.level = b.level AND a.rank // 3 = b.rank // 3
                  WHERE a.level < (SELECT s.depth + t.depth FROM subroots s, top t WHERE s.tree = a.tree))
            GROUP BY ALL),
        folds AS (
            SELECT l.tree, l.rank AS leaf_rank, 0 AS level, l.rank AS at, coalesce(changed, leaf) AS digest, '' AS proof, s.depth AS turn
            FROM leaves l JOIN subroots s USING (tree)
            UNION ALL
            SELECT f.tree, leaf_rank, f.level + 1, CASE WHEN f.level + 1 = turn THEN f.tree ELSE s.rank // 3 END,
                   sha256(coalesce(before, '') || digest || coalesce(after, '')),
                   proof || coalesce(before, '') || coalesce(after, ''), turn
            FROM folds f JOIN steps s
              ON s.tree = f.tree AND s.level = f.level
             AND s.rank = CASE WHEN f.level = turn THEN f.tree ELSE f.at END)
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f.digest AS folded_root, f.digest = root AS verified
        FROM leaves l JOIN subroots s USING (tree) JOIN top t ON true
        JOIN folds f ON f.tree = l.tree AND f.leaf_rank = l.rank AND f.level = s.depth + t.depth"""
}
QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}
