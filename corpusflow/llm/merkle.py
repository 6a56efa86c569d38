"""Document fingerprints: Merkle trees over leaves, paragraphs and sections.

A leaf is a clause with its closing marks and white space; a clause of over
``LONG`` bytes is cut where the hash of the last four bytes says so, and after
``LONGEST`` bytes at the latest, so texts without marks have leaves too. A
paragraph ends with a line, a section ends at a blank line or after a paragraph whose digest
is divisible by eight (so an edit moves no other boundary). A node's digest is
that of its children's digests. A fingerprint is the root (16 bytes) and then,
in three bytes each, the leaves: 22 bits of digest and two that end a paragraph
and a section. Equal roots mean equal texts; where roots differ, the branches
that differ locate the edits.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import doc_texts, parallelism, slices, table
from corpusflow.session import stored

LEAF = re.compile(rb"[^.!?,;:\n|#$%&*]*[.!?,;:\n|#$%&*]+\s*|[^.!?,;:\n|#$%&*]+")
LONG, SHORTEST, LONGEST = 64, 24, 128
CUT_BITS = 5  # a place in 32 is a cut
ROOT_BYTES = 16
ENDS_PARAGRAPH, ENDS_SECTION = 1 << 22, 1 << 23
SECTION_PARAGRAPHS = 8


def leaf_pieces(text: bytes) -> list[bytes]:
    """Clauses of a text, the long ones in pieces."""
    out, cuts = [], None
    end = 0
    for piece in LEAF.findall(text):
        start, end = end, end + len(piece)
        if len(piece) <= LONG:
            out.append(piece)
            continue
        if cuts is None:
            raw = np.frombuffer(text, np.uint8).astype(np.uint32)
            code = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
            cuts = (np.flatnonzero(code * np.uint32(2654435761) >> np.uint32(32 - CUT_BITS) == 0) + 4).tolist()
        while end - start > SHORTEST:
            at = bisect_left(cuts, start + SHORTEST)
            cut = min(cuts[at] if at < len(cuts) else end, start + LONGEST)
            if cut >= end:
                break
            out.append(text[start:cut])
            start = cut
        out.append(text[start:end])
    return out


def fingerprint(text: bytes) -> bytes:
    """Root digest and leaves of a text; an empty text has a root and no leaf."""
    from xxhash import xxh3_128_digest

    sections, paragraphs, leaves, out = [], [], [], []
    pieces = leaf_pieces(text)
    last = len(pieces) - 1
    for i, piece in enumerate(pieces):
        digest = xxh3_128_digest(piece)
        leaves.append(digest)
        code = int.from_bytes(digest[:3], "big") & 0x3FFFFF
        if i == last or b"\n" in piece:
            paragraph = xxh3_128_digest(b"".join(leaves))
            paragraphs.append(paragraph)
            leaves = []
            code |= ENDS_PARAGRAPH
            if i == last or piece.count(b"\n") > 1 or paragraph[0] % SECTION_PARAGRAPHS == 0:
                sections.append(xxh3_128_digest(b"".join(paragraphs)))
                paragraphs = []
                code |= ENDS_SECTION
        out.append(code)
    codes = np.array(out, ">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes()
    return xxh3_128_digest(b"".join(sections)) + codes


def leaves_of(print_: bytes) -> list[int]:
    """The leaves' 24-bit codes."""
    raw = np.frombuffer(print_, np.uint8)[ROOT_BYTES:].reshape(-1, 3).astype(np.int64)
    return (raw[:, 0] << 16 | raw[:, 1] << 8 | raw[:, 2]).tolist()


def likeness(a: bytes, b: bytes) -> float:
    """Share of leaves that two fingerprints have in common, 1 for equal roots."""
    if a[:ROOT_BYTES] == b[:ROOT_BYTES]:
        return 1.0
    one = Counter(c & 0x3FFFFF for c in leaves_of(a))
    other = Counter(c & 0x3FFFFF for c in leaves_of(b))
    total = one.total() + other.total()
    return min(2 * (one & other).total() / total, 1 - 1 / (total + 1)) if total else 0.0


def branches(print_: bytes) -> list[list[tuple[int, ...]]]:
    """Sections of paragraphs of leaf codes."""
    found, section, paragraph = [], [], []
    for code in leaves_of(print_):
        paragraph.append(code & 0x3FFFFF)
        if code & ENDS_PARAGRAPH:
            section.append(tuple(paragraph))
            paragraph = []
        if code & ENDS_SECTION:
            found.append(section)
            section = []
    return found


def edits(a: bytes, b: bytes) -> list[tuple[int, int]]:
    """Section and paragraph numbers of ``a`` that do not stand in ``b``: equal branches are skipped whole."""
    if a[:ROOT_BYTES] == b[:ROOT_BYTES]:
        return []
    theirs = branches(b)
    sections, paragraphs = {tuple(s) for s in theirs}, {p for s in theirs for p in s}
    return [
        (i, j) for i, s in enumerate(branches(a)) if tuple(s) not in sections for j, p in enumerate(s) if p not in paragraphs
    ]


FIELDS = [
    ("doc_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
    ("shared", pa.int32()),
]
DDL = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double, shared int"
)
ENDS = [("part", pa.int32()), ("first_text", pa.binary()), ("last_id", pa.int64()), ("last_text", pa.binary())]


def _compared(doc_id: int | None, text: bytes, own: bytes, after: bytes, theirs: bytes) -> tuple:
    """A result row: the text, its fingerprint, the next text and its fingerprint.

    The first ``shared`` bytes of leaves, which the edited fingerprint begins
    with too, are left out of it.
    """
    chars = text.decode()
    half = len(chars) // 2
    edited = (chars[: len(chars) - half] + after.decode()[:half]).encode()
    changed = fingerprint(edited)
    digest = hashlib.sha256(edited).hexdigest()
    one, other = np.frombuffer(own, np.uint8)[ROOT_BYTES:], np.frombuffer(changed, np.uint8)[ROOT_BYTES:]
    size = min(len(one), len(other))
    shared = int(np.append(np.flatnonzero(one[:size] != other[:size]), size)[0])
    stored_part = changed[:ROOT_BYTES] + changed[ROOT_BYTES + shared :]
    return doc_id, len(chars), digest, own, stored_part, likeness(own, changed), likeness(own, theirs), shared


def _rows_batch(rows: list[tuple]) -> list[pa.Array]:
    columns = list(zip(*rows)) or [()] * len(FIELDS)
    return [pa.array(c, kind) for c, (_, kind) in zip(columns, FIELDS)]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprint every text, its text edited with the next document's, and the next document's.

    "Next" goes by doc_id (then by text; rows without id come first); the last
    document is followed by the first, an only one by itself. Texts move once,
    dealt by ranges of ids. Each task pairs neighbours of its range and passes
    on its first and last text, one row per task, to pair them across ranges.
    A null text is empty; an empty table gives no rows.
    """
    spark = docs.sparkSession
    schema = pa.schema(FIELDS + ENDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = before = None
        for part in slices(batches):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                own = before[2] if before and before[1] == text else fingerprint(text)
                if before:
                    rows.append(_compared(*before, text, own))
                else:
                    first = text
                before = doc_id, text, own
            empty = [pa.nulls(len(rows), kind) for _, kind in ENDS]
            yield pa.RecordBatch.from_arrays(_rows_batch(rows) + empty, schema=schema)
        if before:
            ends = (TaskContext.get().partitionId(), first, before[0], before[1])
            arrays = [pa.nulls(1, kind) for _, kind in FIELDS] + [pa.array([v], k) for v, (_, k) in zip(ends, ENDS)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    ordered = doc_texts(docs).repartitionByRange(parallelism(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    both = stored(ordered.mapInArrow(run, f"{DDL}, part int, first_text binary, last_id bigint, last_text binary"), "prints")
    names = [name for name, _ in FIELDS]
    ends = both.where("part IS NOT NULL")
    parts = sorted(row.part for row in ends.select("part").collect())  # one number per task
    pairs = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    heads = ends.select(F.col("part").alias("next_part"), F.col("first_text").alias("next_text"))
    seams = ends.join(pairs, "part").join(heads, "next_part").select("last_id", "last_text", "next_text")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = [
                _compared(i, text, fingerprint(text), after, fingerprint(after))
                for i, text, after in zip(*(c.to_pylist() for c in part.columns))
            ]
            yield pa.RecordBatch.from_arrays(_rows_batch(rows), schema=pa.schema(FIELDS))

    found = both.where("part IS NULL").select(*names).union(seams.mapInArrow(close, DDL))
    whole = (
        f"concat(substring(edited_fingerprint, 1, {ROOT_BYTES}), substring(fingerprint, {ROOT_BYTES + 1}, shared), "
        f"substring(edited_fingerprint, {ROOT_BYTES + 1}))"
    )
    return found.withColumn("edited_fingerprint", F.expr(whole)).drop("shared")


def op5_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compare_with_next(table(spark, sf_dir, "documents"))
    as_text = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(as_text)


QUERIES = {"op5_merkle_fingerprints": op5_merkle_fingerprints}
ORACLE: dict[str, str] = {}
