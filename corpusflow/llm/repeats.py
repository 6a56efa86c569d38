"""Removal of repeated passages: suffix arrays over shards of a corpus.

A byte goes if a string of ``window`` bytes that also starts earlier covers it.
Every window belongs to its anchor, the ``gram`` bytes of smallest hash in it,
so equal windows have equal anchors. A segment is a run of windows with one
anchor; an anchor's segments, all over the corpus, meet in one shard. Copies of
a segment are one from then on, and those that differ are compared byte by byte
in the shard's suffix array: windows that stand next to each other with a common
prefix of ``window`` bytes or more are equal, and all but the first are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from corpusflow.llm.common import parallelism, slices, sorted_groups, table
from corpusflow.llm.suffixes import permuted_common_prefixes, suffix_array
from corpusflow.session import stored

WINDOW = 100
GRAM = 32
SKETCH = 1 << 16
CROWDED = 4
SHARD_SEGMENTS = 8192
SLICE = 1 << 20  # bytes of text worked on at a time; arrays take some hundred times as much
SHARD_BYTES = 1 << 20
NO_ID = -(1 << 63)
RUN = 127  # windows in a segment at most: seven bits of ``span``
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0xC2B2AE3D27D4EB4F))
_BREAK = 0xFF  # no UTF-8 text holds it


def _hashes(buffer: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """Hash of the ``width`` bytes at every position, from hashes of half as many."""
    h, at, done = buffer.astype(np.uint64) + np.uint64(1), None, 0
    rest, size = width, 1
    while rest:
        if rest & 1:
            piece = h[done : len(buffer) - width + done + 1]
            power = np.uint64(pow(int(base), size, 1 << 64))
            at = piece.copy() if at is None else at * power + piece
            done += size
        rest >>= 1
        if rest:
            h = h[:-size] * np.uint64(pow(int(base), size, 1 << 64)) + h[size:]
            size *= 2
    at ^= at >> np.uint64(29)
    at *= _MIX[1]
    at ^= at >> np.uint64(32)
    return at


def _running_least(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (width - size)], h[width - size :]) if size < width else h


class Segments:
    """Segments of a slice of documents: anchor, document, first window, number of windows."""

    def __init__(self, texts: list[bytes], window: int, gram: int):
        self.window, self.wide = window, window - gram + 1
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offset = np.cumsum(lengths) - lengths
        self.raw = b"".join(texts)
        self.buffer = np.frombuffer(self.raw, np.uint8)
        if len(self.buffer) < window:
            self.anchor = np.empty(0, np.uint64)
            self.doc = self.start = self.n = np.empty(0, np.int64)
            self.grams = self.anchor
            return
        self.grams = _hashes(self.buffer, gram, _MIX[0])
        least = _running_least(self.grams, self.wide)
        doc = np.repeat(np.arange(len(texts)), lengths)[: len(least)]
        inside = np.arange(len(least)) + window <= (self.offset + lengths)[doc]
        new = np.concatenate([[True], (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])])
        start = np.flatnonzero(new)
        n = np.diff(np.append(start, len(least)))
        keep = inside[start]
        start, n = start[keep], n[keep]
        parts = -(-n // RUN)  # long runs (periodic texts) are cut
        place = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        self.start = np.repeat(start, parts) + RUN * place
        self.n = np.minimum(RUN, np.repeat(n, parts) - RUN * place)
        self.anchor, self.doc = least[self.start], doc[self.start]

    def select(self, rows: np.ndarray) -> None:
        self.anchor, self.doc, self.start, self.n = self.anchor[rows], self.doc[rows], self.start[rows], self.n[rows]

    def contents(self) -> np.ndarray:
        """Hash of the bytes of each segment, all its windows'."""
        from xxhash import xxh3_64_intdigest

        raw, last = self.raw, self.window - 1
        ends = (self.start + self.n + last).tolist()
        return np.array([xxh3_64_intdigest(raw[a:b]) for a, b in zip(self.start.tolist(), ends)], np.uint64)

    def own_repeats(self) -> np.ndarray:
        """Segments that hold their anchor more than once, so that two of their own windows may be equal."""
        out = np.zeros(len(self.start), bool)
        for at in range(0, len(out), 4096):
            part = slice(at, at + 4096)
            near = np.arange(self.wide)
            first = (self.grams[self.start[part, None] + near] == self.anchor[part, None]).argmax(axis=1)
            ends = self.start[part] + self.n[part] - 1
            last = (self.grams[(ends + self.wide - 1)[:, None] - near] == self.anchor[part, None]).argmax(axis=1)
            out[part] = self.start[part] + first != ends + self.wide - 1 - last
        return out


def source_texts(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``id`` (a null doc_id comes first), ``h`` (64-bit hash of the text), ``text``, and columns to carry along by number."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID).cast("bigint")).alias("id"),
        F.xxhash64(text).alias("h"),
        text.alias("text"),
        *[F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)],
    )


def crowded_anchors(texts: DataFrame, window: int, gram: int) -> np.ndarray:
    """Which of 65536 groups of anchors hold more than ``CROWDED`` partitions' share of all segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(SKETCH, np.int64)
        for part in slices(batches, max_bytes=SLICE):
            found = Segments(part.column("text").to_pylist(), window, gram)
            sums += np.bincount((found.anchor >> np.uint64(48)).astype(np.int64), minlength=SKETCH)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["bucket", "n"])

    found = texts.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    sums = np.zeros(SKETCH, np.int64)
    for row in found.collect():  # one row per group at most
        sums[row.bucket] = row.n
    return sums > CROWDED * max(1000, sums.sum() // parallelism(texts.sparkSession))


def _same_as_before(*columns: np.ndarray) -> np.ndarray:
    """Rows that equal the one before them in all columns."""
    same = np.ones(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        same &= c[1:] == c[:-1]
    return np.append(np.zeros(min(1, len(columns[0])), bool), same)


#: ``id, h`` is the document, ``span`` 40 bits of the first window's place and 8 of their number.
ANCHORED = "anchor bigint, content bigint, id bigint, h bigint, span bigint"


def anchored_segments(texts: DataFrame, crowded: np.ndarray, window: int, gram: int) -> DataFrame:
    """A row for each different segment of a slice of texts.

    A later copy in the same slice is a repeat for sure; it goes under an anchor
    of its own, next to the segment before it, with a null ``content``. The
    lowest bit of ``content`` marks segments that may repeat themselves, the
    next one those of a crowded anchor, which are dealt by their content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, max_bytes=SLICE):
            ids, hs = part.column("id").to_numpy(), part.column("h").to_numpy()
            found = Segments(part.column("text").to_pylist(), window, gram)
            if not len(found.start):
                continue
            repeats = found.own_repeats() & (found.n > 1)
            many = crowded[(found.anchor >> np.uint64(48)).astype(np.int64)]
            content = found.contents() & ~np.uint64(3) | repeats.astype(np.uint64) | many.astype(np.uint64) << np.uint64(1)
            found.anchor[many] ^= content[many] * _MIX[0]
            id_, h = ids[found.doc], hs[found.doc]
            span = (found.start - found.offset[found.doc]) << 8 | found.n
            order = np.lexsort((span, h, id_, content, found.anchor))
            anchor, content, id_, h, span = found.anchor[order], content[order], id_[order], h[order], span[order]
            copy = _same_as_before(anchor, content)
            fresh, known = np.flatnonzero(~copy), np.flatnonzero(copy & ~_same_as_before(anchor, content, id_, h, span))
            ranges_id, ranges_h, ranges_span = merged(id_[known], h[known], span[known])
            size = len(fresh) + len(ranges_id)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([anchor[fresh].view(np.int64), (ranges_id * 31 + ranges_h) * 31 + ranges_span])),
                    pa.array(np.append(content[fresh].view(np.int64), np.zeros(len(ranges_id), np.int64)), mask=np.arange(size) >= len(fresh)),
                    pa.array(np.concatenate([id_[fresh], ranges_id])),
                    pa.array(np.concatenate([h[fresh], ranges_h])),
                    pa.array(np.concatenate([span[fresh], ranges_span])),
                ],
                ["anchor", "content", "id", "h", "span"],
            )

    return texts.mapInArrow(run, ANCHORED)


def merged(id_: np.ndarray, h: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring runs of windows as one, of fewer than ``2 * RUN`` windows, which fit the eight bits."""
    order = np.lexsort((span, h, id_))
    id_, h, span = id_[order], h[order], span[order]
    if not len(id_):
        return id_, h, span
    start, n = span >> 8, span & 0xFF
    follows = np.concatenate([[False], (id_[1:] == id_[:-1]) & (h[1:] == h[:-1]) & (start[1:] == start[:-1] + n[:-1])])
    run = np.cumsum(~follows) - 1
    before = np.cumsum(n) - n
    block = (before - before[np.flatnonzero(~follows)][run]) // RUN
    first = np.flatnonzero(np.concatenate([[True], (run[1:] != run[:-1]) | (block[1:] != block[:-1])]))
    sums = np.add.reduceat(n, first)
    return id_[first], h[first], (start[first] << 8) | sums


DECIDED = "repeat boolean, id bigint, h bigint, span bigint, anchor bigint, crowded boolean"


def decided_segments(anchored: DataFrame) -> DataFrame:
    """Segments known to be repeats, and those to be compared in a shard.

    An anchor's rows come together. Of equal contents the first stays; if an
    anchor has different contents, or one that may repeat itself, its first ones
    are to be compared, and so are all first ones of crowded anchors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "anchor"):
            anchor, id_, h, span = (group.column(c).to_numpy() for c in ("anchor", "id", "h", "span"))
            known = group.column("content").is_null().to_numpy()
            content = group.column("content").fill_null(0).to_numpy()
            same = np.concatenate([[False], (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1]) & ~known[1:] & ~known[:-1]])
            first = ~same & ~known
            new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
            number = np.cumsum(new) - 1
            contents = np.bincount(number[first], minlength=number[-1] + 1)
            loops = np.bincount(number[first & (content & 1 == 1)], minlength=number[-1] + 1)
            crowded = first & (content & 2 == 2)
            compare = crowded | first & ((contents > 1) | (loops > 0))[number]
            again = same & _same_as_before(id_, h, span)  # of a row that stands in the table twice
            out = np.flatnonzero(compare | same & ~again | known)
            yield pa.RecordBatch.from_arrays(
                [pa.array(~compare[out]), pa.array(id_[out]), pa.array(h[out]), pa.array(span[out]), pa.array(anchor[out]), pa.array(crowded[out])],
                ["repeat", "id", "h", "span", "anchor", "crowded"],
            )

    dealt = anchored.repartition(parallelism(anchored.sparkSession), "anchor").sortWithinPartitions("anchor", "content", "id", "h", "span")
    return dealt.mapInArrow(run, DECIDED)


def packed(texts: DataFrame) -> DataFrame:
    """Texts compressed, as they are shuffled twice; other columns as they are."""
    schema = StructType([StructField("z", BinaryType())] + [f for f in texts.schema if f.name != "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches):
            z = pa.array([squeeze(t) for t in part.column("text").to_pylist()], pa.binary())
            others = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([z, *map(part.column, others)], ["z", *others])

    return texts.mapInArrow(run, schema)


CUT = "anchor bigint, content bigint, id bigint, h bigint, span bigint, bytes binary"


def cut_segments(texts: DataFrame, wanted: DataFrame, window: int, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """Segments with their ``bytes``, to be compared in a shard; those of large anchors as windows with two hashes.

    An anchor of more than ``shard_segments`` different segments would make a
    shard without bound. Its windows, each under the hash of its own bytes, go
    the way of :func:`decided_segments` once more.
    """
    large = wanted.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_segments)
    large = large.select("anchor", F.lit(True).alias("_large"))
    marked = wanted.join(large, "anchor", "left").withColumn("large", F.col("crowded") | F.col("_large").isNotNull())
    per_text = marked.groupBy("id", "h").agg(
        F.collect_list(F.struct("anchor", "span", "large")).alias("wants")
    )

    def windows(id_: int, h: int, spans: list[int], text: bytes) -> pa.RecordBatch:
        buffer = np.frombuffer(text, np.uint8)
        one, two = _hashes(buffer, window, _MIX[2]), _hashes(buffer, window, _MIX[0])
        s = np.array(spans, np.int64)
        n = s & 0xFF
        at = np.repeat(s >> 8, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(one[at].view(np.int64)),
                pa.array((two[at] & ~np.uint64(3)).view(np.int64)),
                pa.array(np.full(len(at), id_, np.int64)),
                pa.array(np.full(len(at), h, np.int64)),
                pa.array(at << 8 | 1),
                pa.nulls(len(at), pa.binary()),
            ],
            ["anchor", "content", "id", "h", "span", "bytes"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        for part in slices(batches, "z", 1 << 20):
            rows = []
            for id_, h, z, wants in zip(*(part.column(c).to_pylist() for c in ("id", "h", "z", "wants"))):
                text = expand(z)
                for want in wants:
                    start, n = want["span"] >> 8, want["span"] & 0xFF
                    if not want["large"]:
                        rows.append((want["anchor"], None, id_, h, want["span"], text[start : start + n + window - 1]))
                if spans := [want["span"] for want in wants if want["large"]]:
                    yield windows(id_, h, spans, text)
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor", "content", "id", "h", "span", "bytes"])

    return packed(texts).join(per_text, ["id", "h"]).select("id", "h", "z", "wants").mapInArrow(run, CUT)


def shard_repeats(segments: DataFrame, window: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``id, h, span`` of windows that stand earlier in another segment of their anchor, or in their own.

    A task handles whole anchors, about ``shard_bytes`` at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "anchor", min_rows=1 << 40, measure="bytes", limit=shard_bytes):
            anchor, id_, h, span = (group.column(c).to_numpy() for c in ("anchor", "id", "h", "span"))
            once = np.flatnonzero(~_same_as_before(anchor, id_, h, span))
            if len(once) < len(span):
                group, id_, h, span = group.take(pa.array(once)), id_[once], h[once], span[once]
            texts = group.column("bytes").to_pylist()
            text = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
            first = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
            sa = suffix_array(text, window)
            plcp = permuted_common_prefixes(text, sa, window)
            apart = plcp[sa] < window
            apart[0] = True
            earliest = np.minimum.reduceat(sa, np.flatnonzero(apart))[np.cumsum(apart) - 1]
            later = np.sort(sa[sa != earliest])  # equal windows stand in the order of their documents
            row = np.searchsorted(first, later, side="right") - 1
            place = later - first[row]
            inside = place < (span & 0xFF)[row]
            row, place = row[inside], place[inside]
            found = merged(id_[row], h[row], ((span[row] >> 8) + place) << 8 | 1)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["id", "h", "span"])

    dealt = segments.repartition(parallelism(segments.sparkSession), "anchor").sortWithinPartitions("anchor", "id", "h", "span")
    return dealt.mapInArrow(run, "id bigint, h bigint, span bigint")


def covered(spans: list[int], window: int) -> list[tuple[int, int]]:
    """Byte ranges that the windows of ``spans`` cover, in order and apart from each other."""
    if not spans:
        return []
    s = np.sort(np.array(spans, np.int64))
    start, end = s >> 8, (s >> 8) + (s & 0xFF) + window - 1
    end = np.maximum.accumulate(end)
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return list(zip(start[new].tolist(), end[np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)].tolist()))


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, carry: Sequence[str] = (), as_text: bool = False
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (bytes) for every row, and the columns to ``carry`` along.

    "Earlier" goes by doc_id, then by place; rows without id come first. Rows
    that share a doc_id are told apart by the 64-bit hash of their texts
    and come in its order. Rows equal in both count as one document, whose
    result each of them gets. A null or empty text gives zeros and the digest of
    nothing. With ``as_text``, ``kept`` is the string of those bytes without what
    is left of characters that a cut goes through.
    """
    texts = source_texts(docs, list(carry))
    once = texts.select("id", "h", "text")
    crowded = crowded_anchors(once, window, gram)
    decided = stored(decided_segments(anchored_segments(once, crowded, window, gram)), "decided")
    wanted = decided.where("NOT repeat").select("id", "h", "span", "anchor", "crowded").distinct()
    cut = stored(cut_segments(once, wanted, window), "cut_segments")
    compared = shard_repeats(cut.where("bytes IS NOT NULL").select("anchor", "id", "h", "span", "bytes"), window)
    equal = decided_segments(cut.where("bytes IS NULL").select("anchor", "content", "id", "h", "span")).where("repeat")
    repeats = decided.where("repeat").select("id", "h", "span").union(compared).union(equal.select("id", "h", "span"))
    per_text = repeats.groupBy("id", "h").agg(F.collect_list("span").alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        for part in slices(batches, "z", 1 << 20):
            rows = []
            for z, spans in zip(part.column("z").to_pylist(), part.column("spans").to_pylist()):
                text, at, kept = expand(z), 0, []
                ranges = covered(spans, window) if spans else []
                for a, b in ranges:
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                left = b"".join(kept)
                rows.append((len(text), len(text) - len(left), len(ranges), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if as_text else left))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string() if as_text else pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            others = [n for n in part.schema.names if n.startswith("_carry")]
            columns = [part.column("id"), *arrays, *map(part.column, others)]
            yield pa.RecordBatch.from_arrays(columns, ["id", *NAMES, *others])

    joined = packed(texts).join(per_text, ["id", "h"], "left").drop("h")
    taken = [f for f in joined.schema if f.name.startswith("_carry")]
    schema = StructType.fromDDL(f"id bigint, {RESULT.replace('binary', 'string') if as_text else RESULT}")
    found = joined.select("id", "z", "spans", *[f.name for f in taken]).mapInArrow(run, StructType(schema.fields + taken))
    back = [F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)]
    return found.select(F.expr(f"nullif(id, bigint('{NO_ID}'))").alias("doc_id"), *NAMES, *back)


RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
NAMES = [c.split()[0] for c in RESULT.split(", ")]


def op3_suffix_array_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


QUERIES = {"op3_suffix_array_repeats": op3_suffix_array_repeats}
ORACLE: dict[str, str] = {}
