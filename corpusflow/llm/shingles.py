"""Near-duplicates by word shingles: texts whose sets of shingles have a Jaccard similarity of ``LEAST`` or more.

Texts whose SimHash fingerprints the shards' BK-trees link are compared with
one of them first, so that crowds of copies are one component at the cost of one
comparison a text. What is left is found by minima: candidates agree in the last
bytes of all ``ROWS`` minima of one of ``BANDS`` bands (a pair at 0.8 misses every band
three times in a million) and in most of the four-bit ends of all minima (a pair
at 0.8 fails once in a million). A text's sketch has the ends, so it says which
bands two texts share. In the bands only neighbours by size are compared, which
makes most of a crowd one component. Texts in whose bands several components are
left are open: their shingles are put in one order, the rarest among the open
texts first, and two texts at 0.8 share one so early in both that the rest can
still give 0.8; the parities of their shingles in ``BITS`` bits differ no more than
their sets may. So texts that have a template in common but are less alike than
0.8, each with words of its own, are hardly ever a pair, however many they are. All
candidates that decide about a component are verified on the sets themselves. A 64-bit SimHash alone would need 24 bits of
radius for the same certainty, where blocks of equal bits are two or three bits
wide and every shard holds a good part of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm import simhash
from corpusflow.llm.common import doc_texts, parallelism, release_caches, slices, sorted_groups
from corpusflow.llm.components import components
from corpusflow.session import stored

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 24, 4
SEED = 42
MISSED = 1e-6
BITS = 1024
_ODD = np.random.default_rng(SEED).integers(1 << 62, 1 << 63, BANDS * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; a text of fewer words is one shingle, one without words none."""
    from xxhash import xxh64_digest

    words = text.lower().split()  # bytes: lowers A-Z, splits at 20 and 09-0D
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) < shingle:
        digests = [xxh64_digest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = sizes.cumsum()
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        digests = [xxh64_digest(joined[s:e], SEED) for s, e in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    return np.unique(np.frombuffer(b"".join(digests), ">u8").astype(np.uint64))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sets of :func:`shingles`; two empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def minima(found: np.ndarray) -> np.ndarray:
    """``BANDS`` times ``ROWS`` minima of a set that is not empty."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(found), 256):
        np.minimum(least, (_ODD[:, None] * found[at : at + 256]).min(axis=1), out=least)
    return least.reshape(BANDS, ROWS)


def sketch(least: np.ndarray) -> bytes:
    """The last byte of all minima, band by band."""
    return (least.ravel() & np.uint64(255)).astype(np.uint8).tobytes()


def parity(found: np.ndarray) -> bytes:
    """For each of ``BITS`` remainders whether an odd number of a set's hashes has it: sets that differ in n hashes differ in n bits at most."""
    return np.packbits((np.bincount((found % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).tobytes()


def band_keys(ends: np.ndarray) -> np.ndarray:
    """A key for each band of sketches (rows of bytes): the number of the band and its ``ROWS`` bytes, so equal ends mean equal keys."""
    value = ends.reshape(len(ends), BANDS, ROWS).astype(np.int64)
    keys = np.broadcast_to(np.arange(BANDS), (len(ends), BANDS)).astype(np.int64)
    for i in range(ROWS):
        keys = keys << 8 | value[:, :, i]
    return keys


def differences(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """In how many minima the last four bits of the sketches ``others`` (rows of bytes) differ from those of ``one``."""
    return np.count_nonzero((others ^ one) & 15, axis=1)


def first_shared(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The first band in which each of the sketches ``others`` is as ``one``; 0 if there is none."""
    return (others == one).reshape(len(others), BANDS, ROWS).all(axis=2).argmax(axis=1)


def most_differences(least: float = LEAST, missed: float = MISSED) -> int:
    """The bound of :func:`differences` that at most ``missed`` of the pairs with similarity ``least`` exceed."""
    n, q = BANDS * ROWS, (1 - least) * 15 / 16
    beyond = 1.0
    for k in range(n + 1):
        beyond -= comb(n, k) * q**k * (1 - q) ** (n - k)
        if beyond <= missed:
            return k
    return n


def named_texts(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``node`` (hash of the words, equal for texts of the same words), ``doc_id``, SimHash ``fp``, the compressed words ``z``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches()
        import zstandard
        from xxhash import xxh3_64_intdigest

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches):
            words = [b" ".join(t.lower().split()) for t in part.column("text").to_pylist()]
            node = np.array([xxh3_64_intdigest(w) for w in words], np.uint64).view(np.int64)
            fp = np.array([simhash.simhash(w, shingle) for w in words], np.uint64).view(np.int64)
            z = pa.array([squeeze(w) for w in words], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), part.column("doc_id"), pa.array(fp), z], ["node", "doc_id", "fp", "z"]
            )

    return doc_texts(docs).where("doc_id IS NOT NULL").mapInArrow(run, "node bigint, doc_id bigint, fp bigint, z binary")


def tree_links(texts: DataFrame) -> DataFrame:
    """Pairs ``a > b`` of each node of ``texts`` (``node, fp``) and the smallest that BK-trees link it with, on whatever way."""
    reps = stored(texts.groupBy("fp").agg(F.min("node").alias("rep")), "representatives")
    found = components(simhash.links(simhash.shards(reps)))
    centre = reps.join(found, reps["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("b"))
    return texts.select(F.col("node").alias("a"), "fp").join(centre, "fp").where("a <> b").select("a", "b")


def sketched(texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``node, size, ends, odd`` of each row ``node, z`` with words: its number of shingles, its :func:`sketch` and :func:`parity`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches()
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        for part in slices(batches, "z", 1 << 20):
            node, size, ends, odd = [], [], [], []
            for n, z in zip(part.column("node").to_pylist(), part.column("z").to_pylist()):
                found = shingles(expand(z), shingle)
                if len(found):
                    node.append(n)
                    size.append(len(found))
                    ends.append(sketch(minima(found)))
                    odd.append(parity(found))
            columns = [pa.array(node, pa.int64()), pa.array(size, pa.int64()), pa.array(ends, pa.binary()), pa.array(odd, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "size", "ends", "odd"])

    return texts.select("node", "z").mapInArrow(run, "node bigint, size bigint, ends binary, odd binary")


def banded(sketches: DataFrame) -> DataFrame:
    """``key, node`` for each band of each row ``node, ends``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.frombuffer(b"".join(batch.column("ends").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            node = np.repeat(batch.column("node").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(band_keys(ends).ravel()), pa.array(node)], ["key", "node"])

    return sketches.select("node", "ends").mapInArrow(run, "key bigint, node bigint")


def _pairs(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    one, two = np.concatenate(a), np.concatenate(b)
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(one, two)), pa.array(np.minimum(one, two))], ["a", "b"])


def candidates(bands: DataFrame, least: float = LEAST, neighbours: bool = False) -> DataFrame:
    """Distinct pairs ``a > b`` of rows ``key, size, node, ends, component`` that share a key, have other components and fit in size and sketch.

    With ``neighbours`` only those that follow one another in a key's order by
    size; else a pair is looked at in the first band that it shares.
    """

    most = most_differences(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches()
        for group in sorted_groups(batches, "key", 1 << 14):
            key, size, node, component = (group.column(c).to_numpy() for c in ("key", "size", "node", "component"))
            ends = np.frombuffer(b"".join(group.column("ends").to_pylist()), np.uint8).reshape(len(key), -1)
            band = key >> 8 * ROWS
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            end = np.repeat(cuts[1:], np.diff(cuts))
            a, b, held = [], [], 0
            for i in np.flatnonzero(end - np.arange(len(key)) > 1).tolist():
                last = i + 2 if neighbours else i + 1 + int(np.searchsorted(size[i + 1 : end[i]], size[i] / least, side="right"))
                for start in range(i + 1, last, 1 << 14):
                    other = np.arange(start, min(last, start + (1 << 14)))
                    other = other[(component[other] != component[i]) & (size[other] * least <= size[i] + 1e-9 * size[i])]
                    other = other[differences(ends[i], ends[other]) <= most]
                    if not neighbours:
                        other = other[first_shared(ends[i], ends[other]) == band[i]]
                    if len(other):
                        a.append(np.full(len(other), node[i]))
                        b.append(node[other])
                        held += len(other)
                if held > 1 << 18:
                    yield _pairs(a, b)
                    a, b, held = [], [], 0
            if held:
                yield _pairs(a, b)

    dealt = bands.repartition(parallelism(bands.sparkSession), "key").sortWithinPartitions("key", "size", "node")
    return dealt.select("key", "size", "node", "ends", "component").mapInArrow(run, "a bigint, b bigint").distinct()


def placed(open_: DataFrame, texts: DataFrame, least: float = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """``key, place`` and the columns of ``open_`` (``node, size, ...``): the shingles by which a text may meet one ``least`` alike.

    A text's shingles are ordered by the number of open texts that have them, then by hash; ``place`` counts
    from 0. Texts ``least`` alike share ``least`` of the larger one's, so one of the first ones of both. Shingles of one text
    alone have places, but no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches()
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        for part in slices(batches, "z", 1 << 20):
            for n, z in zip(part.column("node").to_pylist(), part.column("z").to_pylist()):
                found = shingles(expand(z), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), n)), pa.array(found)], ["node", "key"])

    wanted = texts.join(open_.select("node"), "node", "left_semi").select("node", "z")
    every = stored(wanted.mapInArrow(run, "node bigint, key bigint"), "open_shingles")
    common = every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = Window.partitionBy("node")
    later = F.count(F.lit(1)).over(own) - F.row_number().over(own.orderBy("n", "key"))  # common ones behind it in the text
    ranked = every.join(common, "key").select("node", "key", later.alias("later")).join(open_, "node")
    ranked = ranked.withColumn("place", F.col("size") - 1 - F.col("later")).drop("later")
    return ranked.where(F.col("size") - F.col("place") >= F.col("size") * least - 1e-9 * F.col("size"))


def meeting(rows: DataFrame, least: float = LEAST) -> DataFrame:
    """Distinct pairs ``a > b`` of rows ``key, place, size, node, ends, odd, component`` of :func:`placed` that may be ``least`` alike.

    They have other components, fit in sketch and parity, and what each has from
    the common key on is enough for ``least``, as it is at the first key that two
    texts ``least`` alike share.
    """
    most, share = most_differences(least), least / (1 + least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches()
        for group in sorted_groups(batches, "key", 1 << 14):
            key, place, size, node, component = (group.column(c).to_numpy() for c in ("key", "place", "size", "node", "component"))
            ends = np.frombuffer(b"".join(group.column("ends").to_pylist()), np.uint8).reshape(len(key), -1)
            odd = np.frombuffer(b"".join(group.column("odd").to_pylist()), np.uint64).reshape(len(key), -1)
            left = (size - place) * (1 + 1e-9)  # shingles from the common one on
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            a, b, held = [], [], 0
            for first, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                own = component[first:end]
                names, counts = np.unique(own, return_counts=True)
                if len(names) == 1:
                    continue
                largest = names[counts.argmax()]
                every = np.arange(first, end)
                others = every[own != largest]  # all that the rows of the largest component have to look at
                last = first + np.searchsorted(size[first:end], left[first:end] / share - size[first:end], side="right")
                for i in np.flatnonzero(last - every > 1).tolist():
                    among = others if own[i] == largest else every
                    start, stop = np.searchsorted(among, [first + i + 1, last[i]])
                    for at in range(start, stop, 1 << 14):
                        other = among[at : min(stop, at + (1 << 14))]
                        need = share * (size[other] + size[first + i])
                        other = other[(component[other] != own[i]) & (np.minimum(left[other], left[first + i]) >= need)]
                        differ = np.bitwise_count(odd[other] ^ odd[first + i]).sum(axis=1, dtype=np.int64)
                        other = other[differ <= (size[other] + size[first + i]) * (1 - 2 * share + 1e-9)]
                        other = other[differences(ends[first + i], ends[other]) <= most]
                        if len(other):
                            a.append(np.full(len(other), node[first + i]))
                            b.append(node[other])
                            held += len(other)
                    if held > 1 << 18:
                        yield _pairs(a, b)
                        a, b, held = [], [], 0
            if held:
                yield _pairs(a, b)

    dealt = rows.repartition(parallelism(rows.sparkSession), "key").sortWithinPartitions("key", "size", "node")
    dealt = dealt.select("key", "place", "size", "node", "ends", "odd", "component")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def verified(pairs: DataFrame, texts: DataFrame, least: float = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """Pairs ``a, b`` whose texts' sets of shingles are ``least`` or more alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches()
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        for part in slices(slices(batches, "za", 1 << 20), "zb", 1 << 20):
            a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
            z = dict(zip(a, part.column("za").to_pylist())) | dict(zip(b, part.column("zb").to_pylist()))
            sets = {node: shingles(expand(text), shingle) for node, text in z.items()}
            kept = [jaccard(sets[x], sets[y]) >= least for x, y in zip(a, b)]
            yield part.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    one = texts.select(F.col("node").alias("a"), F.col("z").alias("za"))
    two = texts.select(F.col("node").alias("b"), F.col("z").alias("zb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "za", "zb").mapInArrow(run, "a bigint, b bigint")


def first_documents(docs: DataFrame, least: float = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` of the smallest id of each component of texts that are ``least`` or more alike.

    Texts of the same words are one. What SimHash trees link is verified first,
    then neighbours in the bands, so that a crowd of copies is one component
    before what is left meets by rare shingles. Rows without doc_id are left out.
    """
    words = named_texts(docs, shingle).groupBy("node")
    texts = stored(words.agg(F.min("doc_id").alias("rep"), F.min("fp").alias("fp"), F.min("z").alias("z")), "distinct_words")
    sketches = stored(sketched(texts, shingle), "sketches")
    bands = stored(banded(sketches), "bands")

    def known(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        """All texts with their components, and the rows of keys in which components meet."""
        labelled = sketches.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        met = bands.join(labelled.select("node", "component"), "node")
        several = met.groupBy("key").agg(F.min("component").alias("one"), F.max("component").alias("other")).where("one <> other")
        return labelled, stored(bands.join(several.select("key"), "key", "left_semi"), "crowded_bands")

    stars = stored(verified(tree_links(texts), texts, least, shingle), "stars")
    labelled, rows = known(stars.select(F.col("a").alias("node"), F.col("b").alias("component")))
    beside = candidates(rows.join(labelled, "node"), least, True)  # only these take their sketches along
    crowds = stored(stars.union(verified(beside, texts, least, shingle)), "links")
    labelled, rows = known(components(crowds))
    open_ = stored(labelled.join(rows.select("node").distinct(), "node", "left_semi"), "open_texts")
    links = crowds.union(verified(meeting(placed(open_, texts, least, shingle), least), texts, least, shingle))
    found = components(links)
    named = texts.select("node", "rep").join(found, "node", "left").select(F.coalesce("component", "node").alias("component"), "rep")
    return named.groupBy("component").agg(F.min("rep").alias("doc_id")).select("doc_id").distinct()
