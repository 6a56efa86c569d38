"""Collocations by dynamic itemset counting.

The texts are dealt to a few shards that are scanned in turn, round and round.
Words are counted from the first scan on. A longer phrase is counted from the scan
after the one in which both of its subphrases (all words but the last, all but the
first) had come to the threshold, through one full cycle of shards, so lengths are
counted side by side and a phrase sees every shard exactly once. Scans end when no
phrase is left whose cycle is not complete.

What a task has to know is when a phrase came to the threshold. A table of a fixed
number of cells holds the scan from which on it may be built upon; a phrase has a
few cells by its hash, and the latest of them counts. Cells of different phrases
may meet: then a phrase is begun earlier, or needlessly, than by its own counts,
and its whole cycle is counted all the same, as its first scan follows from the table alone,
whose entries never change once set. Counts are of phrases, not of cells, so they
are exact; the table only saves work.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import slices, table
from corpusflow.session import stored, work_dir

LEAST = 30
LONGEST = 4
SHARDS = 4
CELLS = 1 << 24
CELLS_PER_PHRASE = 2
BITMAP = 1 << 15
NEVER = 255
BLOCK_BYTES = 8 << 20
KEPT = 2000
SCALE = 2_000_000
PARTS = 64

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_KIND = bytes(2 if c in b".,;:!?\n\x0b\x0c\r" else 1 if c in b" \t" else 0 for c in range(256))
_BETWEEN = b" \t.,;:!?\n\x0b\x0c\r"
_END = b"\xff"  # stands in no UTF-8 text


def _mixed(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hashes of all but its last word and of the last."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + w
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _word_hashes(words: pa.Array, lang: str, most: int = 1 << 20) -> np.ndarray:
    """Hashes of binary words in a language, as polynomials of their bytes, about ``most`` bytes at a time."""
    from xxhash import xxh64_intdigest

    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    sizes = np.diff(ends)
    power = np.full(int(sizes.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    chars = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    sums = np.empty(len(words), np.uint64)
    first = 0
    while first < len(words):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + most, side="right")) - 1)
        at = ends[first : last + 1] - ends[first]
        place = np.arange(at[-1]) - np.repeat(at[:-1], sizes[first:last])
        total = np.zeros(len(place) + 1, np.uint64)
        np.cumsum((chars[ends[first] : ends[last]].astype(np.uint64) + np.uint64(1)) * power[place], out=total[1:])
        sums[first:last] = total[at[1:]] - total[at[:-1]]
        first = last
    return _mixed(np.full(len(words), xxh64_intdigest(lang.encode()), np.uint64), sums)


def _cells(h: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cells of phrases: disjoint ranges of bits of their hash."""
    return [((h >> np.uint64(32 * i)) & np.uint64(0xFFFFFFFF)) % np.uint64(cells) for i in range(CELLS_PER_PHRASE)]


def _begun(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """From which scan on phrases may be built upon."""
    first, *others = _cells(h, len(table))
    found = table[first]
    for cell in others:
        found = np.maximum(found, table[cell])
    return found


class Words:
    """The words of a block of text: their codes, a list of the different ones, and the piece each stands in."""

    def __init__(self, data: bytes):
        kind = np.frombuffer(data.translate(_KIND), np.uint8)
        inside = kind == 0
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        edges = np.concatenate([np.flatnonzero(inside[:1]), edges, np.flatnonzero(inside[-1:]) + len(inside)])
        starts, ends = edges[0::2], edges[1::2]
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data.translate(_LOWER, _BETWEEN))]
        coded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.distinct = coded.dictionary
        marked = np.zeros(len(starts) + 1, bool)  # words with a mark before them and after the word before
        marked[np.searchsorted(starts, np.flatnonzero(kind == 2))] = True
        self.piece = np.cumsum(marked[:-1], dtype=np.int32)


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[bytes]:
    """Texts one after the other, cut between pieces into blocks of about ``limit`` bytes."""
    data = b".".join(texts)
    at = 0
    while len(data) - at > limit:
        cut = max(data.rfind(mark, at, at + limit) for mark in (b".", b"\n", b","))
        if cut <= at:  # no mark: up to the next one
            found = [p for p in (data.find(mark, at + limit) for mark in (b".", b"\n", b",")) if p >= 0]
            if not found:
                break
            cut = min(found)
        yield data[at : cut + 1]
        at = cut + 1
    yield data[at:]


def count_block(data: bytes, lang: str, scan: int, shards: int, begun: np.ndarray, longest: int) -> Iterator[tuple]:
    """``size, phrases, starts, counts`` of the phrases of a block that are counted in this scan."""
    words = Words(data)
    codes, distinct, piece = words.codes, words.distinct, words.piece
    many, n = len(distinct), len(codes)
    if not n:
        return
    if scan < shards:
        yield 0, pa.array([b""], pa.binary()), np.zeros(1, np.int32), np.array([n])
        yield 1, distinct, np.zeros(many, np.int32), np.bincount(codes, minlength=many)
    hashes = _word_hashes(distinct, lang)
    phrase = hashes[codes]  # hash of the phrase of the present length that starts at each place
    usable = _begun(hashes, begun)[codes]
    for size in range(2, longest + 1):
        if n < size:
            return
        start = np.maximum(usable[:-1], usable[1:])
        start[piece[: n - size + 1] != piece[size - 1 :]] = NEVER
        due = np.flatnonzero((start <= scan) & (start.astype(np.int16) + shards > scan))
        if len(due):
            key, pair = codes[due] * many + codes[due + 1], None
            if size > 2:
                last = codes[due + size - 2] * many + codes[due + size - 1]
                pair, place = np.unique(np.concatenate([key, last]), return_inverse=True)
                key = place[: len(due)] * len(pair) + place[len(due) :]
            _, first, counts = np.unique(key, return_index=True, return_counts=True)
            at = due[first]
            parts = [distinct.take(pa.array(codes[at + i])) for i in range(size)]
            joined = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
            yield size, joined, start[at].astype(np.int32), counts
        if size == longest:
            return
        open_ = np.flatnonzero(start <= scan)
        if not len(open_):
            return
        mixed = _mixed(phrase[open_], hashes[codes[open_ + size - 1]])
        phrase = np.zeros(n - size + 1, np.uint64)  # elsewhere no longer phrase starts
        phrase[open_] = mixed
        usable = np.full(n - size + 1, NEVER, np.uint8)
        usable[open_] = np.maximum(_begun(mixed, begun), start[open_])


def _scan(shard: DataFrame, scan: int, shards: int, packed, longest: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = np.frombuffer(zlib.decompress(packed.value), np.uint8)
        for part in slices(batches, max_bytes=BLOCK_BYTES):
            coded = part.column("lang").dictionary_encode()
            for code, lang in enumerate(coded.dictionary.to_pylist()):
                own = part.column("text").filter(pc.equal(coded.indices, code))
                for data in blocks(own.to_pylist()):
                    for size, phrases, starts, counts in count_block(data, lang, scan, shards, begun, longest):
                        name = bytes([size]) + lang.encode() + _END
                        prefixes = pa.array([bytes([i]) + name for i in range(scan + 1)], pa.binary())
                        keys = pc.binary_join_element_wise(prefixes.take(pa.array(starts)), phrases, pa.scalar(b"", pa.binary()))
                        yield pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64())], ["key", "n"])

    return shard.mapInArrow(run, "key binary, n bigint")


def _named(key: bytes) -> tuple[str, int, bytes]:
    """Language, number of words and phrase of a key: a byte for the first scan, one for the size, the language, the phrase."""
    lang, phrase = key[2:].split(_END, 1)
    return lang.decode(), key[1], phrase


def _decoded(counts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                langs, sizes, phrases = zip(*map(_named, batch.column("key").to_pylist()))
                columns = [pa.array(langs), pa.array(sizes, pa.int32()), pa.array(phrases, pa.binary()), batch.column("n")]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "n"])

    found = counts.select("key", "n").mapInArrow(run, "lang string, size int, phrase binary, n bigint")
    return found.withColumn("phrase", F.col("phrase").cast("string"))


def _reached_cells(reached: DataFrame, cells: int) -> np.ndarray:
    """Cells of phrases, as bitmaps of which each is summed up by Spark: ``cells / 8`` bytes at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike: dict[tuple[str, int], list[bytes]] = {}
            for lang, size, phrase in map(_named, batch.column("key").to_pylist()):
                alike.setdefault((lang, size), []).extend(phrase.split(b" "))
            for (lang, size), words in alike.items():
                first, *others = _word_hashes(pa.array(words, pa.binary()), lang).reshape(-1, size).T
                for w in others:
                    first = _mixed(first, w)
                found = np.concatenate(_cells(first, cells)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found)], ["cell"])

    found = reached.select("key").mapInArrow(run, "cell bigint")
    bits = found.groupBy(F.expr(f"cell div {BITMAP}").alias("bucket")).agg(F.bitmap_construct_agg(F.col("cell") % BITMAP).alias("bits"))
    every = [np.empty(0, np.int64)]
    for row in bits.collect():
        set_ = np.flatnonzero(np.unpackbits(np.frombuffer(row.bits, np.uint8), bitorder="little"))
        every.append(row.bucket * BITMAP + set_)
    return np.concatenate(every)


def _kept(counts: DataFrame) -> DataFrame:
    """Like ``stored``; nearly all keys differ, so no dictionaries are tried."""
    path = work_dir(counts.sparkSession, "phrase_counts")
    counts.write.option("parquet.enable.dictionary", "false").parquet(path)
    return counts.sparkSession.read.schema(counts.schema).parquet(path)


def count_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, cells: int = CELLS
) -> DataFrame:
    """``lang, size, phrase, n``: phrases of up to ``longest`` words that occur ``least`` times or more, with their counts.

    A row of size 0 per language has the number of all its words. Null texts
    are empty, a null language is ``und``; rows count as often as they occur.
    An empty table gives no rows. ``shards`` is at most 60.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
        (F.monotonically_increasing_id() % shards).cast("int").alias("shard"),
    )
    path = work_dir(spark, "phrase_shards")
    rows.write.partitionBy("shard").parquet(path)
    dealt = spark.read.schema("lang string, text binary, shard int").parquet(path)
    begun = np.full(cells, NEVER, np.uint8)
    results, state = [], None
    started, size = F.substring("key", 1, 1), F.substring("key", 2, 1)
    scan, changed = 0, 0
    while scan < max(shards, changed + shards):
        packed = spark.sparkContext.broadcast(zlib.compress(begun.tobytes(), 1))
        shard = dealt.where(F.col("shard") == scan % shards).select("lang", "text")
        found = _scan(shard, scan, shards, packed, longest)
        if state is not None:
            found = found.union(state)
        merged = found.groupBy("key").agg(F.sum("n").alias("n"))
        if scan >= shards - 1:  # rare phrases whose cycle is complete are of no use to anyone
            merged = merged.where((started > F.lit(bytes([scan - shards + 1]))) | (F.col("n") >= least) | (size == F.lit(bytes([0]))))
        merged = _kept(merged)
        state = merged
        frequent = stored(merged.where((F.col("n") >= least) | (size == F.lit(bytes([0])))), "frequent_phrases")
        if scan >= shards - 1:
            complete = F.lit(bytes([scan - shards + 1]))
            results.append(frequent.where(started == complete))
            state = merged.where(started > complete)
        reached = frequent.where((size >= F.lit(bytes([1]))) & (size < F.lit(bytes([longest]))))
        new = _reached_cells(reached, cells)
        packed.destroy()
        new = new[begun[new] == NEVER]
        if len(new):
            begun = begun.copy()
            begun[new] = scan + 1
            changed = scan + 1
        scan += 1
    every = results[0]
    for more in results[1:]:
        every = every.union(more)
    return _decoded(every)


def _wide(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(
    counts: DataFrame, kept: int | None = KEPT, scale: int = SCALE, least_share: int = 80
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases of two words or more.

    ``counts`` as from :func:`count_phrases`. A phrase's score is that of its
    weakest cut, the first of equal ones; phrases that stand inside a longer one
    with ``least_share`` percent or more of their occurrences are left out.
    """
    parts = F.split("phrase", " ")
    phrases = stored(counts.withColumnRenamed("n", "a"), "phrases")
    candidates = phrases.where("size >= 2").withColumn("words", parts)
    cuts = candidates.select("lang", "size", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    known = phrases.where("size >= 1")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    cuts = cuts.withColumn("wide_a", _wide("a") * F.lit(scale)).withColumn("wide_lr", _wide("l") + _wide("r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("wide_a div wide_lr").alias("score"), "k", "l", "r")).alias("cut"))
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda m: F.transform(
                F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.array_join(F.slice("words", i, m), " ")
            ),
        )
    )
    longer = candidates.where("size >= 3").select("lang", "a", F.explode(spans).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(longer, ["lang", "phrase"], "left")
    left = left.where((F.col("longer").isNull()) | (_wide("longer") * 100 < _wide("a") * least_share))
    left = left.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if kept is not None:  # a part of a language's phrases gives no more than all of them
        part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part")
        among = Window.partitionBy("lang", "part").orderBy(*order)
        left = left.select("*", part).withColumn("rank", F.row_number().over(among)).where(F.col("rank") <= kept).drop("part", "rank")
    best = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    if kept is not None:
        best = best.where(F.col("rank") <= kept)
    words = phrases.where("size = 0").groupBy("lang").agg(F.sum("a").alias("n"))
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_dynamic_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(count_phrases(table(spark, sf_dir, "documents")))


ORACLE = {
    "op11_dynamic_phrases": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents),
        parts AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM parts GROUP BY lang),
        spans AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM parts, range(1, 5) lengths(k)),
        counts AS (
            SELECT lang, k AS size, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
            FROM spans GROUP BY ALL HAVING count(*) >= 30),
        cuts AS (
            SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a + r.a) AS score
            FROM (SELECT *, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2) c
            JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:c.k], ' ')
            JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')),
        weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_phrases AS (
            SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
            FROM (SELECT lang, a, w, m, unnest(range(1, size - m + 2)) AS i
                  FROM (SELECT lang, a, size, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS m
                        FROM counts WHERE size >= 3))
            GROUP BY ALL)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score::BIGINT AS score
        FROM weakest LEFT JOIN inner_phrases USING (lang, phrase) JOIN totals USING (lang)
        WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
        QUALIFY rank <= 2000"""
}
QUERIES = {"op11_dynamic_phrases": op11_dynamic_phrases}
