"""Packing of tokenised documents into sequences of fixed capacity: sum-of-squares best fit.

Lengths alone decide where a document goes, so the ids stay in the task that
made them: a piece is forty bytes of numbers from then on. Each packing task
keeps ``count[gap]``, the open sequences per residual gap, and puts a piece
where the sum of the squared counts becomes smallest (Csirik et al., "On the
sum-of-squares algorithm for bin packing").
"""

from __future__ import annotations

import gc
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import Recent, doc_texts, slices, table
from corpusflow.session import stored

CAPACITY = 2048
END_ID = 0
PIECES_PER_TASK = 200_000
# what a worker keeps of chunks (about 200 bytes each, two generations, and half as many words), and takes at a time
CACHED_CHUNKS = 400_000
SLICE_BYTES = 8 << 20
TOKENIZER = "word_bpe_49k.json"
# The pre-tokenisation pattern and the byte alphabet of the public tokenizer.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = f"{PIECES}, sequence_id bigint, offset bigint"


def byte_alphabet() -> dict[int, int]:
    """Bytes to the printable characters that stand for them in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}


class ChunkIds:
    """Ids of a text, from ids of its white-space separated chunks.

    The tokenizer drops white space and never joins what it separates, so a
    text's ids are those of its chunks, one after the other. Chunks repeat:
    their ids, as bytes, are kept from task to task (at most ``limit`` of them).
    A chunk of Latin letters (no combining marks, so normalised already) goes
    straight to the vocabulary's merges; any other, and a text with control characters on whose nature as white space
    libraries differ, is left to the tokenizer as a whole.
    """

    def __init__(self, path: str, limit: int = CACHED_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.find = regex.compile(PRE_TOKENS).findall
        self.odd = regex.compile("[\x1c-\x1f]").search
        self.letters = {b: chr(c) for b, c in byte_alphabet().items()}
        self.number = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.chunks = Recent(f"packing {path}", "chunks", limit)
        self.words = Recent(f"packing {path}", "words", limit // 2)
        self.whole = regex.compile("[^\x00-\u02ff]|<[|]").search

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _make_chunks(self, chunks: list[str]) -> list[bytes]:
        plain = [(c.isascii() and "<|" not in c) or not self.whole(c) for c in chunks]
        lowered = [c.lower() for c in chunks]
        # a chunk of letters is one match of the pattern
        words = [((c,) if c.isalpha() else self.find(c)) if p else () for c, p in zip(lowered, plain)]
        ids = self.words.values(set(chain.from_iterable(words)), self._make_words)
        return [
            (ids[ws[0]] if len(ws) == 1 else b"".join([ids[w] for w in ws])) if p else self._whole(c)
            for c, p, ws in zip(chunks, plain, words)
        ]

    def _make_words(self, words: list[str]) -> list[bytes]:
        spelled = (w if w.isascii() else w.encode().decode("latin-1") for w in words)
        mapped = (w if w.isascii() and w.isprintable() else w.translate(self.letters) for w in spelled)
        number = self.number
        return [b"".join([number[t.id] for t in self.merges(w)]) for w in mapped]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        odd = [self.odd(t) is not None for t in texts]
        chunks = [() if o else t.split() for t, o in zip(texts, odd)]
        ids = self.chunks.values(set().union(*chunks), self._make_chunks)
        return [
            self._whole(t) if o else b"".join(map(ids.__getitem__, cs)) for t, cs, o in zip(texts, chunks, odd)
        ]


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    cached_chunks: int = CACHED_CHUNKS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The pieces of every document: its ids and then ``end_id``, cut every ``capacity`` ids.

    A null or empty text is the end id alone. ``tokenizer`` is a file name that
    every executor can open (a public vocabulary installed with the library).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # millions of small strings and no cycles
        encode, end = ChunkIds(tokenizer, cached_chunks), np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for part in slices(batches, max_bytes=slice_bytes):
            rows: list[tuple] = []
            texts = part.column("text").cast(pa.string()).to_pylist()
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(texts)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), step)):
                    cut = ids[at : at + step]
                    rows.append((doc_id, piece, at // 4, len(cut) // 4, zlib.crc32(cut)))
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return doc_texts(docs).mapInArrow(run, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every length, placed one after the other.

    With ``count[g]`` open sequences of gap ``g``, placing ``n`` into one of gap
    ``g`` changes the sum of squares by ``2 * (count[g - n] - count[g]) + 2``;
    closed sequences (gap 0) do not count. Of equal changes the smaller gap
    wins, and an open sequence before a new one.
    """
    count = np.zeros(capacity + 1, np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    place = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    opened = 0
    for i, n in enumerate(lengths.tolist()):
        left = capacity - n
        best, gain = capacity, 2 * int(count[left]) + 1 if left else 0
        if n < capacity:
            now = count[n:capacity]
            change = np.where(now > 0, 2 * (count[:left] - now) + 2, np.iinfo(np.int64).max)
            change[0] -= now[0] > 0  # a filled sequence is closed and adds nothing
            at = int(change.argmin())
            if change[at] <= gain:
                best = at + n
        if best == capacity:
            where, opened = opened, opened + 1
        else:
            where = waiting[best].pop()
            count[best] -= 1
        place[i], offset[i] = where, capacity - best
        if best > n:
            waiting[best - n].append(where)
            count[best - n] += 1
    return place, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Place every piece in a sequence; ``pieces`` has to be stored, as it is counted first.

    Pieces are dealt by key, and by place so that no id is too many, to as many
    tasks as they fill, longest first within a task (ties: by id and piece), so a repeated task gives the same result. A
    task that holds ``n`` pieces leaves some dozens of sequences open, however
    large ``n`` is.
    """
    tasks = max(1, -(-pieces.count() // pieces_per_task))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = pa.Table.from_batches(batches, names) if (batches := list(batches)) else None
        if held is None or not held.num_rows:
            return
        place, offset = sum_of_squares(held.column("length").to_numpy(), capacity)
        first = TaskContext.get().partitionId() << 32
        full = held.append_column("sequence_id", pa.array(place + first)).append_column("offset", pa.array(offset))
        yield from full.to_batches(max_chunksize=100_000)

    names = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )
    return (
        pieces.withColumn("place", F.monotonically_increasing_id())
        .repartition(tasks, "doc_id", "piece", "place")
        .sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32")
        .select(names.names)
        .mapInArrow(run, PLACED)
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, **memory: int) -> DataFrame:
    """Tokenise, cut and pack ``docs`` (``doc_id``, ``text``); ``memory`` are the bounds of :func:`token_pieces`.

    Repeated rows are packed as often as they occur; an empty table gives no rows.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    return pack(stored(token_pieces(docs, tokenizer, capacity, **memory), "pieces"), capacity)


def op1_pack_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op1_pack_sum_of_squares": op1_pack_sum_of_squares}
ORACLE: dict[str, str] = {}
