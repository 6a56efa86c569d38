"""SentencePiece encoding and decoding: suffix-array matching and a relaxed lattice.

The units of a slice of texts (words with the spaces or marks before them) are
concatenated once each and indexed by a suffix array; every piece of
the vocabulary is found in it by binary search. The occurrences are edges of a
lattice, sorted by position, and each position is relaxed to the last piece of
the prefix that ends there. A sequence of pieces is the vocabulary's own
encoding exactly if every two neighbours encode to themselves, so the last
piece is the one that the last piece before it tolerates.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from corpusflow.llm.common import Recent, doc_texts, slices, table

VOCABULARY = "piece_bpe_32k.model"
CACHED_UNITS = 300_000
CACHED_PAIRS = 500_000
SPACE = "▁"
LATIN = "0-9A-Za-zÀ-ÖØ-öø-ɏ"


class Vocabulary:
    """Pieces, their merge scores and the ids of bytes, read from a public model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        self.path = path
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in every if model.is_byte(i)}
        self.spelled = [model.id_to_piece(i) for i in every]
        plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.ids = {self.spelled[i]: i for i in plain}
        self.scores = {self.spelled[i]: model.get_score(i) for i in plain}
        self.pieces = sorted(self.ids)
        self.longest = max(map(len, self.pieces))
        self.units = self._units()

    def _units(self) -> re.Pattern:
        """Where a text can be cut because no piece lies across: before spaces, around line ends, after Latin words."""
        latin = re.compile(f"[{LATIN}][^{LATIN}]").search
        if any("\n" in p or SPACE in p.lstrip(SPACE) or latin(p) for p in self.pieces):
            raise ValueError("a piece of the vocabulary goes on after a word or a line end")
        marks = f"[^{SPACE}\n{LATIN}]"
        return re.compile(f"\n|{SPACE}+{marks}*[{LATIN}]*|{marks}+[{LATIN}]*|[{LATIN}]+")

    def merge(self, text: str) -> list[str]:
        """Encoding of a short text by merging its best-scored neighbours, leftmost first, again and again."""
        parts = list(text)
        while len(parts) > 1:
            scored = [(-self.scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.scores]
            if not scored:
                break
            i = min(scored)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by their first ``depth`` codes or more, by doubling ranks."""
    _, rank = np.unique(codes, return_inverse=True)
    rank, width = rank.astype(np.int64) + 1, 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        after = np.zeros_like(rank)
        after[:-width] = rank[width:]
        key = rank * (int(rank.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], np.diff(key[order]) != 0]).cumsum()
        rank = np.empty_like(rank)
        rank[order] = new
        width *= 2
        if new[-1] == len(rank):
            break
    return order


def occurrence_ranges(codes: np.ndarray, order: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last rank of the suffixes that start with each row of ``pieces`` (padded with -1)."""
    width = pieces.shape[1]
    text = np.concatenate([codes, np.zeros(width, codes.dtype)])  # 0 is below every code

    def bound(upper: bool) -> np.ndarray:
        low, high = np.zeros(len(pieces), np.int64), np.full(len(pieces), len(codes), np.int64)
        while (low < high).any():
            middle = (low + high) // 2
            windows = text[order[np.minimum(middle, len(codes) - 1)][:, None] + np.arange(width)]
            differs = (windows != pieces) & (pieces >= 0)
            at = differs.argmax(axis=1)
            rows = np.arange(len(pieces))
            less = differs[rows, at] & (windows[rows, at] < pieces[rows, at])
            right = (less | ~differs[rows, at]) if upper else less
            open_ = low < high
            low = np.where(open_ & right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        return low

    return bound(False), bound(True)


class Encoder:
    """Ids of texts, units that were seen before from memory."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.rows = np.full((len(vocabulary.pieces), vocabulary.longest), -1, np.int64)
        for i, piece in enumerate(vocabulary.pieces):
            self.rows[i, : len(piece)] = [ord(c) + 2 for c in piece]
        self.lengths = np.array([len(p) for p in vocabulary.pieces])
        self.units = Recent(f"pieces {vocabulary.path}", "units", CACHED_UNITS)
        self.pairs = Recent(f"pieces {vocabulary.path}", "pairs", CACHED_PAIRS)
        self.out = [np.array([vocabulary.ids[p]], "<u4").tobytes() for p in vocabulary.pieces]

    def texts(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text (empty: none)."""
        cut = [self.v.units.findall(SPACE + t.replace(" ", SPACE)) if t else () for t in texts]
        ids = self.units.values(set().union(*cut), self._make)
        return [b"".join(map(ids.__getitem__, units)) for units in cut]

    def edges(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and piece of every edge over the concatenated units, sorted by end, longest first.

        Units are closed by a code below all others, which no piece holds.
        """
        text = "\0".join(units) + "\0"
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) + 2
        closes = np.cumsum([len(u) + 1 for u in units]) - 1
        codes[closes] = 1
        order = suffix_array(codes, self.v.longest)
        first, last = occurrence_ranges(codes, order, self.rows)
        n = last - first
        piece = np.repeat(np.arange(len(n)), n)
        rank = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        start = order[rank]
        covered = np.zeros(len(codes), bool)
        covered[start[self.lengths[piece] == 1]] = True
        covered[closes] = True
        alone = np.flatnonzero(~covered)  # characters outside the vocabulary: one edge each
        start = np.concatenate([start, alone])
        end = np.concatenate([start[: len(piece)] + self.lengths[piece], alone + 1])
        piece = np.concatenate([piece, np.full(len(alone), -1)])
        by = np.lexsort((start, end))
        return start[by], end[by], piece[by]

    def _tolerated(self, pairs: list[tuple[int, int]]) -> list[bool]:
        pieces, merge = self.v.pieces, self.v.merge
        return [merge(pieces[a] + pieces[b]) == [pieces[a], pieces[b]] if a >= 0 else merge(pieces[b]) == [pieces[b]] for a, b in pairs]

    def _make(self, units: list[str]) -> list[bytes]:
        starts, ends, pieces = (a.tolist() for a in self.edges(units))
        size = sum(map(len, units)) + len(units)
        last, came = [None] * (size + 1), [0] * (size + 1)
        opens = bytearray(size + 1)
        at = 0
        for u in units:
            opens[at] = 1
            at += len(u) + 1
        known, kept = self.pairs.kept["young"], self.pairs
        for start, end, piece in zip(starts, ends, pieces):
            if last[end] is not None:
                continue
            before = -1 if opens[start] else last[start]  # -1, and -2 for a character that merges with nothing
            if before is None:
                continue
            if piece >= 0:
                pair = (max(before, -1), piece)
                fits = known.get(pair)
                if fits is None:
                    known = kept.values({pair}, self._tolerated)
                    fits = known[pair]
            else:
                fits = True
            if fits:
                last[end], came[end] = piece if piece >= 0 else -2, start
        out, at = [], 0
        for u in units:
            parts, end = [], at + len(u)
            while end > at:
                piece, start = last[end], came[end]
                if piece >= 0:
                    parts.append(self.out[piece])
                else:
                    spelled = [self.v.bytes[b] for b in u[start - at].encode("utf-8", "surrogatepass")]
                    parts.append(np.array(spelled, "<u4").tobytes())
                end = start
            out.append(b"".join(reversed(parts)))
            at += len(u) + 1
        return out


class Decoder:
    """Texts from ids: pieces joined, byte pieces read as UTF-8, the space put before the text taken off."""

    def __init__(self, vocabulary: Vocabulary):
        value = {i: b for b, i in vocabulary.bytes.items()}
        self.spelled = [
            bytes([value[i]]) if i in value else p.replace(SPACE, " ").encode() for i, p in enumerate(vocabulary.spelled)
        ]

    def __call__(self, ids: bytes) -> str:
        raw = b"".join(map(self.spelled.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace").removeprefix(" ")


def _encoded(part: pa.RecordBatch, encoder: Encoder) -> list[bytes]:
    return encoder.texts(part.column("text").cast(pa.string()).to_pylist())


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` (array<int>) of every text; null and empty texts have none. Repeated rows give equal rows."""
    path = vocabulary or public_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # millions of small strings and no cycles
        encoder = Encoder(Vocabulary(path))
        for part in slices(batches, max_bytes=8 << 20):
            ids = [np.frombuffer(b, "<i4") for b in _encoded(part, encoder)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return doc_texts(docs).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(rows: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id`` and ``text`` from ``doc_id`` and ``ids``; null or no ids give an empty text."""
    path = vocabulary or public_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Vocabulary(path))
        for batch in batches:
            texts = [decoder(np.array(ids or [], "<u4").tobytes()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def encoding_digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per text: number of ids, how many of them are bytes, their CRC, and what decoding them gives back.

    ``ids_crc32`` is over little-endian unsigned 32-bit ids; ``round_trip`` says
    whether the decoded text is the text. Null texts count as empty.
    """
    path = vocabulary or public_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        v = Vocabulary(path)
        encoder, decoder = Encoder(v), Decoder(v)
        is_byte = np.zeros(len(v.spelled), bool)
        is_byte[list(v.bytes.values())] = True
        for part in slices(batches, max_bytes=8 << 20):
            rows = []
            for text, ids in zip(part.column("text").to_pylist(), _encoded(part, encoder)):
                back = decoder(ids).encode()
                in_bytes = int(is_byte[np.frombuffer(ids, "<u4")].sum())
                rows.append((len(ids) // 4, in_bytes, zlib.crc32(ids), zlib.crc32(back), back == text))
            kinds = [pa.int64()] * 4 + [pa.bool_()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], NAMES)

    return doc_texts(docs).mapInArrow(
        run, "doc_id bigint, n_ids bigint, n_byte_ids bigint, ids_crc32 bigint, decoded_crc32 bigint, round_trip boolean"
    )


NAMES = ["doc_id", "n_ids", "n_byte_ids", "ids_crc32", "decoded_crc32", "round_trip"]


def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op9_suffix_array_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"))


QUERIES = {"op9_suffix_array_pieces": op9_suffix_array_pieces}
ORACLE: dict[str, str] = {}
