"""Language identification: unigram pieces, all segmentations summed.

Each language has probabilities over the pieces of a fixed public vocabulary. A
word's probability is the sum over all ways to cut it into pieces, computed by
the forward algorithm; characters no piece covers are spelled in byte pieces.
Pieces never cross a space, so a text's log probability is the sum of its
words', and equal words are computed once.
"""

from __future__ import annotations

import gc
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import Recent, held_out, parallelism, remainder_of, slices, table
from corpusflow.session import stored

VOCABULARY = "piece_bpe_32k.model"
TRAIN_DOCS = 8000
ROUNDS = 2
SMOOTHING = 0.01
TRAIN_WORD_CHARS = 100
CACHED_WORDS = 100_000
MAX_MODEL_BYTES = 64 << 20
UNKNOWN = "und"
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """Pieces of a vocabulary by the hash of their characters; byte pieces by value."""

    def __init__(self, spelled: list[str], byte_ids: list[int]):
        hashes = np.array([self._hash(p) for p in spelled], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces of the vocabulary have the same hash")
        self.number = order.astype(np.int64)
        self.longest = max(map(len, spelled))
        self.size = len(spelled) + 256
        self.first_byte = len(spelled)
        self.byte_ids = byte_ids

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    @classmethod
    def load(cls, path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        spelled = [
            model.id_to_piece(i)
            for i in ids
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
            and model.id_to_piece(i).lstrip("▁")
        ]
        return cls([*spelled, "▁"], [i for i in ids if model.is_byte(i)])

    def edges(self, chars: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(from, to, piece)`` for the words in the rows of ``chars``, by ``to``; ``piece`` is -1 where there is none."""
        n = chars.shape[1]
        codes = chars.astype(np.uint64) + np.uint64(1)
        running: dict[int, np.ndarray] = {}
        last = len(self.hashes) - 1
        for to in range(1, n + 1):
            running[to - 1] = np.zeros(len(chars), np.uint64)
            running.pop(to - 1 - self.longest, None)
            for start in running:
                h = running[start] = running[start] * _BASE + codes[:, to - 1]
                at = np.minimum(np.searchsorted(self.hashes, h), last)
                yield start, to, np.where(self.hashes[at] == h, self.number[at], -1)


def _by_length(words: list[str], cells: int) -> Iterator[tuple[list[int], np.ndarray]]:
    """Words of one length at a time, a row of code points each, with their places in ``words``."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths):
        places = np.flatnonzero(lengths == n)
        step = max(1, cells // int(n))
        for at in range(0, len(places), step):
            chosen = places[at : at + step].tolist()
            text = "".join(words[i] for i in chosen)
            chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(chosen), int(n))
            yield chosen, chars


def _byte_edges(pieces: Pieces, log_p: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Probability of each character spelled in bytes: rows of ``log_p`` summed."""
    distinct, back = np.unique(chars, return_inverse=True)
    spelled = [chr(c).encode("utf-8", "surrogatepass") for c in distinct.tolist()]
    logs = np.array([log_p[[pieces.first_byte + b for b in s]].sum(axis=0) for s in spelled])
    return np.exp(logs)[back.reshape(chars.shape)]


def word_logs(pieces: Pieces, p: np.ndarray, words: list[str], cells: int = 200_000) -> np.ndarray:
    """Log probability of every word under every column of ``p`` (pieces x languages), all segmentations summed."""
    out = np.empty((len(words), p.shape[1]))
    padded = np.vstack([p, np.zeros((1, p.shape[1]))])  # piece -1: no edge
    log_p = np.log(p)
    for places, chars in _by_length(words, cells):
        m, n = chars.shape
        spelled = _byte_edges(pieces, log_p, chars)
        alpha: dict[int, np.ndarray] = {0: np.ones((m, p.shape[1]))}
        logs = np.zeros((m, p.shape[1]))
        for start, to, piece in pieces.edges(chars):
            if to not in alpha:
                alpha[to] = alpha[to - 1] * spelled[:, to - 1]
                alpha.pop(to - 1 - pieces.longest, None)
            hit = np.flatnonzero(piece >= 0)
            if len(hit):
                alpha[to][hit] += alpha[start][hit] * padded[piece[hit]]
            if start == to - 1 and to % 8 == 0:  # all edges into ``to`` are in
                scale = alpha[to].copy()
                logs += np.log(scale)
                for values in alpha.values():
                    values /= scale
        out[places] = logs + np.log(alpha[n])
    return out


def expected_counts(pieces: Pieces, p: np.ndarray, words: list[str], weights: np.ndarray, cells: int = 200_000) -> np.ndarray:
    """Expected uses of every piece over all segmentations of the words, by the forward-backward algorithm."""
    counts = np.zeros(pieces.size)
    log_p = np.log(p)
    for places, chars in _by_length(words, cells):
        m, n = chars.shape
        distinct, back = np.unique(chars, return_inverse=True)
        bytes_of = [[pieces.first_byte + b for b in chr(c).encode("utf-8", "surrogatepass")] for c in distinct.tolist()]
        spelled = np.array([log_p[b].sum() for b in bytes_of])[back.reshape(chars.shape)]
        edges = [(s, t, hit, piece[hit]) for s, t, piece in pieces.edges(chars) if len(hit := np.flatnonzero(piece >= 0))]
        into: dict[int, list] = {}
        for edge in edges:
            into.setdefault(edge[1], []).append(edge)
        alpha = np.zeros((n + 1, m))  # logs: a long word's sums are too small for a float
        for to in range(1, n + 1):
            alpha[to] = alpha[to - 1] + spelled[:, to - 1]
            for start, _, hit, piece in into.get(to, ()):
                alpha[to][hit] = np.logaddexp(alpha[to][hit], alpha[start][hit] + log_p[piece])
        passing = np.zeros((n + 1, m))  # how much of the weight goes through a place
        passing[n] = weights[places]
        uses = np.empty((m, n))
        for to in range(n, 0, -1):
            flow = passing[to] * np.exp(alpha[to - 1] + spelled[:, to - 1] - alpha[to])
            uses[:, to - 1] = flow
            passing[to - 1] += flow
            for start, _, hit, piece in into.get(to, ()):
                flow = passing[to][hit] * np.exp(alpha[start][hit] + log_p[piece] - alpha[to][hit])
                passing[start][hit] += flow
                np.add.at(counts, piece, flow)
        spelled_uses = np.bincount(back.ravel(), uses.ravel(), len(distinct))
        for b, used in zip(bytes_of, spelled_uses.tolist()):
            np.add.at(counts, b, used)
    return counts


def words_of(text: str) -> list[str]:
    return ["▁" + w for w in text.lower().split()]


def train(texts: DataFrame, pieces: Pieces, train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities from rows ``doc_id, text, lang``.

    Fitted on each language's documents with the smallest hashes of their id,
    about an equal part of ``train_docs`` for each language or all it has, by ``rounds`` of expectation maximisation from equal
    probabilities. Words are counted and expected uses summed by Spark; what
    reaches the driver is one number per piece and language, at most
    ``MAX_MODEL_BYTES``. Words of over ``TRAIN_WORD_CHARS`` characters (texts
    without spaces) are learned from in pieces of so many.
    """
    texts = texts.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", "lang")
    most = MAX_MODEL_BYTES // (pieces.size * 8)
    sizes = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()
    if len(sizes) > most:
        raise ValueError(f"more than {most} languages make a model of more than {MAX_MODEL_BYTES} bytes")
    part = train_docs / max(1, len(sizes))
    shares = [(row.lang, math.ceil(min(1.0, part / row.n) * (1 << 40))) for row in sizes]
    limits = F.broadcast(texts.sparkSession.createDataFrame(shares, "lang string, share bigint"))
    placed = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40))
    sample = texts.join(limits, "lang").where(placed < F.col("share")).select("doc_id", "text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[tuple[str, str]] = Counter()
        for part in slices(batches):
            for text, lang in zip(part.column("text").cast(pa.string()).to_pylist(), part.column("lang").to_pylist()):
                found.update((lang, w[i : i + TRAIN_WORD_CHARS]) for w in words_of(text) for i in range(0, len(w), TRAIN_WORD_CHARS))
        keys = list(found)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])

    counted = sample.select(F.col("text").cast("binary").alias("text"), "lang").mapInArrow(
        count, "lang string, word string, n bigint"
    )
    counted = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language_words")
    langs = sorted(row.lang for row in counted.select("lang").distinct().collect())
    p = np.full((pieces.size, max(1, len(langs))), 1 / pieces.size)
    dealt = counted.repartition(parallelism(texts.sparkSession), "word")
    for _ in range(rounds if langs else 0):

        def expect(batches: Iterator[pa.RecordBatch], p=p) -> Iterator[pa.RecordBatch]:
            sums = np.zeros_like(p)
            for batch in batches:
                of = np.array(batch.column("lang").to_pylist(), object)
                words = np.array(batch.column("word").to_pylist(), object)
                weights = batch.column("n").to_numpy().astype(float)
                for k, lang in enumerate(langs):
                    at = np.flatnonzero(of == lang)
                    if len(at):
                        sums[:, k] += expected_counts(pieces, p[:, k], words[at].tolist(), weights[at])
            piece, k = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(k), pa.array(sums[piece, k])], ["piece", "k", "n"])

        summed = dealt.mapInArrow(expect, "piece bigint, k bigint, n double").groupBy("piece", "k").agg(F.sum("n").alias("n"))
        counts = np.full_like(p, SMOOTHING)
        for row in summed.collect():  # one row per piece and language at most
            counts[row.piece, row.k] += row.n
        p = counts / counts.sum(axis=0)
    return langs, p


class Identifier:
    """Languages and posteriors of texts in one task."""

    def __init__(self, pieces: Pieces, langs: list[str], p: np.ndarray):
        import regex

        self.pieces, self.langs, self.p = pieces, langs, p
        self.letter = regex.compile(r"\p{L}").search
        self.recent = Recent(f"langid {zlib.crc32(p.tobytes())}", "words", CACHED_WORDS)

    def _make(self, words: list[str]) -> list[bytes]:
        return [row.tobytes() for row in word_logs(self.pieces, self.p, words).astype(np.float32)]

    def __call__(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        plain = [t.decode() if t is not None else "" for t in texts]
        words = [words_of(t) if self.langs and self.letter(t) else [] for t in plain]
        logs = self.recent.values(set().union(*words), self._make)
        out = []
        for ws in words:
            if not ws:
                out.append((UNKNOWN, 0.0))
                continue
            rows = np.frombuffer(b"".join(map(logs.__getitem__, ws)), np.float32).reshape(len(ws), -1)
            total = rows.sum(axis=0, dtype=np.float64)
            best = int(total.argmax())
            out.append((self.langs[best], float(1 / np.exp(total - total[best]).sum())))
        return out


def identify(docs: DataFrame, pieces: Pieces, langs: list[str], p: np.ndarray) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score``, the posterior of that language for equal priors.

    Null texts, texts without a letter, and all texts if no language was learned
    are ``und`` with score 0. Repeated rows give equal rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        predict = Identifier(pieces, langs, p)
        for part in slices(batches, max_bytes=2 << 20):
            labels, scores = zip(*predict(part.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def public_pieces() -> Pieces:
    import public_tokenizers

    return Pieces.load(public_tokenizers.path(VOCABULARY))


def op4_segmented_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pieces = table(spark, sf_dir, "documents"), public_pieces()
    langs, p = train(docs.where(remainder_of("doc_id", 4) != 2), pieces)
    found = identify(docs, pieces, langs, p)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


QUERIES = {"op4_segmented_unigrams": op4_segmented_unigrams}
ORACLE: dict[str, str] = {}
