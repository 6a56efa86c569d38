"""Language-model scores: a hashed maximum-entropy model with class-factored softmax.

A token's probability is that of its class given the tokens before it, times
that of the token in its class. The most frequent tokens fall into classes of
``WORDS`` by frequency, whose members are told apart by the model; all others
into classes by their ending, where a token's share is its smoothed count.
Features are the token before, the two before, and the one before the last;
their weight rows are found by hashing. Training starts at the class-factored
unigram model; each task takes gradient steps over its own documents and
Spark averages the rows, each task weighted by how often it used the row.
"""

from __future__ import annotations

import gc
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import doc_texts, held_out, parallelism, slices, sorted_groups, table
from corpusflow.session import stored

END = b"\n"  # no word holds it
KNOWN = 1 << 18
GROUPS, WORDS, ENDINGS = 16, 64, 16
CLASSES = GROUPS + ENDINGS
ROWS = 1 << 14
STEP = 1.0
BATCH = 8192
COUNTER_ENTRIES = 500_000


def tokens_of(text: bytes) -> list[bytes]:
    """Words of the lower-cased text and the end."""
    words = text.lower().split()
    words.append(END)
    return words


def token_counts(texts: DataFrame) -> DataFrame:
    """``token`` and ``n`` over all rows of ``texts``, counted in each task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["token", "n"])

        for part in slices(batches):
            for text in part.column("text").to_pylist():
                counts.update(tokens_of(text))
            if len(counts) > COUNTER_ENTRIES:
                yield out()
                counts.clear()
        yield out()

    return texts.select("text").mapInArrow(run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def ending(token: bytes) -> int:
    return zlib.crc32(token[-2:]) % ENDINGS


@dataclass
class Statistics:
    """What the corpus counts say: totals, the most frequent tokens, counts and types per ending."""

    total: int
    types: int
    words: list[bytes]
    counts: np.ndarray
    ending_mass: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame, known: int = KNOWN) -> Statistics:
        """From stored counts; the most frequent tokens, ``known`` at most, reach the driver, and so every task.

        They are those of at least a certain count, found from a histogram of a
        few thousand bins, so that no task sends more than it holds of them.
        """
        total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).head()
        bin_ = F.when(F.col("n") < 1024, F.col("n")).otherwise(F.floor(F.log2("n") * 32) + 704)
        bins = counts.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("tokens"), F.min("n").alias("least")).collect()
        least, held = None, 0
        for row in sorted(bins, key=lambda r: -r.bin):
            held += row.tokens
            if held > known:
                break
            least = row.least
        top = counts.where(F.col("n") >= least).toArrow() if least is not None else None
        tokens, numbers = (top["token"].to_pylist(), top["n"].to_pylist()) if top is not None else ([], [])
        order = sorted(range(len(tokens)), key=lambda i: (-numbers[i], tokens[i]))
        words = [tokens[i] for i in order]
        n = np.array([numbers[i] for i in order], np.int64)
        end = F.pmod(F.crc32(F.substring("token", -2, 2)), F.lit(ENDINGS)).cast("int")
        mass = np.ones(ENDINGS)  # each ending's unseen tokens count as one type seen never
        for row in counts.groupBy(end.alias("e")).agg(F.sum(F.col("n") + 1).alias("m")).collect():
            mass[row.e] += row.m
        for word, count in zip(words[: GROUPS * WORDS], n):
            mass[ending(word)] -= count + 1
        return cls(total, types, words, n, mass)


class Model:
    """Weights of the features over classes (``by_class``) and over the members of a group (``in_group``)."""

    def __init__(self, stats: Statistics):
        size = GROUPS * WORDS
        self.index = {w: i for i, w in enumerate(stats.words)}
        self.counts = stats.counts
        code = [i if i < size else size + ending(w) for i, w in enumerate(stats.words)]
        self.codes = np.array(code + [0], np.int64)  # the last stands for tokens not known
        share = np.zeros(size)
        share[: min(size, len(stats.counts))] = stats.counts[:size] + 1
        share = share.reshape(GROUPS, WORDS)
        with np.errstate(divide="ignore"):
            self.group_bias = np.log(share / np.maximum(share.sum(axis=1, keepdims=True), 1e-300)).astype(np.float32)
            mass = np.concatenate([share.sum(axis=1), stats.ending_mass])
            self.class_bias = np.log(mass / mass.sum()).astype(np.float32)
        self.group_bias = np.maximum(self.group_bias, -60)
        self.class_bias = np.maximum(self.class_bias, -60)
        self.log_mass = np.log10(stats.ending_mass)
        self.by_class = np.zeros((ROWS, CLASSES), np.float32)
        self.in_group = np.zeros((ROWS, WORDS), np.float32)
        self.class_uses = np.zeros(ROWS, np.float64)
        self.group_uses = np.zeros(ROWS, np.float64)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
        """Places in the list of known tokens (-1: none), codes, the texts' lengths, and the tokens."""
        tokens = [tokens_of(t) for t in texts]
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat = [t for ts in tokens for t in ts]
        at = np.fromiter(map(self.index.get, flat, repeat(-1)), np.int64, len(flat))
        codes = self.codes[at]
        unknown = np.flatnonzero(at < 0)
        codes[unknown] = [GROUPS * WORDS + ending(flat[i]) for i in unknown.tolist()]
        return at, codes, lengths, tokens

    @staticmethod
    def contexts(codes: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
        """Feature numbers of every token: the one before, the two before, the one before the last.

        Before a text's first token stand ends.
        """
        first = np.cumsum(lengths) - lengths
        one, two = np.empty_like(codes), np.empty_like(codes)
        one[1:], two[2:] = codes[:-1], codes[:-2]
        one[first] = end
        two[first] = end
        two[first[lengths > 1] + 1] = end
        span = GROUPS * WORDS + ENDINGS
        return np.stack([one, span * (1 + two) + one, span * (span + 2) + two])

    @staticmethod
    def rows(features: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
        h = (features.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= np.asarray(salt, np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(50)).astype(np.int64)  # 14 bits: ROWS

    @staticmethod
    def _softmax(logits: np.ndarray) -> np.ndarray:
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def _class_p(self, rows: np.ndarray) -> np.ndarray:
        return self._softmax(self.by_class[rows[0]] + self.by_class[rows[1]] + self.by_class[rows[2]] + self.class_bias)

    def _group_p(self, rows: np.ndarray, group: np.ndarray) -> np.ndarray:
        w = self.in_group
        return self._softmax(w[rows[0]] + w[rows[1]] + w[rows[2]] + self.group_bias[group])

    @staticmethod
    def classes(codes: np.ndarray) -> np.ndarray:
        return np.where(codes < GROUPS * WORDS, codes // WORDS, codes - GROUPS * WORDS + GROUPS)

    @staticmethod
    def _descend(weights: np.ndarray, uses: np.ndarray, rows: np.ndarray, gradient: np.ndarray, step: float) -> None:
        """A step on each row used, smaller the more often it was used before."""
        for feature in rows:
            order = np.argsort(feature, kind="stable")
            sorted_rows = feature[order]
            cuts = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
            at, n = sorted_rows[cuts], np.diff(np.append(cuts, len(sorted_rows)))
            uses[at] += n
            scale = (step / np.sqrt(n * uses[at])).astype(np.float32)
            weights[at] -= np.add.reduceat(gradient[order], cuts, axis=0) * scale[:, None]

    def learn(self, codes: np.ndarray, lengths: np.ndarray, end: int, step: float = STEP) -> None:
        features, classes = self.contexts(codes, lengths, end), self.classes(codes)
        for start in range(0, len(codes), BATCH):
            part = slice(start, start + BATCH)
            f, y, code = features[:, part], classes[part], codes[part]
            rows = self.rows(f, 0)
            g = self._class_p(rows)
            g[np.arange(len(y)), y] -= 1
            self._descend(self.by_class, self.class_uses, rows, g, step)
            inside = np.flatnonzero(y < GROUPS)
            if len(inside):
                rows = self.rows(f[:, inside], y[inside] + 1)
                g = self._group_p(rows, y[inside])
                g[np.arange(len(inside)), code[inside] % WORDS] -= 1
                self._descend(self.in_group, self.group_uses, rows, g, step)

    def log10(self, codes: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
        """Log probability of every token, for tokens outside the groups without their share of the ending's mass."""
        features, classes = self.contexts(codes, lengths, end), self.classes(codes)
        out = np.empty(len(codes))
        for start in range(0, len(codes), BATCH):
            part = slice(start, start + BATCH)
            f, y, code = features[:, part], classes[part], codes[part]
            p = self._class_p(self.rows(f, 0))[np.arange(len(y)), y].astype(float)
            inside = np.flatnonzero(y < GROUPS)
            if len(inside):
                rows = self.rows(f[:, inside], y[inside] + 1)
                p[inside] *= self._group_p(rows, y[inside])[np.arange(len(inside)), code[inside] % WORDS]
            out[part] = np.log10(np.maximum(p, 1e-300))
        return out

    @property
    def end(self) -> int:
        at = self.index.get(END, -1)
        return int(self.codes[at]) if at >= 0 else GROUPS * WORDS + ending(END)


def train(texts: DataFrame, stats: Statistics, step: float = STEP) -> Model:
    """One pass of gradient steps over all rows of ``texts``; the averaged rows (a fixed number) reach the driver."""
    model = Model(stats)
    if not stats.words:
        return model

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        own = Model(stats)
        for part in slices(batches):
            _, codes, lengths, _ = own.encode(part.column("text").to_pylist())
            own.learn(codes, lengths, own.end, step)
        for kind, weights, uses in ((0, own.by_class, own.class_uses), (1, own.in_group, own.group_uses)):
            used = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used * 2 + kind),
                    pa.array(uses[used]),
                    pa.array([weights[r].tobytes() for r in used.tolist()], pa.binary()),
                ],
                ["row", "uses", "weights"],
            )

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "row", min_rows=4096):
            keys, uses = group.column("row").to_numpy(), group.column("uses").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])).tolist()
            raw = group.column("weights").to_pylist()
            means = [
                np.average([np.frombuffer(w, np.float32) for w in raw[a:b]], axis=0, weights=uses[a:b]).astype(np.float32).tobytes()
                for a, b in zip(cuts, cuts[1:])
            ]
            sums = [float(uses[a:b].sum()) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[cuts[:-1]]), pa.array(sums), pa.array(means, pa.binary())], ["row", "uses", "weights"]
            )

    ddl = "row bigint, uses double, weights binary"
    taught = texts.select("text").mapInArrow(learn, ddl)
    dealt = taught.repartition(parallelism(texts.sparkSession), "row").sortWithinPartitions("row", "uses", "weights")
    for row in dealt.mapInArrow(average, ddl).collect():
        (model.in_group if row.row % 2 else model.by_class)[row.row // 2] = np.frombuffer(row.weights, np.float32)
    return model


PARTS = (
    "doc_id bigint, h bigint, rows bigint, n_tokens bigint, n_known bigint, base double, score double, "
    "token binary, tf bigint"
)


def score_texts(docs: DataFrame, training: DataFrame, known: int = KNOWN, step: float = STEP) -> DataFrame:
    """Unigram and model scores of every text of ``docs``, learned from the rows of ``training``.

    The ``known`` most frequent tokens' counts are looked up in the task; a
    text's other tokens meet their counts in a join on the token. A row is told
    from another with its doc_id by the hash of its text; repeated rows get equal
    results, as often as they occur. A null or empty text is the end token
    alone. Without training texts every token has count 0.
    """
    counts = stored(token_counts(training), "token_counts")
    stats = Statistics.of(counts, known)
    model = train(training, stats, step)
    total, types = stats.total, stats.types
    every = math.log10(total + types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        end = model.end
        counted = np.append(np.log10(model.counts + 1.0), 0.0)
        for part in slices(batches):
            at, codes, lengths, tokens = model.encode(part.column("text").to_pylist())
            first = np.cumsum(lengths) - lengths
            logs, unigram = model.log10(codes, lengths, end), counted[at]
            outside = codes >= GROUPS * WORDS
            logs += np.where(outside, unigram, 0)
            logs[outside] -= model.log_mass[codes[outside] - GROUPS * WORDS]
            n = len(lengths)
            head = [
                part.column("doc_id"),
                part.column("h"),
                pa.array(np.ones(n, np.int64)),
                pa.array(lengths),
                pa.array(np.add.reduceat((at >= 0).astype(np.int64), first)),
                pa.array(np.add.reduceat(unigram, first) - lengths * every),
                pa.array(np.add.reduceat(logs, first)),
                pa.nulls(n, pa.binary()),
                pa.nulls(n, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(head, NAMES)
            unknown = np.flatnonzero(at < 0)
            owner = np.searchsorted(first, unknown, side="right") - 1
            tail = Counter((o, tokens[o][i - f]) for i, o, f in zip(unknown.tolist(), owner.tolist(), first[owner].tolist()))
            rows = pa.array([o for o, _ in tail], pa.int64())
            m = len(tail)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(rows),
                    part.column("h").take(rows),
                    *[pa.nulls(m, pa.int64())] * 3,
                    *[pa.nulls(m, pa.float64())] * 2,
                    pa.array([t for _, t in tail], pa.binary()),
                    pa.array(list(tail.values()), pa.int64()),
                ],
                NAMES,
            )

    texts = doc_texts(docs).withColumn("h", F.xxhash64("text"))
    parts = stored(texts.mapInArrow(run, PARTS), "scores")
    rare = parts.where("token IS NOT NULL").select("doc_id", "h", "token", "tf").join(counts, "token")
    gain = F.col("tf") * F.log10(F.col("n") + F.lit(1.0))
    none = F.lit(None).cast("bigint")
    found = rare.select(
        "doc_id", "h", none.alias("rows"), none.alias("n_tokens"), F.col("tf").alias("n_known"), gain.alias("base"), gain.alias("score")
    )
    both = parts.where("token IS NULL").select(found.columns).union(found)
    summed = both.groupBy("doc_id", "h").agg(*[F.sum(c).alias(c) for c in found.columns[2:]])
    per_row = {c: F.col(c) / F.col("rows") for c in ("base", "score")} | {
        c: F.expr(f"{c} div rows") for c in ("n_tokens", "n_known")
    }
    return (
        summed.withColumns(per_row)
        .select("doc_id", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), "score", F.expr("explode(array_repeat(0, int(rows)))").alias("_copy"))
        .drop("_copy")
    )


NAMES = [c.split()[0] for c in PARTS.split(", ")]


def op10_hashed_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = score_texts(docs, doc_texts(docs.where(~held_out("doc_id", 7, 2))))
    return found.withColumn("held_out", held_out("doc_id", 7, 2))


QUERIES = {"op10_hashed_maxent": op10_hashed_maxent}
ORACLE: dict[str, str] = {}
