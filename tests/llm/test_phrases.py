"""Counts and scores against plain Python, for any number of shards and cells."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import phrases as ph

from .conftest import make_documents, sentence

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def counts_by_hand(rows, least, longest):
    found, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                found[lang or "und"].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    kept = {(lang, len(p), " ".join(p)): a for lang, c in found.items() for p, a in c.items() if a >= least}
    return kept | {(lang, 0, ""): n for lang, n in totals.items() if n}


def best_by_hand(counts, kept=2000):
    f = {(lang, tuple(p.split(" "))): a for (lang, size, p), a in counts.items() if size}
    out = defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        longer = [b for (other, q), b in f.items() if other == lang and len(q) > len(p)
                  and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if not any(100 * b >= 80 * a for b in longer):
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, i + 1, p.decode(), -a, l, r, counts[lang, 0, ""], -s)
        for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:kept])
    }


def found_counts(docs, **kw):
    rows = ph.count_phrases(docs, **kw).collect()
    found = {(r.lang, r["size"], r.phrase): r.n for r in rows if r["size"]}
    assert len(found) == sum(1 for r in rows if r["size"])
    totals = Counter()
    for r in rows:
        if not r["size"]:
            totals[r.lang, 0, ""] += r.n
    return found | totals


@pytest.mark.parametrize("shards,cells", [(1, 1 << 20), (4, 1 << 20), (3, 64), (4, 1)])
def test_counts_do_not_depend_on_shards_or_cells(spark, documents, rows, shards, cells):
    """Odd rows; also with so few cells that many phrases, or all, share theirs."""
    assert found_counts(documents, least=3, shards=shards, cells=cells) == counts_by_hand(rows, 3, 4)


def test_scores(spark, documents, rows):
    counts = counts_by_hand(rows, 3, 4)
    best = ph.collocations(ph.count_phrases(documents, least=3, shards=2)).collect()
    assert {tuple(r) for r in best} == best_by_hand(counts)
    few = ph.collocations(ph.count_phrases(documents, least=3, shards=2), kept=5).collect()
    assert {tuple(r) for r in few} == best_by_hand(counts, 5)


def test_a_phrase_of_one_shard_and_late_words(spark):
    """Phrases that come to the threshold in the last scans are counted over all shards."""
    rng = random.Random(3)
    rows = [(i, "alpha beta gamma delta. " * (i % 5 == 4) * 2 + sentence(rng, 8), "en") for i in range(100)]
    docs = make_documents(spark, rows).coalesce(1).sortWithinPartitions("doc_id")
    assert found_counts(docs, least=35, shards=5) == counts_by_hand(rows, 35, 4)


def test_rare_phrases_whose_cycle_is_complete_are_not_written(spark, documents, rows, monkeypatch):
    kept, written = ph._kept, []

    def noting(counts):
        written.append(kept(counts))
        return written[-1]

    monkeypatch.setattr(ph, "_kept", noting)
    assert found_counts(documents, least=3, shards=2) == counts_by_hand(rows, 3, 4)
    assert len(written) > 2 and written[0].where("n < 3").count() > 0
    for scan, found in enumerate(written[1:], 1):
        complete = found.where(F.substring("key", 1, 1) <= F.lit(bytes([scan - 1])))
        assert complete.where((F.col("n") < 3) & (F.substring("key", 2, 1) > F.lit(bytes([0])))).count() == 0


def test_hashes_of_words_do_not_depend_on_where_they_stand():
    words = [b"", b"a", b"b", b"ab", b"ba", "ñandú".encode(), b"x" * 5000] * 3
    whole = ph._word_hashes(pa.array(words, pa.binary()), "en")
    assert len(set(whole.tolist())) == 7 and (whole[:7] == whole[7:14]).all()
    assert (ph._word_hashes(pa.array(words, pa.binary()), "en", 3) == whole).all()
    assert (ph._word_hashes(pa.array(words, pa.binary())[2:6], "en") == whole[2:6]).all()
    assert (ph._word_hashes(pa.array(words, pa.binary()), "fr") != whole).all()
    assert len(ph._word_hashes(pa.array([], pa.binary()), "en")) == 0


def test_products_pass_64_bits(spark):
    big = 1 << 61
    counts = spark.createDataFrame(
        [("en", 0, "", 3 * big), ("en", 1, "a", big + 7), ("en", 1, "b", big + 9), ("en", 2, "a b", big)],
        "lang string, size int, phrase string, n bigint",
    )
    [r] = ph.collocations(counts).collect()
    assert r.score == 2000000 * big // (2 * big + 16) and (r.a, r.l, r.r, r.n) == (big, big + 7, big + 9, 3 * big)


def test_blocks_keep_pieces_whole():
    rng = random.Random(5)
    texts = [b"a b,c\nd e", b"", b"x" * 300, b"one two three " * 40 + b"." + b"four five\n" * 50]
    whole = b".".join(texts)
    for limit in (16, 64, 100000):
        cut = list(ph.blocks(texts, limit))
        assert b"".join(cut) == whole
        pieces = [p for block in cut for p in re.split(rb"[.,;:!?\x0A-\x0D]", block) if p]
        assert pieces == [p for p in re.split(rb"[.,;:!?\x0A-\x0D]", whole) if p]


def test_empty_table(spark, no_documents):
    assert ph.collocations(ph.count_phrases(no_documents)).collect() == []
