import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import langid, licenses, maxent, merkle, quality
from corpusflow.llm.common import doc_texts, held_out
from tests.llm.conftest import make_documents


# language ID


def brute_log(pieces_p, word):
    """Log of the sum over all segmentations, by recursion; characters in bytes where no piece covers them."""
    memo = {0: 1.0}
    for to in range(1, len(word) + 1):
        spelled = math.prod(pieces_p[b] for b in word[to - 1].encode())
        memo[to] = memo[to - 1] * spelled + sum(memo[a] * pieces_p.get(word[a:to], 0) for a in range(max(0, to - 16), to))
    return math.log(memo[len(word)])


def test_all_segmentations_are_summed():
    spelled = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "c"]
    pieces = langid.Pieces(spelled, list(range(256)))
    rng = np.random.default_rng(1)
    p = rng.random((pieces.size, 2))
    p /= p.sum(axis=0)
    words = ["▁", "▁a", "▁abab", "▁cabba", "▁éa", "▁" + "ab" * 60]
    found = langid.word_logs(pieces, p, words)
    for k in range(2):
        table = {s: p[i, k] for i, s in enumerate(spelled)} | {b: p[len(spelled) + b, k] for b in range(256)}
        for i, w in enumerate(words):
            assert found[i, k] == pytest.approx(brute_log(table, w))


def test_expected_counts_sum_to_the_characters():
    spelled = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "c"]
    pieces = langid.Pieces(spelled, list(range(256)))
    p = np.full(pieces.size, 1 / pieces.size)
    words, weights = ["▁abab", "▁éa", "▁ccc"], np.array([2.0, 1.0, 3.0])
    counts = langid.expected_counts(pieces, p, words, weights)
    size = [len(s.encode()) for s in spelled] + [1] * 256
    assert (counts * size).sum() == pytest.approx(sum(n * len(w.encode()) for w, n in zip(words, weights)))


def test_expected_counts_of_long_words_as_differences_of_their_logs():
    """Expected uses are derivatives of the log probability, also where that is far below the least float."""
    pieces = langid.Pieces(["▁", "a", "ab", "日本"], list(range(256)))
    p = np.full(pieces.size, 1e-4)
    word = "▁" + "日本語ab" * 19 + "語" * 4
    counts = langid.expected_counts(pieces, p, [word], np.array([3.0]))
    assert np.isfinite(counts).all()
    for piece in (1, 2, 3, pieces.first_byte + "語".encode()[0]):
        up, down = p.copy(), p.copy()
        up[piece], down[piece] = 1e-4 * 1.001, 1e-4 / 1.001
        high, low = (langid.word_logs(pieces, q[:, None], [word])[0, 0] for q in (up, down))
        assert counts[piece] == pytest.approx(3 * (high - low) / (2 * math.log(1.001)), rel=1e-4)


def test_rare_languages_and_texts_without_spaces_are_learned(spark):
    rng = random.Random(2)
    han = ["".join(chr(rng.randrange(0x4E00, 0x4F00)) for _ in range(300)) for _ in range(5)]
    rows = [(i, " ".join(rng.choice("storm river glass winter mill".split()) for _ in range(9)), "en") for i in range(1500)]
    rows += [(2000 + i, t, "zh") for i, t in enumerate(han)]
    rows += [(3000 + i, " ".join(rng.choice("fleuve orage verre hiver".split()) for _ in range(9)), "fr") for i in range(3)]
    docs, pieces = make_documents(spark, rows), langid.public_pieces()
    langs, p = langid.train(docs, pieces, train_docs=60)
    assert langs == ["en", "fr", "zh"] and np.isfinite(p).all()
    predict = langid.Identifier(pieces, langs, p)
    assert [lang for lang, _ in predict([rows[0][1].encode(), han[0].encode(), b"orage verre fleuve"])] == ["en", "zh", "fr"]


def test_languages_of_odd_rows(documents, rows):
    pieces = langid.public_pieces()
    langs, p = langid.train(documents, pieces)
    assert langs == ["de", "en", "fr", "ja"]
    found = langid.identify(documents, pieces, langs, p).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i in (30, 31, 32, 42):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[0].lang_pred in ("en", "fr") and by_id[41].lang_pred == "ja"
    assert all(0 <= r.score <= 1 for r in found)
    untaught = langid.identify(documents, pieces, [], p).collect()
    assert {r.lang_pred for r in untaught} == {"und"}


def test_held_out_languages(spark, sf_dir):
    from corpusflow.llm.langid import op4_segmented_unigrams

    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = op4_segmented_unigrams(spark, sf_dir).join(truth, "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).head()
    assert right >= 0.95 * n


# licences


def test_base_phrases_as_brute_force(documents, rows):
    found = {}
    for r in licenses.scan_licenses(documents).collect():
        found.setdefault(r.doc_id, []).append(r)
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, []).append(t)
    for i, ts in texts.items():
        want = []
        for t in ts:
            words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
            places, labels = [], set()
            for phrase, label in licenses.BASE_PHRASES.items():
                q = phrase.encode().split()
                hits = [k for k in range(len(words)) if words[k : k + len(q)] == q]
                places += hits
                labels |= {label} if hits else set()
            want.append((len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
        got = [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found[i]]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert found[43][0].labels == "apache,apache-2.0,cc-by,cc-by-nc,mit" and found[43][0].n_base == 4


def test_notices_need_their_phrase():
    listed = licenses.templates()
    idf = {w: 1.0 + i for i, w in enumerate(sorted({w for t in listed for w in t.words}))}
    index = licenses.RareWordIndex(listed, idf)
    for t in listed:
        labels = {listed[number].label for number, _, _ in index.scan([b"foo", *t.words, b"bar"])}
        assert t.label in labels
        broken = list(t.words)
        broken[t.must_from] = b"other"
        assert (t.label, True) not in {(listed[n].label, listed[n] == t) for n, _, _ in index.scan(broken)}


# Merkle trees


def test_edits_and_neighbours(documents, rows):
    import hashlib

    found = merkle.compare_with_next(documents).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for (i, t, _), (_, after, _) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        half = len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    assert sorted(repr((r.doc_id, r.n_chars, r.edited_sha256)) for r in found) == sorted(map(repr, want))
    by_text = {}
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text.setdefault(r.doc_id, set()).add(bytes(r.fingerprint))
    assert by_text[3] == by_text[33] == by_text[34]
    assert len({f for fs in by_text.values() for f in fs}) == len({t or "" for _, t, _ in rows})


def test_branches_locate_edits():
    text = "\n".join(f"Line {k} has some words. And a second sentence {k * k}." for k in range(60)).encode()
    changed = text.replace(b"Line 31 has", b"Line 31 had")
    one, other = merkle.fingerprint(text), merkle.fingerprint(changed)
    assert len(merkle.edits(other, one)) == 1 == len(merkle.edits(one, other))
    assert merkle.edits(one, one) == [] and merkle.likeness(one, one) == 1
    assert 0.95 < merkle.likeness(one, other) < 1
    assert merkle.likeness(one, merkle.fingerprint(b"")) == 0
    assert sum(len(s) for s in merkle.branches(one)) == 60


def test_one_document_is_its_own_neighbour(spark, no_documents):
    (row,) = merkle.compare_with_next(make_documents(spark, [(1, "Some words here. And there.", "en")])).collect()
    assert row.near_next == 1
    assert merkle.compare_with_next(no_documents).count() == 0


def test_texts_without_marks_have_leaves():
    rng = random.Random(3)
    for text in (
        "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(400)),
        " ".join(f"word{rng.randrange(900)}" for _ in range(200)),
        "na " * 400,
        "x" * 3000,
        ".\n" * 600,
    ):
        half = text[: len(text) // 2].encode()
        one, other = merkle.fingerprint(text.encode()), merkle.fingerprint(half + b"q" * len(half))
        assert len(merkle.leaves_of(one)) > 5 and merkle.likeness(one, other) > 0.2
        assert b"".join(merkle.leaf_pieces(text.encode())) == text.encode()
    assert len(merkle.leaves_of(merkle.fingerprint(b"one, two, three"))) == 3


def test_edited_fingerprints_are_those_of_the_edited_texts(documents, rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for (i, t, _), (_, after, _) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        half = len(t) // 2
        want.append(repr((i, merkle.fingerprint((t[: len(t) - half] + after[:half]).encode()))))
    found = merkle.compare_with_next(documents).collect()
    assert sorted(repr((r.doc_id, bytes(r.edited_fingerprint))) for r in found) == sorted(want)


# quality


def test_quality_of_odd_rows_and_held_out(spark, documents, rows, sf_dir):
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(24)] + [(3, 1, 0), (None, 1, 0), (99, None, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.train(documents, labels)
    found = quality.score_quality(documents, model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert quality.train(documents, labels.where("false")) is None
    assert {r.score for r in quality.score_quality(documents, None).collect()} == {0.5}
    truth = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality IS NOT NULL")
    got = quality.op6_latent_neighbours(spark, sf_dir).join(truth, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.9 * len(got)


def test_nearest_neighbours_are_exact():
    rng = np.random.default_rng(2)
    counts = rng.poisson(1.0, (60, 50))
    labels = rng.integers(0, 2, 60)
    model = quality.Neighbours.fit(counts, labels, rank=8)
    fresh = rng.poisson(1.0, (7, 50))
    unit = quality.Neighbours._vectors(fresh, model.idf, model.basis)
    for row, score in zip(unit, model.scores(fresh, k=5)):
        cosine = model.vectors @ row
        near = np.argsort(-cosine)[:5]
        weight = np.maximum(cosine[near], 0) ** quality.SHARPNESS
        assert score == pytest.approx((weight * labels[near]).sum() / weight.sum())


# language-model scores


def test_base_scores_as_brute_force(documents, rows):
    training = documents.where(~held_out("doc_id", 7, 2))
    for known in (5, 1 << 18):  # most tokens take the join, or none
        found = maxent.score_texts(documents, doc_texts(training), known).collect()
        counts = Counter()
        for i, t, _ in rows:
            if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
                counts.update((t or "").encode().lower().split() + [b"\n"])
        total, types = sum(counts.values()), len(counts)
        want = []
        for i, t, _ in rows:
            tokens = (t or "").encode().lower().split() + [b"\n"]
            base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in tokens)
            want.append((repr(i), len(tokens), sum(w in counts for w in tokens), total, round(base, 4)))
        got = [(repr(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found]
        assert sorted(got) == sorted(want)
        assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_probabilities_sum_to_one():
    rng = random.Random(4)
    words = [f"w{k}".encode() for k in range(3000)]
    counts = Counter(rng.choices(words, [1 / (k + 1) for k in range(3000)], k=20000))
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    mass = np.ones(maxent.ENDINGS)
    for rank, (w, n) in enumerate(top):
        if rank >= maxent.GROUPS * maxent.WORDS:
            mass[maxent.ending(w)] += n + 1
    stats = maxent.Statistics(20000, len(top), [w for w, _ in top], np.array([n for _, n in top]), mass)
    model = maxent.Model(stats)
    text = b" ".join(rng.choices(words[:300], k=400))
    _, codes, lengths, _ = model.encode([text, b""])
    before = model.log10(codes, lengths, model.end).sum()
    for _ in range(5):
        model.learn(codes, lengths, model.end)
    assert model.log10(codes, lengths, model.end).sum() > before
    history = codes[:2]
    total = 0.0
    for code in range(maxent.GROUPS * maxent.WORDS + maxent.ENDINGS):
        c = np.append(history, code)
        total += 10 ** model.log10(c, np.array([3]), model.end)[2]
    assert total == pytest.approx(1, abs=1e-4)


def test_nothing_to_learn_from(documents, rows, no_documents):
    found = maxent.score_texts(documents, doc_texts(no_documents)).collect()
    assert len(found) == len(rows) and {r.n_known for r in found} == {0} and {r.train_tokens for r in found} == {0}
    assert maxent.score_texts(no_documents, doc_texts(documents)).count() == 0


def test_quality_sample_is_bounded_however_often_an_id_is_repeated(spark):
    docs = make_documents(spark, [(1, f"text number {i}", "en") for i in range(500)] + [(i, "a b c", "en") for i in range(2, 40)])
    labels = spark.createDataFrame([(i, int(i > 5)) for i in range(1, 40)], "doc_id bigint, quality int")
    model = quality.train(docs, labels, rows_per_label=10)
    assert len(model.labels) == 15  # all five of label 0, ten of label 1
    assert sorted(set(model.shares.tolist())) == [1.0, 3.4]
    assert model.score_texts([None])[0] == pytest.approx(34 / 39)
    texts = [r.text for r in docs.collect()]
    n = sum((quality.trigram_counts(t.encode()) > 0).astype(int) for t in texts)
    assert np.allclose(model.idf, np.log((len(texts) + 1) / (n + 1)) + 1)
