import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusflow.llm import repeats
from corpusflow.llm.suffixes import permuted_common_prefixes, suffix_array
from tests.llm.conftest import make_documents


def brute(texts, window):
    """Per document in order: removed bytes, runs, digest of the rest."""
    seen, out = set(), []
    for text in texts:
        mark = bytearray(len(text))
        for i in range(len(text) - window + 1):
            w = text[i : i + window]
            if w in seen:
                mark[i : i + window] = b"\1" * window
            seen.add(w)
        runs = sum(1 for i, m in enumerate(mark) if m and not (i and mark[i - 1]))
        kept = bytes(c for c, m in zip(text, mark) if not m)
        out.append((len(text), sum(mark), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowded", ["none", "all", "large"])
def test_repeats_as_brute_force(spark, monkeypatch, crowded):
    if crowded == "all":
        monkeypatch.setattr(repeats, "crowded_anchors", lambda *_: np.ones(repeats.SKETCH, bool))
    if crowded == "large":
        cut = repeats.cut_segments
        monkeypatch.setattr(repeats, "cut_segments", lambda *args: cut(*args, shard_segments=3))
    rng = random.Random(11)
    words = [rng.choice("abcdeé") * rng.randint(1, 3) + rng.choice("xyz") for _ in range(400)]
    passages = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(6)]
    texts = []
    for k in range(60):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 60)
            parts += [p[a : a + rng.randint(60, 400)], " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))]
        texts.append(" ".join(parts))
    texts += [texts[3], texts[3], "ab" * 700, "c" * 900, "c" * 99, "c" * 100, "", None, texts[5][:150] + texts[6][-150:], "abc " * 100 + texts[7]]
    ids = rng.sample(range(1000), len(texts))
    rows = sorted(zip(ids, texts))
    shuffled = make_documents(spark, [(i, t, "en") for i, t in rng.sample(rows, len(rows))]).repartition(4)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(shuffled).collect()}
    assert [found[i] for i, _ in rows] == brute([(t or "").encode() for _, t in rows], 100)


def test_odd_rows(documents, rows):
    found = repeats.remove_repeats(documents, carry=["source", "z"]).collect()
    assert len(found) == len(rows)
    assert {(r.source, r.z) for r in found} == {("src", "x")}
    for r in found:
        assert r.n_bytes - r.n_removed == len(r.kept)
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
    by_id = {r.doc_id: r for r in found}
    assert by_id[33].n_removed == by_id[33].n_bytes  # a copy of 3
    assert by_id[39].n_bytes - by_id[39].n_removed == 1
    assert (by_id[30].n_bytes, by_id[30].n_removed, by_id[30].n_spans) == (0, 0, 0)


def test_rows_without_id_are_told_apart(spark):
    """Many texts under one id or none, some twice: each loses what stands earlier, and nothing else."""
    rng = random.Random(5)
    passages = [" ".join(str(rng.randrange(10**6)) for _ in range(30)) for _ in range(5)]
    texts = []
    for k in range(1500):
        own = " ".join(str(rng.randrange(10**6)) for _ in range(rng.randrange(5, 60)))
        texts.append(own + rng.choice(passages) * rng.randrange(2))
    rows = [(None if k % 3 else 7, t, "en") for k, t in enumerate(texts)]
    docs = make_documents(spark, rows + rows[:9])
    order = [(r.id, r.h, bytes(r.text)) for r in repeats.source_texts(docs, []).collect()]
    want = brute([t for _, _, t in sorted(set(order))], 100)
    by_row = dict(zip(sorted(set(order)), want))
    found = repeats.remove_repeats(docs).collect()
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert got == sorted((7 if i == 7 else 0, *by_row[i, h, t]) for i, h, t in order)


def test_no_documents(no_documents):
    assert repeats.remove_repeats(no_documents).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=60), st.integers(1, 3))
def test_suffix_array_and_prefixes(text, times):
    raw = (text * times).encode()
    codes = np.frombuffer(raw, np.uint8)
    sa = suffix_array(codes, 200)
    assert sa.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    plcp = permuted_common_prefixes(codes, sa, 16) if len(raw) else []
    for before, i in zip(sa, sa[1:]):
        assert (plcp[i] >= 16) == (raw[i : i + 16] == raw[before : before + 16] and max(i, before) + 16 <= len(raw))
