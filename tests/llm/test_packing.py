import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusflow.llm import packing

PATH = public_tokenizers.path(packing.TOKENIZER)


def expected(text, capacity):
    ids = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [0]
    cuts = [ids[a : a + capacity] for a in range(0, len(ids), capacity)]
    return [(k, k * capacity, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for k, c in enumerate(cuts)]


def test_pieces_and_places(documents, rows):
    capacity = 64
    found = packing.pack_documents(documents, capacity, PATH).collect()
    want = sorted((repr(i), *p) for i, t, _ in rows for p in expected(t, capacity))
    assert sorted((repr(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    tokens = sum(r.length for r in found)
    assert len(by_sequence) <= 1.02 * tokens / capacity + 3


def test_same_sequences_whatever_the_partitions(documents):
    one = packing.pack_documents(documents.coalesce(1), 64, PATH).collect()
    other = packing.pack_documents(documents.repartition(5), 64, PATH).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, other))


def test_no_documents(no_documents):
    assert packing.pack_documents(no_documents).count() == 0


def brute_sum_of_squares(lengths, capacity):
    bins, out = [], []
    for n in lengths:
        count = [0] * (capacity + 1)
        for b in bins:
            count[capacity - b] += 1
        best = None
        for gap in [g for g in range(n, capacity) if count[g]] + [capacity]:
            after = list(count)
            if gap < capacity:
                after[gap] -= 1
            if gap > n:
                after[gap - n] += 1
            total = sum(c * c for c in after[1:])
            if best is None or total < best[0]:
                best = total, gap
        if best[1] == capacity:
            bins.append(n)
        else:
            bins[next(i for i, b in enumerate(bins) if capacity - b == best[1])] += n
        out.append(capacity - best[1])
    return out, len(bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=40))
def test_each_place_makes_the_squares_smallest(lengths):
    place, offset = packing.sum_of_squares(np.array(lengths, np.int64), 12)
    want, bins = brute_sum_of_squares(lengths, 12)
    assert offset.tolist() == want
    assert len(set(place.tolist())) == bins


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_chunks_give_the_tokenizers_ids(texts):
    encode = packing.ChunkIds(PATH)
    whole = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert encode(texts) == whole


def test_rows_without_an_id_spread_over_all_tasks(spark):
    rows = [(i if i % 3 else None, 0, 0, 5, 7) for i in range(3000)]
    pieces = spark.createDataFrame(rows, packing.PIECES).repartition(4)
    found = packing.pack(pieces, 64, pieces_per_task=100).collect()
    sizes = np.bincount([r.sequence_id >> 32 for r in found])
    assert len(found) == len(rows) and len(sizes) == 30 and sizes.max() < 200
