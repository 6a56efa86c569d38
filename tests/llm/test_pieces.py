import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from corpusflow.llm import pieces


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=pieces.public_vocabulary())


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.Vocabulary(pieces.public_vocabulary()))


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.one_of(st.sampled_from("abehlnorst  ▁.,\n日é😀"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=6))
def test_ids_are_the_librarys_and_decode_to_the_text(library, encoder, texts):
    found = encoder.texts(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [library.encode(t) for t in texts]
    decode = pieces.Decoder(encoder.v)
    assert [decode(f) for f in found] == [t.replace("▁", " ") for t in texts]


def test_digests_of_odd_rows(documents, rows, library, no_documents):
    got = [(repr(r.doc_id), r.n_ids, r.ids_crc32, r.round_trip) for r in pieces.encoding_digests(documents).collect()]
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "")
        want.append((repr(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True))
    assert sorted(got) == sorted(want)
    back = pieces.decode(pieces.encode(documents)).collect()
    assert sorted(repr((r.doc_id, r.text)) for r in back) == sorted(repr((i, t or "")) for i, t, _ in rows)
    assert pieces.encoding_digests(no_documents).count() == 0


def test_occurrences_of_every_piece(encoder):
    units = ["▁the", "▁there", "other", "▁the the"]
    starts, ends, found = encoder.edges(units)
    text = "\0".join(units) + "\0"
    got = {(s, e) for s, e, p in zip(starts.tolist(), ends.tolist(), found.tolist()) if p >= 0}
    known = set(encoder.v.pieces)
    assert got == {(s, e) for s in range(len(text)) for e in range(s + 1, min(len(text), s + 16) + 1) if text[s:e] in known}
