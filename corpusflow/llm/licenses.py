"""Licence scan: a positional index of the templates' rarest words.

Every template (a licence notice or phrase) is indexed by its words of highest
IDF, with their places. A file's occurrences of such a word vote for where the
template would start; a start with votes enough is verified word by word, and
counts only if the template's mandatory phrase stands there in full.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import doc_texts, slices, table

# Phrases and labels of the contract.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Sentences of public licence notices, the label each stands for and the phrase that has to be complete.
NOTICES = [
    ("gpl", "gnu general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license", "licensed under the gnu lesser general public license"),
    ("agpl", "gnu affero general public license", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("gpl-3.0", "gnu general public license version 3", "licensed under the gnu general public license version 3"),
    ("gpl-2.0", "gnu general public license version 2", "licensed under the gnu general public license version 2"),
    ("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "mozilla public license v 2 0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "eclipse public license", "made available under the terms of the eclipse public license"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc-by", "creative commons attribution", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "cc0 1 0 universal", "cc0 1 0 universal public domain dedication"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
]
RARE_WORDS = 6
LEAST_VOTES = 0.5

#: A-Z to lower case, all other ASCII but digits and letters to a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
DDL = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double"
)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    must_from: int
    must_to: int
    base: bool


def templates() -> list[Template]:
    """Base phrases, which are mandatory as a whole, and notices with their mandatory phrase."""
    out = [Template(label, w, 0, len(w), True) for p, label in BASE_PHRASES.items() for w in [tuple(p.encode().split())]]
    for label, phrase, notice in NOTICES:
        words, must = tuple(notice.encode().split()), tuple(phrase.encode().split())
        at = next(i for i in range(len(words)) if words[i : i + len(must)] == must)
        out.append(Template(label, words, at, at + len(must), False))
    return out


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def document_frequencies(texts: DataFrame, vocabulary: frozenset[bytes]) -> tuple[int, dict[bytes, int]]:
    """Number of documents, and in how many each word of a fixed vocabulary occurs (one row per task and word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for part in slices(batches):
            for text in part.column("text").to_pylist():
                counts[b""] += 1
                counts.update(vocabulary.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    found = texts.mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    by_word = {bytes(row.word): row.n for row in found.collect()}  # at most one row per word of the templates
    return by_word.pop(b"", 0), by_word


class RareWordIndex:
    """Postings ``word -> (template, place)`` of each template's rarest words, one of the mandatory phrase's at least."""

    def __init__(self, all_templates: list[Template], idf: dict[bytes, float], rare: int = RARE_WORDS):
        self.templates = all_templates
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.needed: list[int] = []
        for number, t in enumerate(all_templates):
            places = sorted(range(len(t.words)), key=lambda i: (-idf[t.words[i]], i))
            if t.base:
                chosen = places[:1]  # one place decides: every occurrence is then verified
            else:
                chosen = places[:rare]
            for i in chosen:
                self.postings.setdefault(t.words[i], []).append((number, i))
            self.needed.append(max(1, math.ceil(LEAST_VOTES * len(chosen))))
        self.words = frozenset(self.postings)

    def scan(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """Verified template numbers, their starts (which may lie before the file) and shares of words that agree."""
        present = self.words.intersection(words)
        if not present:
            return []
        votes: Counter[tuple[int, int]] = Counter()
        for i, word in enumerate(words):
            if word in present:
                votes.update((number, i - place) for number, place in self.postings[word])
        found = []
        for (number, start), n in votes.items():
            t = self.templates[number]
            low = start + t.must_from
            if n < self.needed[number] or low < 0:
                continue
            if tuple(words[low : start + t.must_to]) != t.words[t.must_from : t.must_to]:
                continue
            there = sum(0 <= start + k < len(words) and words[start + k] == w for k, w in enumerate(t.words))
            found.append((number, start, there / len(t.words)))
        return found


def scan_licenses(docs: DataFrame, rare: int = RARE_WORDS) -> DataFrame:
    """Licence labels of every text and where its base phrases stand.

    IDF comes from all documents. ``score`` is the best share of a template's
    words found in place, 0 without a label. A null or empty text has no words
    and no labels (empty strings); repeated rows give equal rows.
    """
    texts = doc_texts(docs)
    listed = templates()
    vocabulary = frozenset(w for t in listed for w in t.words)
    total, frequency = document_frequencies(texts.select("text"), vocabulary)
    idf = {w: math.log((total + 1) / (frequency.get(w, 0) + 1)) for w in vocabulary}
    index = RareWordIndex(listed, idf, rare)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                words = words_of(text)
                found = index.scan(words)
                places = [start for number, start, _ in found if listed[number].base]
                base = sorted({listed[number].label for number, _, _ in found if listed[number].base})
                labels = sorted({listed[number].label for number, _, _ in found})
                ends = (min(places), max(places)) if places else (None, None)
                score = max((share for _, _, share in found), default=0.0)
                rows.append((doc_id, len(words), len(places), *ends, ",".join(base), ",".join(labels), score))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
            names = [c.split()[0] for c in DDL.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return texts.mapInArrow(run, DDL)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


QUERIES = {"op7_license_scan": op7_license_scan}
ORACLE: dict[str, str] = {}
