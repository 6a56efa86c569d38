import random

import pytest

EXTRA = "piece int, length string, h string, fp string, key string, id string, z string, token string, n string, score string"
EXTRA_NAMES = [c.split()[0] for c in EXTRA.split(", ")]


def sentence(rng, n=12):
    words = "the of and storm river copper lantern harbour quiet seven glass winter mill stone thread open".split()
    return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."


def make_documents(spark, rows):
    """Rows ``(doc_id, text, lang)`` as a documents table with columns whose names clash with those used inside."""
    full = [(i, t, lang, "src", len(t) if t is not None else None, *([1] + ["x"] * 9)) for i, t, lang in rows]
    ddl = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"
    return spark.createDataFrame(full, ddl)


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, ids without text and texts without id."""
    rng = random.Random(7)
    plain = [" ".join(sentence(rng) for _ in range(rng.randint(1, 6))) for _ in range(24)]
    rows = [(i, t, "en") for i, t in enumerate(plain)]
    passage = " ".join(sentence(rng, 20) for _ in range(3))
    rows += [
        (30, None, None),
        (31, "", "en"),
        (32, "   \n\t ", None),
        (33, plain[3], "en"),
        (34, plain[3], "en"),
        (34, plain[3], "en"),
        (35, plain[4], "fr"),
        (35, plain[5] + " Other text.", "fr"),
        (None, plain[6], "en"),
        (None, None, None),
        (36, passage + "\n" + plain[7], "en"),
        (37, plain[8] + "\n" + passage, "en"),
        (38, "na " * 4000, "en"),
        (39, "x" * 30000, "en"),
        (40, " ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(20000)), "de"),
        (41, "日本語のテキスト 😀 é́ ñ Ünïcödé \x1c\x85 <|endoftext|> ﬁ", "ja"),
        (42, "!!! ### 12345 \x00 ...", None),
        (43, "Licensed under the Apache License, Version 2.0. MIT license; mit License. CC BY-NC 4.0", "en"),
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    return odd_rows()


@pytest.fixture(scope="session")
def documents(spark, rows):
    return make_documents(spark, rows).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return make_documents(spark, [])


def collected(df):
    return sorted((r.asDict() for r in df.collect()), key=repr)


