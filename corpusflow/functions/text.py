"""Column functions on text and token arrays. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.settings import IGNORE_INDEX, SPECIAL_IDS, VOCAB_SIZE


def words(text: Column) -> Column:
    """Whitespace-separated words; empty text gives an empty array."""
    return F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))


def hash_ids(tokens: Column, vocab_size: int = VOCAB_SIZE, special_ids: int = SPECIAL_IDS) -> Column:
    """Vocabulary-free token ids: 32 bits of md5 folded into the ids after the special ones."""

    def to_id(word: Column) -> Column:
        number = F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint")
        return (number % (vocab_size - special_ids) + special_ids).cast("int")

    return F.transform(tokens, to_id)


def truncate(ids: Column, max_length: int) -> Column:
    return F.slice(ids, 1, max_length)


def pad(ids: Column, max_length: int, pad_id: int | Column, side: str = "right") -> Column:
    """Extend ``ids`` to exactly ``max_length`` entries."""
    filler = F.array_repeat(_lit(pad_id), F.lit(max_length) - F.size(ids))
    return _two_sides(ids, filler, side)


def attention_mask(length: Column, max_length: int, side: str = "right") -> Column:
    """1 for a real token, 0 for padding."""
    real = F.array_repeat(F.lit(1), length)
    filler = F.array_repeat(F.lit(0), F.lit(max_length) - length)
    return _two_sides(real, filler, side)


def causal_labels(
    input_ids: Column,
    mask: str = "pad_id",
    pad_id: int | Column | None = None,
    attention: Column | None = None,
    ignore_index: int = IGNORE_INDEX,
) -> Column:
    """Labels of a causal model: the ids, with ignored positions replaced.

    ``mask="pad_id"`` ignores every occurrence of the pad id, so a real
    end-of-text token is ignored as well when it doubles as the pad token;
    ``mask="attention"`` ignores padding only.
    """
    if mask == "pad_id":
        if pad_id is None:
            raise ValueError("mask='pad_id' needs pad_id")
        return F.transform(input_ids, lambda x: F.when(x == _lit(pad_id), ignore_index).otherwise(x))
    if mask == "attention":
        if attention is None:
            raise ValueError("mask='attention' needs the attention mask")
        return F.zip_with(input_ids, attention, lambda x, m: F.when(m == 0, ignore_index).otherwise(x))
    raise ValueError(f"unknown mask mode {mask!r}")


def padded_labels(
    ids: Column,
    max_length: int,
    mask: str = "pad_id",
    pad_id: int | Column | None = None,
    side: str = "right",
    ignore_index: int = IGNORE_INDEX,
) -> Column:
    """:func:`causal_labels` of a padded row, from its unpadded ids: only real tokens are looked at."""
    real = ids if mask == "attention" else causal_labels(ids, mask, pad_id=pad_id, ignore_index=ignore_index)
    return pad(real, max_length, ignore_index, side)


def pad_token(pad: Column, eos: Column) -> Column:
    """The pad token, or the end-of-text token when there is none."""
    return F.coalesce(pad, eos)


def text_length(text: Column) -> Column:
    """Length in code points."""
    return F.length(text)


def _two_sides(values: Column, filler: Column, side: str) -> Column:
    if side == "right":
        return F.concat(values, filler)
    if side == "left":
        return F.concat(filler, values)
    raise ValueError(f"padding side must be 'left' or 'right', not {side!r}")


def _lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
