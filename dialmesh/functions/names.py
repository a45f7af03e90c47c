"""Analysis of company names for full-text search."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, bind

# Word rules of Unicode text segmentation, as far as names need them: marks stay with their
# letter, an apostrophe, full stop, colon or middle dot joins letters, a full stop, comma,
# semicolon or apostrophe joins digits, and Han characters and Hiragana stand alone.
_ALONE = r"[\p{IsHan}\p{IsHiragana}]"
_WORD = r"[\p{L}\p{N}_&&[^\p{IsHan}\p{IsHiragana}]][\p{M}\u200D]*+"
_JOIN = r"(?:(?<=[\p{L}\p{M}])['’.:·](?=\p{L})|(?<=\p{N})['’.,;](?=\p{N}))"
TOKEN_PATTERN = rf"{_ALONE}\p{{M}}*+|(?:{_WORD})++(?:{_JOIN}(?:{_WORD})++)*+"


def name_tokens(text: Column | str) -> Column:
    """Lower-case words of a text, in order."""
    words = F.regexp_extract_all(F.lower(as_col(text)), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.coalesce(words, F.array().cast("array<string>"))


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of one bag of words, in the order of the terms.

    Equal words stand together once sorted, so the cost is that of a sort.
    """

    def runs(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(words) - 1)
        first = F.filter(places, lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))
        return bind(first, lambda starts: counted(words, starts))

    def counted(words: Column, starts: Column) -> Column:
        ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(words)))
        return F.zip_with(
            starts, ends, lambda a, b: F.struct(F.get(words, a).alias("term"), (b - a).alias("tf"))
        )

    empty = F.array().cast("array<struct<term:string,tf:int>>")
    return bind(F.sort_array(tokens), lambda words: F.when(F.size(words) > 0, runs(words)).otherwise(empty))
