"""Text guards and normalisation (``Column -> Column``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    """True for NULL and for text made of spaces only."""
    return c.isNull() | (F.trim(c) == "")


def blank_to_null(c: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def name_key(c: Column) -> Column:
    """Key under which two spellings of a name count as the same."""
    return F.lower(F.trim(c))


def is_missing(c: Column, tokens: Sequence[str]) -> Column:
    """True for NULL, blank and for the given words that stand for "no value"."""
    return is_blank(c) | name_key(c).isin(*tokens)


def tokens_to_null(c: Column, tokens: Sequence[str]) -> Column:
    """Trimmed text, NULL where :func:`is_missing`."""
    return F.when(~is_missing(c, tokens), F.trim(c))


def labelled(*parts: tuple[str, Column]) -> Column:
    """``label=value`` pairs joined by ``; ``, a NULL value written as ``NULL``."""
    pieces = []
    for i, (label, value) in enumerate(parts):
        pieces.append(F.lit(f"{'; ' if i else ''}{label}="))
        pieces.append(F.coalesce(value.cast("string"), F.lit("NULL")))
    return F.concat(*pieces)
