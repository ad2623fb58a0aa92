"""Text cells to typed values; whatever does not fit the expected shape becomes NULL.

Shape tests end with ``\\z``: Java's ``$`` would also accept a trailing line break. Casts are
``try_cast``: one unreadable cell among billions must not end the job. :func:`unreadable` finds
the cells that had the right shape and still could not be read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill.functions.text import blank_to_null

# Shapes of the source cells.
DECIMAL_SHAPE = r"^[0-9]+(\.[0-9]+)?\z"
COUNT_SHAPE = r"^[0-9]+\z"
SIZE_SHAPE = r"^[0-9]+(\.[0-9]+)?[MmKk]\z"
DATE_SHAPE = r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{2}\z"
DATE_FORMAT = "d-MMM-yy"
# Two-digit years from here on belong to the 1900s; Spark reads them as 20xx.
CENTURY_PIVOT = 2070

# 34 decimals: the range test sees the cell as written, before it is rounded to two places.
_AS_WRITTEN = "decimal(38,34)"
# 18 digits before the point cover every size a bigint holds, given in kibibytes.
_SIZE_NUMBER = "decimal(28,10)"


def parse_rating(c: Column) -> Column:
    t = F.trim(c)
    as_written = F.when(t.rlike(DECIMAL_SHAPE), t.try_cast(_AS_WRITTEN))
    return F.when(as_written.between(0, 5), t.try_cast("decimal(3,2)"))


def parse_count(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t.rlike(COUNT_SHAPE), t.try_cast("bigint"))


def parse_size(c: Column) -> Column:
    """``19M`` and ``201k`` to bytes."""
    t = F.trim(c)
    number = t.substr(F.lit(1), F.length(t) - 1).try_cast(_SIZE_NUMBER)
    unit = F.when(F.lower(F.right(t, F.lit(1))) == "m", 1024 * 1024).otherwise(1024)
    size = F.round(number * unit.cast("decimal(7,0)"), 0).try_cast("bigint")
    return F.when(t.rlike(SIZE_SHAPE), size)


def parse_installs(c: Column) -> Column:
    """Digits of the cell; a sign is dropped with everything else."""
    return _digits(c, "[^0-9]").try_cast("bigint")


def parse_price(c: Column) -> Column:
    """Digits and points of the cell; a sign is dropped with everything else."""
    return _digits(c, r"[^0-9\.]").try_cast("decimal(10,2)")


def parse_date(c: Column) -> Column:
    t = F.trim(c)
    day = F.try_to_date(F.when(t.rlike(DATE_SHAPE), t), DATE_FORMAT)
    return F.when(F.year(day) >= CENTURY_PIVOT, F.add_months(day, -1200)).otherwise(day)


def parse_text(c: Column) -> Column:
    return blank_to_null(c)


def unreadable(c: Column, kind: str) -> Column:
    """True where a cell has the shape of its kind but holds no value the type can carry."""
    t = F.trim(c)
    if kind == "count":
        return t.rlike(COUNT_SHAPE) & parse_count(c).isNull()
    if kind == "size":
        return t.rlike(SIZE_SHAPE) & parse_size(c).isNull()
    if kind == "installs":
        return _digits(c, "[^0-9]").isNotNull() & parse_installs(c).isNull()
    if kind == "price":
        return _digits(c, r"[^0-9\.]").isNotNull() & parse_price(c).isNull()
    if kind == "date":
        return t.rlike(DATE_SHAPE) & parse_date(c).isNull()
    raise ValueError(f"no shape for {kind!r}")


def _digits(c: Column, other: str) -> Column:
    return F.nullif(F.regexp_replace(F.trim(c), other, ""), F.lit(""))
