"""Column helpers: each returns a ``Column`` built only from built-in Spark
functions, so every expression stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Fixed values that must equal the source system's conventions.
# Characters stripped from both ends of a category path level.
PATH_TRIM_CHARS = " $."
# Separator of category path levels.
PATH_SEPARATOR = "/"
# Separator inside surrogate item ids (source + ids).  The source system used "-"
# in the item dimension and "/" in the facts; one separator everywhere makes the
# dimension joinable.
ITEM_UUID_SEP = "/"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typed_null(data_type: DataType | str) -> Column:
    """An untyped ``NULL`` column of a union branch, given its target type."""
    return F.lit(None).cast(data_type)


def as_text(c: str | Column) -> Column:
    """``TO_VARCHAR`` / ``::text``."""
    return col_(c).cast("string")


def item_uuid(source: str, *ids: str | Column, sep: str = ITEM_UUID_SEP) -> Column:
    """Surrogate item id ``source<sep>id1<sep>id2``; null when any id is null."""
    parts: list[Column] = [F.lit(source)]
    for i in ids:
        parts += [F.lit(sep), as_text(i)]
    return F.concat(*parts)


def path_level(path: str | Column, n: int, trim_whole_first: bool = False) -> Column:
    """Level ``n`` (1-based) of a ``/`` path with ``' $.'`` stripped.

    ``trim_whole_first`` strips the whole path before splitting (the source's
    level-1 form); otherwise the split part is stripped.  A missing level is ``''``.
    """
    p = col_(path)
    trim = F.lit(PATH_TRIM_CHARS)
    sep, idx = F.lit(PATH_SEPARATOR), F.lit(n)
    if trim_whole_first:
        return F.split_part(F.btrim(p, trim), sep, idx)
    return F.btrim(F.split_part(p, sep, idx), trim)


def week_ending(d: str | Column) -> Column:
    """Last day of the week holding ``d``, weeks running Monday..Sunday."""
    return F.date_add(F.trunc(col_(d), "week"), 6)


def month_abbr(d: str | Column) -> Column:
    """Three-letter English month name."""
    return F.date_format(col_(d), "MMM")


def day_of_week0(d: str | Column) -> Column:
    """Day of week 0=Sunday..6=Saturday, as text."""
    return (F.dayofweek(col_(d)) - 1).cast("string")


def epoch_to_timestamp(c: str | Column) -> Column:
    """Epoch seconds to a zone-less timestamp (UTC wall clock)."""
    return F.timestamp_seconds(col_(c)).cast("timestamp_ntz")


def epoch_to_date(c: str | Column) -> Column:
    return F.to_date(epoch_to_timestamp(c))


def month_end(d: str | Column) -> Column:
    return F.last_day(col_(d))


def to_whole_number(c: str | Column) -> Column:
    """``NUMBER`` (scale 0): the cast rounds half away from zero."""
    return col_(c).cast("decimal(38,0)")


def percent(c: str | Column) -> Column:
    """Fraction to percent."""
    return col_(c) * F.lit(100)


def avg_to_bigint(c: str | Column) -> Column:
    """``CAST(AVG(c) AS BIGINT)`` with the source's half-away-from-zero rounding."""
    return F.round(F.avg(col_(c))).cast("bigint")


def non_blank(c: str | Column) -> Column:
    return F.length(F.trim(col_(c))) > 0
