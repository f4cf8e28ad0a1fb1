"""Small numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy(column: Column | str, digits: int = 6) -> Column:
    """Round for reporting and fold -0.0 into 0.0."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, digits) + F.lit(0.0)


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Division that yields NULL on a zero or NULL denominator in ANSI mode too."""
    top = F.col(top) if isinstance(top, str) else top
    bottom = F.col(bottom) if isinstance(bottom, str) else bottom
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def text_number(column: Column, *blanks: str, exact: bool = True) -> Column:
    """Number written as text; listed markers and the empty string mean NULL.

    ``exact=False`` rounds to whole numbers, the precision of a bare ``decimal`` cast.
    """
    value = F.nullif(F.trim(column), F.lit(""))
    for marker in blanks:
        value = F.nullif(value, F.lit(marker))
    return value.try_cast("decimal(18,6)" if exact else "decimal(10,0)")
