"""Numbers in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# sign, whole part, point, digits; white space around
_DECIMAL = r"^\s*([+-]?)([0-9]*)\.[0-9]*\s*$"


def to_int(c: str | Column) -> Column:
    """Number text -> int: ``'3'`` -> 3, decimal text is cut at the point (``'1.5'`` ->
    1, ``'2.0'`` -> 2, ``'01.0'`` -> 1); other text -> null (same with ANSI on or off).

    The second form is only computed for texts that are no plain integer.
    """
    c = F.col(c) if isinstance(c, str) else c
    whole = F.concat(F.regexp_extract(c, _DECIMAL, 1), F.lit("0"), F.regexp_extract(c, _DECIMAL, 2))
    return F.coalesce(c.try_cast("int"), F.when(c.rlike(_DECIMAL), whole.try_cast("int")))
