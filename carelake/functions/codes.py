"""Code, quantity and fallback expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.catalog import CIP13, CIP7, FIRST_UNIT, NO_CODE, UCD13, UCD7
from carelake.functions.dates import parse_date
from carelake.functions.numbers import to_int


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def int_equals(c: str | Column, value: int) -> Column:
    """Numeric equality on a text column: ``'01'`` and ``'1.0'`` equal 1, ``'x'`` nothing."""
    return to_int(c) == F.lit(value)


def quantity_or_one(c: str | Column) -> Column:
    """Quantity text -> int, missing or unreadable -> 1."""
    return F.coalesce(to_int(c), F.lit(1))


def pad_code(c: str | Column, width: int = 4) -> Column:
    """Numeric code -> zero-padded text of exactly ``width`` characters.

    Leading zeros are dropped by the int read, then padded back; longer codes are
    cut to ``width`` characters (``lpad`` truncates), non-numeric text -> null.
    """
    return F.lpad(to_int(c).cast("string"), width, "0")


def strip_zeros(c: str | Column) -> Column:
    """Remove leading zeros: ``'0001234'`` -> ``'1234'``, ``'000'`` -> ``''``
    (same result as removing the match of ``^0*``, without a regular expression)."""
    return F.ltrim(_c(c), F.lit("0"))


def cip_code(c13: str | Column, cip7: str | Column) -> Column:
    """Pharmacy code: the 13-digit code unless it is ``'0'``, then the 7-digit one."""
    c13, cip7 = _c(c13), _c(cip7)
    return F.when(c13 != NO_CODE, c13).when(cip7 != NO_CODE, cip7)


def cip_vocabulary(c13: str | Column, cip7: str | Column) -> Column:
    """Vocabulary that goes with ``cip_code``: ``CIP13``, ``CIP7`` or null."""
    c13, cip7 = _c(c13), _c(cip7)
    return F.when(c13 != NO_CODE, F.lit(CIP13)).when(cip7 != NO_CODE, F.lit(CIP7))


def ucd_vocabulary(code: str | Column) -> Column:
    """Hospital drug vocabulary by code length: 7 -> ``UCD7``, 13 -> ``UCD13``."""
    n = F.length(_c(code))
    return F.when(n == 7, F.lit(UCD7)).when(n == 13, F.lit(UCD13))


def facility(geo: str | Column, fallback: str | Column) -> Column:
    """Geographic facility when known, else the fallback facility number."""
    geo = _c(geo)
    return F.when(geo.isNotNull(), geo).otherwise(_c(fallback))


def unit_number(rum: str | Column, um: str | Column) -> Column:
    """Unit order number: ``RUM_ORD_NUM`` unless missing, then ``UM_ORD_NUM``."""
    rum = _c(rum)
    return F.when(rum.isNull(), _c(um)).otherwise(rum)


def first_unit(um: str | Column, rum: str | Column) -> Column:
    """First unit of a stay: ``RUM_ORD_NUM = '1'``, or ``UM_ORD_NUM = '1'`` when
    ``RUM_ORD_NUM`` is missing."""
    um, rum = _c(um), _c(rum)
    return ((um == FIRST_UNIT) & rum.isNull()) | (rum == FIRST_UNIT)


def device_end_date(typ: str | Column, end_text: str | Column, start_text: str | Column) -> Column:
    """End date by device line type: 3 -> its end date, 6 -> its start date, else null."""
    t = to_int(typ)
    return (F.when(t == 3, parse_date(end_text))
            .when(t == 1, F.lit(None).cast("date"))
            .when(t == 6, parse_date(start_text))
            .otherwise(F.lit(None).cast("date")))


def first_present(df: DataFrame, names: list[str]) -> str | None:
    """Name of the first column of ``names`` that ``df`` has (plan-time choice)."""
    for n in names:
        if n in df.columns:
            return n
    return None


def null_if_na(c: str | Column, tokens: list[str]) -> Column:
    """Missing-value tokens (``''``, ``NA``, ``null``...) -> null."""
    c = _c(c)
    return F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)
