"""Key and identifier expressions.

All keys are built with ``concat_ws``, which skips null parts: ``(a, null, b)`` and
``(a, b)`` print the same key.  That behaviour is kept on purpose (ids must equal the
ones the source system prints); ``plans.quality.key_collisions`` reports the cases.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.catalog import DCIR_KEY_COLS


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def visit_id(family: str, *key_cols: str | Column, ace: bool = False,
             year_col: str | Column = "YEAR") -> Column:
    """Hospital visit key ``<family>_<YY>[_ace]_<key>...`` (e.g. ``mco_22_123_456``)."""
    parts = [F.lit(family), _c(year_col)]
    if ace:
        parts.append(F.lit("ace"))
    parts.extend(_c(k) for k in key_cols)
    return F.concat_ws("_", *parts)


def flux_key(cols: list[str] | None = None) -> Column:
    """City-care claim-line key: the 9 flux columns joined by ``_`` in fixed order.

    A line with no flux part at all has no key (null, not ``''``): such lines would
    otherwise all share one key and every claim join would pair them all.
    """
    parts = [F.col(c) for c in (cols or DCIR_KEY_COLS)]
    return F.when(F.coalesce(*parts).isNotNull(), F.concat_ws("_", *parts))


def surrogate_id(*parts: str | Column) -> Column:
    """Row id: ``md5`` of the parts joined by ``_`` (dates print as ``yyyy-MM-dd``)."""
    return F.md5(F.concat_ws("_", *[_c(p) for p in parts]))


def stable_hash(*parts: str | Column) -> Column:
    """Non-negative 32-bit hash of the parts joined by ``|``.

    The first 8 hex digits of the md5 of the joined text, read as a number; a null
    part prints as ``nan`` (the text form a missing value takes in the source
    system).  Deterministic across engines, row orders and partitionings.
    """
    text = F.concat_ws("|", *[F.coalesce(_c(p).cast("string"), F.lit("nan")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def stable_year(parts: list[str | Column], min_year: int, max_year: int) -> Column:
    """Year in ``[min_year, max_year]`` chosen by ``stable_hash`` of the parts."""
    span = max_year - min_year + 1
    return (F.lit(min_year) + F.pmod(stable_hash(*parts), F.lit(span))).cast("int")


def two_digit_year(year: Column) -> Column:
    """``2022`` -> ``'22'`` (the hospital ``YEAR`` convention)."""
    return F.substring(year.cast("string"), 3, 2)
