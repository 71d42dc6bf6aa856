"""Date expressions.

Every data-dependent conversion uses a ``try_*`` form so that the result is the
same with ``spark.sql.ansi.enabled`` on or off: unreadable text gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.catalog import COMPACT_PATTERN, DATE_INPUT_PATTERNS, DATE_TEXT_PATTERN
from carelake.functions.numbers import to_int


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_date(c: str | Column, pattern: str = DATE_TEXT_PATTERN) -> Column:
    """Text in ``dd/MM/yyyy`` -> date; anything else -> null (texts not of the
    pattern's shape are not handed to the parser)."""
    c = _c(c)
    return F.when(_fits(c, pattern), F.try_to_date(c, pattern))


def _fits(text: Column, pattern: str) -> Column:
    """Whether the text has the pattern's separators, and a letter where the pattern
    names the month.  A failed parse is costly (an exception per row), so a pattern is
    only tried on texts that hold what it cannot do without; lengths are left to the
    parser (days and times may have one digit), but for the two-digit date text."""
    needed = [text.contains(ch) for ch in "/-:" if ch in pattern]
    if "MMM" in pattern:
        needed.append(text.rlike("[A-Za-z]"))
    if pattern == DATE_TEXT_PATTERN:
        needed.append(F.length(text) == len(pattern))
    cond = text.isNotNull()
    for need in needed:
        cond = cond & need
    return cond


# year, month, day of a compact date: from the left, month and day take two digits where
# these name a month or a day and leave digits for what follows
COMPACT_DIGITS = r"^(\d{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9])$"


def compact_date(c: str | Column) -> Column:
    """``yyyyMMdd`` text -> timestamp; month and day may have one digit: ``2014115`` is
    5 November, ``201415`` 5 January, ``201411`` 1 January."""
    text = _c(c)
    parts = F.regexp_replace(text, COMPACT_DIGITS, "$1-$2-$3")
    return F.when(text.rlike(COMPACT_DIGITS), F.try_to_timestamp(parts, F.lit("yyyy-M-d")))


def parse_any_date(c: str | Column, patterns: list[str] | None = None) -> Column:
    """First pattern that reads the trimmed text wins; blank or unreadable -> null."""
    text = F.trim(_c(c).cast("string"))
    tries = [compact_date(text) if p == COMPACT_PATTERN else F.when(_fits(text, p), F.try_to_timestamp(text, F.lit(p)))
             for p in (patterns or DATE_INPUT_PATTERNS)]
    return F.coalesce(*tries).cast("date")


def date_text(d: str | Column, pattern: str = DATE_TEXT_PATTERN) -> Column:
    """Date -> ``dd/MM/yyyy`` text."""
    return F.date_format(_c(d), pattern)


def is_leap(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def remap_year(year: Column, min_year: int, max_year: int) -> Column:
    """Fold a year into the window: ``min + (year mod span)``."""
    span = max_year - min_year + 1
    return (F.lit(min_year) + F.pmod(year, F.lit(span))).cast("int")


def remap_date(d: str | Column, min_year: int, max_year: int) -> Column:
    """Move a date into the year window, keeping month and day.

    29 February moved to a non-leap year becomes 28 February.
    """
    d = _c(d)
    y = remap_year(F.year(d), min_year, max_year)
    m, day = F.month(d), F.dayofmonth(d)
    day = F.when((m == 2) & (day == 29) & ~is_leap(y), F.lit(28)).otherwise(day)
    return F.when(d.isNotNull(), F.make_date(y, m, day))


def delay_days(c: str | Column) -> Column:
    """Delay text -> days: missing -> 0, a number -> its whole part, other text -> null."""
    c = _c(c)
    return F.when(c.isNull(), F.lit(0)).otherwise(to_int(c))


def delay_date(start: str | Column, delay: str | Column) -> Column:
    """Event date = start date + delay days (missing delay counts as 0)."""
    return F.date_add(_c(start), delay_days(delay))


# where an event date comes from
AT_START, DELAYED = "stay_start", "delay"


def date_origin(delay: str | Column) -> Column:
    """Tells whether an event date came from a delay or is the stay start."""
    return F.when(_c(delay).isNull(), F.lit(AT_START)).otherwise(F.lit(DELAYED))
