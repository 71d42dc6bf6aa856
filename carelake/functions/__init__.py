"""Column -> Column expressions: keys, dates, codes."""

from carelake.functions.codes import (
    cip_code,
    cip_vocabulary,
    device_end_date,
    facility,
    first_present,
    first_unit,
    int_equals,
    null_if_na,
    pad_code,
    quantity_or_one,
    strip_zeros,
    to_int,
    ucd_vocabulary,
    unit_number,
)
from carelake.functions.dates import (
    date_origin,
    date_text,
    delay_date,
    delay_days,
    parse_any_date,
    parse_date,
    remap_date,
    remap_year,
)
from carelake.functions.keys import (
    flux_key,
    stable_hash,
    stable_year,
    surrogate_id,
    two_digit_year,
    visit_id,
)

__all__ = [
    "cip_code", "cip_vocabulary", "date_origin", "date_text", "delay_date", "delay_days",
    "device_end_date", "facility", "first_present", "first_unit", "flux_key", "int_equals",
    "null_if_na", "pad_code", "parse_any_date", "parse_date", "quantity_or_one", "remap_date",
    "remap_year", "stable_hash", "stable_year", "strip_zeros", "surrogate_id", "to_int",
    "two_digit_year", "ucd_vocabulary", "unit_number", "visit_id",
]
