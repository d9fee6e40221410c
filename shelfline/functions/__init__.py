"""Column expressions (all built-in Spark functions, no UDFs)."""

from shelfline.functions.calendar import calendar_columns, iso_weekday
from shelfline.functions.money import (discount_amount, discounted_price, round2,
                                       to_int_rounded, to_money)
from shelfline.functions.people import age_band, email_normalise, full_name
from shelfline.functions.text import (as_text, lenient_date, lenient_double, lenient_long,
                                      trim_blank_null)

__all__ = [
    "age_band", "as_text", "calendar_columns", "discount_amount", "discounted_price",
    "email_normalise", "full_name", "iso_weekday", "lenient_date", "lenient_double",
    "lenient_long", "round2", "to_int_rounded", "to_money", "trim_blank_null",
]
