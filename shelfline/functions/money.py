"""Money expressions (3.9, 3.10, 3.14, 3.19).

Two-decimal rounding is half-to-even on ``x * 100`` (``rint``), which is what a
NumPy/pandas ``round(2)`` does; Spark's ``round`` rounds half up instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c) -> Column:
    return F.rint(_col(c) * 100) / 100


def discounted_price(price, discount_pct) -> Column:
    """``round2(price * (1 - coalesce(discount, 0) / 100))``."""
    return round2(_col(price) * (1 - F.coalesce(_col(discount_pct), F.lit(0.0)) / 100))


def discount_amount(gross, net) -> Column:
    return round2(_col(gross) - _col(net))


def to_money(c, precision: int = 14, scale: int = 2) -> Column:
    """Coerce into a warehouse decimal; overflow raises under ANSI, as a typed insert would."""
    return _col(c).cast(f"decimal({precision},{scale})")


def to_int_rounded(c) -> Column:
    """Float -> int the way a database insert does: halves away from zero, not truncation."""
    return F.round(_col(c), 0).cast("int")
