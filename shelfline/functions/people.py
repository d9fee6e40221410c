"""Customer expressions: full name, e-mail normalisation, age band (3.11-3.13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfline import config


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_name(first, last) -> Column:
    """Blank-safe ``first + ' ' + last``; both missing gives ``''``, not null."""
    return F.trim(F.concat_ws(" ", _col(first), _col(last)))


def email_normalise(c) -> Column:
    return F.lower(_col(c))


def age_band(c, bands=None, top: str | None = None) -> Column:
    """Bucket an age; the first band also takes anyone younger; null stays null."""
    age = _col(c)
    bands = bands or config.AGE_BANDS
    expr = None
    for upper, label in bands:
        expr = (F.when(age < upper, F.lit(label)) if expr is None
                else expr.when(age < upper, F.lit(label)))
    return expr.when(age.isNotNull(), F.lit(top or config.AGE_BAND_TOP))
