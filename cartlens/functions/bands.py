"""Age bands as data: one table per scheme, one builder for the ``when`` chain.

A band is ``(label, upper, closed)``: the first band whose upper bound admits
the value wins (``value < upper``, or ``value <= upper`` when closed). The
last band has no bound and also takes nulls, as the chained ``when`` of the
source scripts does (a null comparison never takes a branch).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels and boundaries must equal the source's reports.
AGE_BANDS_7 = [
    ("Under 18", 18, False),
    ("18-24", 25, False),
    ("25-34", 35, False),
    ("35-44", 45, False),
    ("45-54", 55, False),
    ("55-64", 65, False),
    ("65+", None, False),
]
AGE_BANDS_4 = [
    ("Young", 25, False),
    ("Youth", 35, False),
    ("Middle-aged", 55, False),
    ("Senior", None, False),
]
AGE_BANDS_3 = [
    ("Under 35", 35, False),
    ("Between 35-50", 50, True),
    ("Over 50", None, False),
]

SCHEMES = {"age7": AGE_BANDS_7, "age4": AGE_BANDS_4, "age3": AGE_BANDS_3}


def _bands(scheme):
    return SCHEMES[scheme] if isinstance(scheme, str) else scheme


def band(value: Column | str, scheme="age7", null_band: str | None = None) -> Column:
    """Label of ``value`` in ``scheme``; nulls go to the last band unless
    ``null_band`` names another label."""
    value = F.col(value) if isinstance(value, str) else value
    bands = _bands(scheme)
    expr = None
    for label, upper, closed in bands[:-1]:
        cond = value <= upper if closed else value < upper
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    last = F.lit(bands[-1][0])
    if null_band is not None:
        expr = F.when(value.isNull(), null_band) if expr is None else expr.when(value.isNull(), null_band)
    return last if expr is None else expr.otherwise(last)


def band_order(label: Column | str, scheme="age7") -> Column:
    """Position (1-based) of a band label in its scheme; null for unknown labels."""
    label = F.col(label) if isinstance(label, str) else label
    pairs = []
    for i, (name, _, _) in enumerate(_bands(scheme), start=1):
        pairs += [F.lit(name), F.lit(i)]
    return F.try_element_at(F.create_map(*pairs), label)
