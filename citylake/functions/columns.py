"""Scalar column functions used by the operators and plans.

All are compositions of ``pyspark.sql.functions`` so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def snapshot_date(filename) -> Column:
    """Ten characters after the first ``_`` of a file name (``<prefix>_YYYY-MM-DD...``).

    With no ``_`` ``locate`` gives 0, so the first ten characters are taken; that is also what
    slicing from ``find('_') + 1`` gives when ``find`` returns -1.
    """
    fn = _c(filename)
    return F.substring(fn, F.locate("_", fn) + F.lit(1), F.lit(10))


def year_text(ts) -> Column:
    """First four characters of a timestamp's text form (the reference's ``substr(1, 4)``)."""
    return F.substring(_c(ts).cast("string"), 1, 4)


def to_double(c, mode: str = "strict") -> Column:
    """Text or number to double. ``strict`` fails on malformed text (ANSI cast), ``lenient`` gives NULL."""
    if mode == "strict":
        return _c(c).cast("double")
    if mode == "lenient":
        return _c(c).try_cast("double")
    raise ValueError(f"mode must be 'strict' or 'lenient', not {mode!r}")


def safe_ratio(num, den) -> Column:
    """``num / den`` with a zero (or NULL) denominator giving NULL, so ``avg`` skips it."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def array_count(c) -> Column:
    """Number of elements; NULL for a NULL array."""
    return F.array_size(_c(c))


def first_element(c) -> Column:
    """Element 0 of an array, NULL when the array is empty or NULL."""
    return F.try_element_at(_c(c), F.lit(1))
