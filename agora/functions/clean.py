"""Column cleaners for all-text raw inputs (scalar functions C1-C27).

Every helper returns a Catalyst ``Column``: no Python runs per row, the
expressions stay inside whole-stage codegen and push through projections.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Missing-value markers used by the source files.
BLANK = ""
NOT_AVAILABLE = "NA"          # crime and election files
STAT_SECRECY = "S"            # statistical secrecy in the socio-demographic file
SENTINELS_NA = (BLANK, NOT_AVAILABLE)
SENTINELS_SECRET = (BLANK, STAT_SECRECY)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: ColumnOrName) -> Column:
    """TRIM: strips spaces only (tabs stay), as SQL TRIM does."""
    return F.trim(_col(c))


def null_if_in(c: ColumnOrName, sentinels: Iterable[str]) -> Column:
    """Nested NULLIF: any sentinel value becomes NULL."""
    c = _col(c)
    sentinels = list(sentinels)
    if not sentinels:
        return c
    return F.when(c.isin(sentinels), F.lit(None).cast("string")).otherwise(c)


def _to_double(c: Column, on_error: str) -> Column:
    if on_error == "null":
        return c.try_cast("double")
    if on_error == "fail":
        return c.cast("double")
    raise ValueError(f"on_error must be 'null' or 'fail', got {on_error!r}")


def clean_double(c: ColumnOrName, sentinels: Sequence[str] = SENTINELS_NA,
                 decimal_comma: bool = True, on_error: str = "null") -> Column:
    """trim -> sentinels to NULL -> ',' to '.' -> double.

    ``on_error='null'`` turns text that is not a number into NULL (the
    documented intent); ``'fail'`` raises like a strict CAST.
    """
    s = null_if_in(trim_spaces(c), sentinels)
    if decimal_comma:
        s = F.replace(s, F.lit(","), F.lit("."))
    return _to_double(s, on_error)


def clean_int(c: ColumnOrName, sentinels: Sequence[str] = SENTINELS_SECRET,
              on_error: str = "null") -> Column:
    """trim -> sentinels to NULL -> double -> int (truncates toward zero).

    No comma replacement on purpose: the integer cleaner of the source
    pipeline has none, so '12,5' is not a number here.
    """
    d = _to_double(null_if_in(trim_spaces(c), sentinels), on_error)
    return d_to_int(d, on_error)


def d_to_int(c: ColumnOrName, on_error: str = "null") -> Column:
    """DOUBLE -> INTEGER by truncation; out-of-range values become NULL
    (``on_error='null'``) or raise (``'fail'``)."""
    c = _col(c)
    return c.try_cast("int") if on_error == "null" else c.cast("int")


def pct_guarded(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``den = 0 -> 0`` else ``num * 100 / den``; a NULL denominator gives NULL."""
    num, den = _col(num).cast("double"), _col(den).cast("double")
    return F.when(den == 0, F.lit(0.0)).otherwise(num * 100.0 / den)


def rate_if_positive(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``den > 0 -> num * 100 / den`` else NULL (zero and NULL alike)."""
    num, den = _col(num).cast("double"), _col(den).cast("double")
    return F.when(den > 0, num * 100.0 / den)


def ratio_if_positive(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``den > 0 -> num / den`` else NULL: a [0..1] ratio with the same guard."""
    num, den = _col(num).cast("double"), _col(den).cast("double")
    return F.when(den > 0, num / den)


def count_missing(cols: Iterable[ColumnOrName]) -> Column:
    """Number of NULL values among ``cols`` in the row."""
    terms = [F.when(_col(c).isNull(), 1).otherwise(0) for c in cols]
    return reduce(lambda a, b: a + b, terms)


def pct_to_ratio(c: ColumnOrName) -> Column:
    """Percent -> [0..1]."""
    return _col(c).cast("double") / 100.0


def null_safe_sum(cols: Iterable[ColumnOrName]) -> Column:
    """``COALESCE(a,0) + COALESCE(b,0) + ...``"""
    terms = [F.coalesce(_col(c), F.lit(0)) for c in cols]
    return reduce(lambda a, b: a + b, terms)


def norm_name(c: ColumnOrName) -> Column:
    """``UPPER(TRIM(x))``, the join key for names."""
    return F.upper(F.trim(_col(c)))


def prefix_in(c: ColumnOrName, prefixes: Iterable[str]) -> Column:
    """``SUBSTR(c, 1, n) IN (...)`` written as an OR of ``startswith``.

    The ``startswith`` form reaches the Parquet reader as
    ``StringStartsWith`` filters; the ``substr`` form does not.  A NULL
    code never matches.
    """
    c = _col(c)
    terms = [c.startswith(p) for p in prefixes]
    if not terms:
        return F.lit(False)
    return reduce(lambda a, b: a | b, terms)


def code_to_label(c: ColumnOrName, mapping: dict[str, str], default: str) -> Column:
    """Simple CASE: code -> label with a default for unknown codes."""
    c = _col(c)
    expr = None
    for code, label in mapping.items():
        expr = F.when(c == code, label) if expr is None else expr.when(c == code, label)
    if expr is None:
        return F.lit(default)
    return expr.otherwise(default)


def typed_null(data_type: str) -> Column:
    """A NULL placeholder with a real type (never ``void``)."""
    return F.lit(None).cast(data_type)
