"""Scalar column functions used by the cleaners and the effect model.

Each returns a ``Column``; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hex_id(col) -> Column:
    """Lower-case hex of a binary (or string) id; binary ids are not UTF-8."""
    return F.lower(F.hex(_c(col)))


def safe_int(col) -> Column:
    """Cast to bigint, NULL when the value does not parse ('1.5' -> NULL)."""
    return _c(col).try_cast("bigint")


def safe_double(col) -> Column:
    return _c(col).try_cast("double")


def round_double(col, digits: int = 2) -> Column:
    """``round(safe_cast(x as double), digits)``."""
    return F.round(safe_double(col), digits)


def parse_date(col, fmt: str = "yyyy-M-d") -> Column:
    """Lenient date parse: NULL on a bad date instead of an error.  Of the default
    format, ``dddd-dd-dd`` is a plain cast, several times as fast as a formatter."""
    parsed = F.try_to_date(_c(col), fmt)
    if fmt != "yyyy-M-d":
        return parsed
    plain = _c(col).cast("string").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
    return F.when(plain, _c(col).try_cast("date")).otherwise(parsed)


def trim_ws(col) -> Column:
    """Strip leading/trailing white space of any kind, Unicode's included
    (tabs, newlines, no-break spaces).  Text whose first and last characters are
    visible ASCII has none to strip and is not searched."""
    c = _c(col)
    bare = F.ascii(c).between(33, 126) & F.ascii(F.right(c, F.lit(1))).between(33, 126)
    return F.when(bare, c).otherwise(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))


def clamp_nonneg(col) -> Column:
    """``greatest(0, x)`` that keeps NULL as NULL (Spark's greatest skips NULL)."""
    c = _c(col)
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), c))


def no_neg_zero(col) -> Column:
    """Turn -0.0 into +0.0 (IEEE: -0.0 + 0.0 == +0.0)."""
    return _c(col) + F.lit(0.0)


def code_to_name(col, mapping: Mapping[str, str]) -> Column:
    """Simple CASE code -> name; unknown codes map to NULL."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return m[_c(col)]


def band(col, cuts: Sequence[tuple[str, float, str]], otherwise: str) -> Column:
    """Searched CASE over thresholds, evaluated in order.

    ``cuts`` holds ``(op, threshold, label)`` with op one of ``>=``, ``>``,
    ``<=``, ``<``.  A NULL value falls through to ``otherwise``, like SQL CASE.
    """
    c = _c(col)
    ops = {">=": c.__ge__, ">": c.__gt__, "<=": c.__le__, "<": c.__lt__}
    expr = None
    for op, thr, label in cuts:
        cond = ops[op](F.lit(float(thr)))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise)) if expr is not None else F.lit(otherwise)


def round_half_up(col, digits: int) -> Column:
    """Deterministic half-up rounding: snap to 9 digits, then round with
    plain IEEE arithmetic.  Gives the same result on any engine even when
    inputs differ in the last ulp (``round`` implementations do not)."""
    y = F.round(_c(col), 9)
    scale = F.lit(float(10**digits))
    r = F.floor(y * scale + F.lit(0.5)).cast("double") / scale
    return F.when(F.isnan(y) | (F.abs(y) >= F.lit(1e12)), y).otherwise(r) + F.lit(0.0)
