"""Scalar column expressions. All are built-in Spark functions, so they stay inside
whole-stage codegen; none needs a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted number grammar (checked after trimming) and the
# value an unreadable field becomes.
NUMBER_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
UNREADABLE = -1.0
HASH_RANGE = 4294967296  # 2^32: the portable hash lies in [0, 2^32)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_or(c, default: float = UNREADABLE) -> Column:
    """Read text as a double; anything outside the number grammar gives ``default``.

    No eval and no UDF: a regular expression guards ``try_cast``, so hex,
    underscores, ``nan``/``inf`` and expressions are unreadable, ``007`` is 7.
    """
    t = F.trim(_col(c))
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double")).otherwise(F.lit(float(default)))


def portable_hash(c, seed: int = 42) -> Column:
    """32-bit hash of ``seed|value`` from md5; identical in DuckDB
    (``('0x' || substr(md5('42|' || v::varchar), 1, 8))::bigint``)."""
    text = F.concat(F.lit(f"{seed}|"), _col(c).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def decimal_label(c, digits: int = 2) -> Column:
    """A number with fixed digits as text (printf style, no thousands commas).

    Rounds the double's exact value, ties to even, as C does: 51.25 is a tie (51.2), the
    double nearest to 0.15 lies below one (0.1). The scaled value is kept as an exact sum
    of two products (upper and lower half of the mantissa).
    """
    x = F.abs(_col(c).cast("double"))
    scale = float(10**digits)
    split = x * 134217729.0  # 2**27 + 1
    upper = split - (split - x)
    p, q = upper * scale, (x - upper) * scale
    whole = F.floor(x * scale).cast("double")
    whole = F.when((p - whole) + q < 0, whole - 1).otherwise(whole)
    rest = (p - (whole + 0.5)) + q
    up = F.when(rest > 0, 1.0).when(rest < 0, 0.0).otherwise(F.pmod(whole, F.lit(2.0)))
    size = F.when(x < 1e15 / scale, (whole + up) / scale).otherwise(x)
    text = F.format_string(f"%.{digits}f", size)
    return F.when(x.isNotNull(), F.concat(F.when(_col(c) < 0, "-").otherwise(""), text))


def percent_label(c, digits: int = 1) -> Column:
    """Share in percent as text, e.g. ``51.3%``."""
    return F.concat(decimal_label(c, digits), F.lit("%"))


def relative_gain(worst, best) -> Column:
    """(worst - best) / worst * 100; NULL when worst is 0."""
    w, b = _col(worst), _col(best)
    return (w - b) / F.nullif(w, F.lit(0.0)) * F.lit(100.0)


def r6(c) -> Column:
    """Round to 6 digits: the precision at which results are compared."""
    return F.round(_col(c), 6)
