"""Scalar expressions whose NULL, zero and rounding rules differ from Spark's defaults."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int) -> Column:
    """Round half away from zero on the decimal value of a double.

    A sum of doubles depends in its last bits on the order of the rows. The inner rounding removes
    that noise, so a mathematical tie is a tie in every run.
    """
    return F.round(F.round(col_of(c), digits + 6), digits)


def round_once(c: Column | str, digits: int) -> Column:
    """Round half away from zero, once: for values of a single row, which carry no summing noise."""
    return F.round(col_of(c), digits)


def _unless_any_null(cols: list[Column], value: Column) -> Column:
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cols])
    return F.when(~any_null, value)


def greatest_strict(*cols: Column) -> Column:
    """GREATEST that is NULL when any argument is (Spark's own skips NULLs)."""
    return _unless_any_null(list(cols), F.greatest(*cols))


def least_strict(*cols: Column) -> Column:
    return _unless_any_null(list(cols), F.least(*cols))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Quotient as double, NULL for a zero denominator."""
    num, den = col_of(num).cast("double"), col_of(den).cast("double")
    return num / F.nullif(den, F.lit(0.0))


def ratio_or(num: Column | str, den: Column | str, alternative: float = 0.0) -> Column:
    """Quotient with an alternative result where it is not defined."""
    return F.coalesce(ratio(num, den), F.lit(alternative))


def count_where(cond: Column) -> Column:
    """Rows where the condition holds; 0 (not NULL) for none."""
    return F.count(F.when(cond, F.lit(1)))


def share_where(cond: Column) -> Column:
    """Share of all rows of the group where the condition holds (NULL counts as not)."""
    return F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)))


def as_flag(cond: Column) -> Column:
    """Boolean with NULL read as false."""
    return F.coalesce(cond, F.lit(False))


def whole_years(days: Column | str) -> Column:
    from riskmart.constants import DAYS_PER_YEAR

    return F.floor(F.abs(col_of(days)).cast("double") / F.lit(DAYS_PER_YEAR)).cast("long")


def years_back(days: Column | str) -> Column:
    """Day offset to years before the application; a future offset comes out negative."""
    from riskmart.constants import DAYS_PER_YEAR

    return col_of(days).cast("double") / F.lit(-DAYS_PER_YEAR)


def record_key(*cols: Column | str) -> Column:
    """MD5 of the record's fields, each led by its length so that no two records run together; NULL is ``-``."""
    texts = [col_of(c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]))


def hash_unit(seed: int, *cols: Column | str) -> Column:
    """Uniform number in [0, 1) that depends only on the row's values and the seed."""
    h = F.xxhash64(F.lit(seed), *[col_of(c) for c in cols])
    return F.pmod(h, F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def case_ladder(value: Column, steps, last, *, below: bool = True) -> Column:
    """First label whose bound the value is under (or over); ``last`` otherwise and for NULL."""
    out = None
    for bound, label in steps:
        hit = value < F.lit(bound) if below else value > F.lit(bound)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(last))
