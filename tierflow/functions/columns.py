"""Scalar column functions: permissive casts, conforming, money arithmetic.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; nothing here is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters stripped by the "trim all surrounding whitespace"
# conform step (space, tab, newline, carriage return, vertical tab, form feed).
WHITESPACE = " \t\n\r\x0b\x0c"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_to_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """String -> date; unparsable text becomes null instead of failing the job."""
    return F.try_to_date(col_of(c), fmt)


def safe_to_double(c) -> Column:
    return col_of(c).try_cast("double")


def safe_to_timestamp(c) -> Column:
    """String -> timestamp without zone (microseconds); bad text -> null."""
    return col_of(c).try_cast("timestamp_ntz")


def strip_all(c) -> Column:
    """Trim every kind of surrounding whitespace (plain ``trim`` only strips spaces)."""
    return F.btrim(col_of(c), F.lit(WHITESPACE))


def text_to_bool(c) -> Column:
    """'true' in any case -> true, other text -> false, null -> null."""
    return F.lower(col_of(c)) == F.lit("true")


def file_date(name_col, fmt: str = "yyyyMMdd") -> Column:
    """First 8-digit run of a file name parsed as a date (null when absent)."""
    return F.try_to_date(F.regexp_substr(col_of(name_col), F.lit(r"\d{8}")), fmt)


def to_money(c) -> Column:
    """Exact decimal view of a double amount; null where six decimals and
    fourteen digits before them do not hold it exactly (NaN included)."""
    d = col_of(c).try_cast("decimal(20,6)")
    return F.when(d.cast("double") == col_of(c).cast("double"), d)


def money_mul_round(a, b, scale: int = 2) -> Column:
    """round(a * b, scale), computed in decimal where both hold exactly and as
    doubles elsewhere: no amount, however large or odd, fails the job."""
    x, y = to_money(a), to_money(b)
    plain = F.round(col_of(a).cast("double") * col_of(b).cast("double"), scale)
    return F.when(x.isNotNull() & y.isNotNull(), F.round(x * y, scale).cast("double")).otherwise(plain)


def _inexact_sum(c) -> Column:
    """Aggregate: double sum of the amounts that ``to_money`` does not hold;
    null if there are none."""
    return F.sum(F.when(to_money(c).isNull(), col_of(c).cast("double")))


def money_sum_round(c, scale: int = 2) -> Column:
    """Aggregate: ROUND(SUM(c), scale) as double, exact in decimal for all
    amounts that decimals hold; others are added as doubles."""
    exact, rest = F.sum(to_money(c)), _inexact_sum(c)
    mixed = F.round(F.coalesce(exact.cast("double"), F.lit(0.0)) + rest, scale)
    return F.when(rest.isNull(), F.round(exact, scale).cast("double")).otherwise(mixed)


def half_up_quotient(num: Column, den: Column) -> Column:
    """Integral num/den rounded half away from zero, in exact decimal(38,0)
    arithmetic: q = (2|n| + d) div (2d), with the sign of n. Null when d = 0."""
    d = den.cast("decimal(38,0)")
    a = F.abs(num.cast("decimal(38,0)")) * 2 + d
    b = d * 2
    q = ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")
    return F.when(den == 0, F.lit(None).cast("decimal(38,0)")) \
        .when(num < 0, -q).otherwise(q)


def pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """ROUND(100 * part / whole, scale), exact half-up, as double."""
    unit = 10 ** scale
    q = half_up_quotient(part.cast("decimal(38,0)") * (100 * unit), whole)
    return (q.cast("double") / F.lit(float(unit)))


def money_avg_round(c, scale: int = 2) -> Column:
    """Aggregate: ROUND(AVG(c), scale), exact half-up over the decimal sum
    where decimals hold every amount, else the rounded double average."""
    micro = (F.sum(to_money(c)) * 1_000_000).cast("decimal(38,0)")  # exact: 6 decimals
    q = half_up_quotient(micro, F.count(col_of(c)) * (10 ** (6 - scale)))
    exact = q.cast("double") / F.lit(float(10 ** scale))
    return F.when(_inexact_sum(c).isNull(), exact).otherwise(F.round(F.avg(col_of(c).cast("double")), scale))
