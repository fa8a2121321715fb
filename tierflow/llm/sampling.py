"""Bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCALE = 1 << 30


def chance(*columns) -> Column:
    """A number from 0 to 2**30 - 1 that depends on the columns alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(_SCALE))


def at_most(df: DataFrame, bound: int, *columns: str) -> DataFrame:
    """About ``bound`` rows of ``df`` at most, chosen by a hash of ``columns``
    (all rows if there are no more than ``bound``). Deterministic; the rows of
    one hash go together, so a last limit of twice the bound guards against a
    value that repeats without end."""
    n = df.count()
    if n <= bound:
        return df
    return df.filter(chance(*columns) < int(_SCALE * bound / n)).limit(2 * bound)


def first_by_hash(df: DataFrame, bound: int, *columns: str) -> DataFrame:
    """The rows of ``df`` (all, or, beyond ``bound``, about so many of the lowest
    hashes of ``columns``), of which a value that repeats without end leaves
    twice the bound: the first by hash, then by ``columns``."""
    n = df.count()
    if n <= bound:
        return df
    few = df.filter(chance(*columns) < int(_SCALE * bound / n))
    return few.orderBy(chance(*columns), *columns).limit(2 * bound)
