"""Currency conversion with a per-currency fallback rate.

Semantics (rate table keyed by (date, currency)):

* direct: left join on (event date, currency);
* ``fallback="last_row"``: a missing rate is filled with the rate found on the
  *latest event date of that currency among the converted rows*, even if that
  rate is itself null (what the reference code computes);
* ``fallback="last_known"``: filled with the rate of the latest event date of
  that currency whose rate is known (what the reference comment describes);
* ``fallback=None``: no fill.

Scale: instead of a window partitioned by currency (a handful of currencies
would put whole currencies into single tasks), the fallback is one grouped
aggregate (``max_by`` with map-side partial aggregation) producing one row per
currency with a usable rate, which is joined back; Spark picks the join from
sizes. It needs only how many rows each currency has on each day, a small table
that a daily job keeps (``day_counts``) and brings up to date, so that only rows
whose rate has changed are converted again (``converted_anew``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import money_mul_round


def day_counts(tx: DataFrame, date_col: str = "event_date", currency_col: str = "currency") -> DataFrame:
    """``(currency, day, n)``: rows of each currency on each day."""
    return tx.groupBy(F.col(currency_col).alias("currency"), F.col(date_col).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def fallback_rates(days: DataFrame, rates: DataFrame, fallback: str = "last_row", *, currency_col: str = "currency",
                   rate_date_col: str = "rate_date", rate_col: str = "rate_to_bob") -> DataFrame:
    """``(currency, rate)``: the fallback of every currency that has one
    (``none``: of no currency)."""
    if fallback not in ("last_row", "last_known", "none"):
        raise ValueError(f"unknown fallback {fallback!r}")
    r = rates.select(F.col(rate_date_col).alias("__rdate"), F.col(currency_col).alias("__rccy"), F.col(rate_col).alias("__rate"))
    days = days.select("currency", "day").join(r, (F.col("day") == F.col("__rdate")) & (F.col("currency") == F.col("__rccy")), "left")
    if fallback == "none":
        days = days.where("false")
    if fallback == "last_known":
        days = days.where(F.col("__rate").isNotNull())
    return days.groupBy("currency").agg(F.max_by("__rate", "day").alias("rate")).where(F.col("rate").isNotNull())


def converted_anew(rest: DataFrame, rates: DataFrame, filled: DataFrame, old_rates: DataFrame, old_filled: DataFrame, *,
                   date_col: str = "event_date", currency_col: str = "currency", rate_date_col: str = "rate_date",
                   rate_col: str = "rate_to_bob") -> DataFrame:
    """The rows of ``rest`` whose rate is not what it was: their day's own rate
    came, went or changed, or they have none and their currency's fallback did."""
    columns = [rate_date_col, currency_col, rate_col]
    now, then = rates.select(*columns), old_rates.select(*columns)
    days = now.exceptAll(then).unionByName(then.exceptAll(now)).select(F.col(rate_date_col).alias("__d"), F.col(currency_col).alias("__c")).distinct()
    moved = filled.exceptAll(old_filled).unionByName(old_filled.exceptAll(filled)).select(F.col("currency").alias("__c")).distinct()
    own = now.where(F.col(rate_col).isNotNull()).select(F.col(rate_date_col).alias("__d"), F.col(currency_col).alias("__c"))

    def on(r: DataFrame):
        return (rest[date_col] == r["__d"]) & (rest[currency_col] == r["__c"])
    direct = rest.join(days, on(days), "left_semi")
    other = rest.join(moved, rest[currency_col].eqNullSafe(moved["__c"]), "left_semi")
    return direct.unionByName(other.join(days, on(days), "left_anti").join(own, on(own), "left_anti"))


def attach_rates(tx: DataFrame, rates: DataFrame, *, date_col: str = "event_date",
                 currency_col: str = "currency", rate_date_col: str = "rate_date",
                 rate_col: str = "rate_to_bob", fallback: str | None = "last_row",
                 filled: DataFrame | None = None) -> DataFrame:
    """``tx`` with its rate; ``filled`` is the fallback rate of each currency, if
    it is known already."""
    r = rates.select(F.col(rate_date_col).alias("__rdate"), F.col(currency_col).alias("__rccy"),
                     F.col(rate_col).alias("__rate"))
    joined = tx.join(r, (tx[date_col] == r["__rdate"]) & (tx[currency_col] == r["__rccy"]),
                     "left").drop("__rdate", "__rccy")
    if fallback is None:
        return joined.withColumnRenamed("__rate", rate_col)
    if filled is None:
        filled = fallback_rates(day_counts(tx, date_col, currency_col), rates, fallback, currency_col=currency_col,
                                rate_date_col=rate_date_col, rate_col=rate_col)
    per_ccy = filled.select(F.col("currency").alias("__fccy"), F.col("rate").alias("__fallback"))
    # only currencies with a usable fallback are joined; AQE splits a hot currency's partition
    out = joined.join(per_ccy, joined[currency_col].eqNullSafe(per_ccy["__fccy"]), "left")
    return out.withColumn(rate_col, F.coalesce(F.col("__rate"), F.col("__fallback"))) \
              .drop("__rate", "__fallback", "__fccy")


def convert(tx: DataFrame, rates: DataFrame, *, amount_col: str = "amount",
            out_col: str = "amount_bob", keep_rate: bool = False, **kw) -> DataFrame:
    rate_col = kw.get("rate_col", "rate_to_bob")
    out = attach_rates(tx, rates, **kw).withColumn(out_col, money_mul_round(amount_col, rate_col))
    return out if keep_rate else out.drop(rate_col)
