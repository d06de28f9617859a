"""BI measures and dashboard data sets as grouped DataFrame aggregates.

A measure's "filter context" is simply the list of grouping keys, so each measure works for
any drill level (sector, instrument, year, ...).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import guarded_ratio
from .metrics import TRADING_DAYS


def basic_measures(star: DataFrame, keys: list[str]) -> DataFrame:
    """Avg Daily Return, Annualised Return, Avg Volatility (20d), Traded Value."""
    return (star.groupBy(*keys)
            .agg(F.avg("daily_return").alias("avg_daily_return"),
                 (F.avg("daily_return") * TRADING_DAYS).alias("annualised_return"),
                 F.avg("volatility_20d").alias("avg_volatility"),
                 F.sum(F.col("close_price") * F.col("volume")).alias("traded_value")))


def latest_values(rows: DataFrame, keys: list[str], one_a_day: bool = False, **values: str) -> DataFrame:
    """Per context its last ``date_key`` as last_date_key, and on that day the largest of each
    column named in ``values`` (alias -> column). The rows are read once: the largest a day, then
    those of the last day, both hash aggregates of numbers. ``one_a_day``: a context has at most one
    row a day, so the first is left out."""
    if one_a_day:
        per_day = rows.select(*keys, "date_key", *[F.col(c).alias(alias) for alias, c in values.items()])
    else:
        per_day = rows.groupBy(*keys, "date_key").agg(*[F.max(c).alias(alias) for alias, c in values.items()])
    return per_day.groupBy(*keys).agg(F.max("date_key").alias("last_date_key"),
                                      *[F.max_by(alias, "date_key").alias(alias) for alias in values])


def latest_close(rows: DataFrame, keys: list[str], **how) -> DataFrame:
    """Latest Close per context."""
    return latest_values(rows, keys, latest_close="close_price", **how)


def price_vs_ma50(rows: DataFrame, keys: list[str], **how) -> DataFrame:
    """Price vs MA50 %: latest close / latest 50-day average - 1 (NULL when the average is)."""
    last = latest_values(rows, keys, _close="close_price", _average="ma_50", **how)
    return last.select(*keys, "last_date_key", (F.try_divide("_close", "_average") - 1).alias("price_vs_ma50"))


def latest_run_card(ledger: DataFrame, rejects: DataFrame) -> DataFrame:
    """Latest Run Id, Latest Load Time, Rows Rejected and Reject Rate of the newest
    SUCCEEDED run (one row)."""
    run_id = ledger.filter(F.col("status") == "SUCCEEDED").agg(F.max("load_run_id")).scalar()
    run = ledger.filter(F.col("load_run_id") == run_id)
    n_rej = rejects.filter(F.col("load_run_id") == run_id).agg(F.count(F.lit(1))).scalar()
    return run.select(F.col("load_run_id").alias("latest_run_id"),
                      F.col("finished_at").alias("latest_load_time"),
                      "rows_read", "rows_loaded",
                      n_rej.alias("rows_rejected"),
                      guarded_ratio(n_rej, F.col("rows_read")).alias("reject_rate"))


def latest_reject_counts(ledger: DataFrame, rejects: DataFrame) -> DataFrame:
    """Rejected rows per rule for the newest SUCCEEDED run, with the run's overall reject rate."""
    run_id = ledger.filter(F.col("status") == "SUCCEEDED").agg(F.max("load_run_id")).scalar()
    run = ledger.filter(F.col("load_run_id") == run_id)
    rate = run.select(guarded_ratio("rows_rejected", "rows_read")).scalar()
    return (rejects.filter(F.col("load_run_id") == run_id)
            .select(F.explode(F.split("reject_reason", ";")).alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("reject_rate", rate)
            .orderBy(F.desc("n"), "reason"))


def sector_index(star: DataFrame) -> DataFrame:
    """Sector index rebased to 100: equal-weighted mean daily return per (sector, day), a day
    without returns counts as 0, compounded in date order.

    The compounding window is partitioned by sector; its partitions hold one row per trading
    day, so they are bounded by the calendar span.
    """
    daily = (star.groupBy("sector_name", "full_date")
             .agg(F.coalesce(F.avg("daily_return"), F.lit(0.0)).alias("sector_return")))
    w = Window.partitionBy("sector_name").orderBy("full_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("index_value", F.lit(100.0) * F.product(F.lit(1.0) + F.col("sector_return")).over(w))


def sector_stats(star: DataFrame) -> DataFrame:
    """Annualised mean return and mean volatility per sector, sorted by return."""
    return (star.groupBy("sector_name")
            .agg((F.avg("daily_return") * TRADING_DAYS).alias("annualised_return"),
                 F.avg("volatility_20d").alias("avg_volatility"))
            .orderBy("annualised_return"))
