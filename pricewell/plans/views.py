"""BI views and analytical queries over the star schema, as DataFrame plans.

No join is hinted: dimension tables are read from files, so Spark knows their sizes and broadcasts
what is below the session's threshold; above it AQE decides. Every function takes a
:class:`~pricewell.plans.load.Warehouse` and returns a lazy DataFrame.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import date_key as key_of
from ..functions import guarded_ratio
from ..operators import measures as M
from ..operators.joins import bounded_list
from ..operators.metrics import TRADING_DAYS
from .load import Warehouse


def _dims(wh: Warehouse):
    return (wh.dim_instrument.select("instrument_key", "ticker", "company_name"),
            wh.dim_sector.select("sector_key", "sector_name"), wh.dim_date)


def fact_rows_between(wh: Warehouse, first: Column, last: Column) -> DataFrame:
    """Fact rows with date keys from ``first`` to ``last``: the year folders are pruned, the row
    groups by the key's statistics. The bounds may be scalar subqueries."""
    fact = wh.fact_daily_price
    return fact.filter(F.col("fact_year").between((first / 10000).cast("int"), (last / 10000).cast("int"))
                       & F.col("date_key").between(first, last))


def star(wh: Warehouse, fact: DataFrame | None = None) -> DataFrame:
    """Fact joined to instrument, sector and date (inner): the dashboard's fact set."""
    inst, sec, day = _dims(wh)
    fact = (wh.fact_daily_price if fact is None else fact).drop("fact_year", "fact_bucket")
    for dim, key in ((inst, "instrument_key"), (sec, "sector_key"),
                     (day.select("date_key", "full_date", "year", "quarter", "month"), "date_key")):
        fact = fact.join(bounded_list(dim), key)
    return fact


def instrument_latest(wh: Warehouse) -> DataFrame:
    """vw_instrument_latest: per instrument its newest fact row.

    The newest date of each instrument is a hash aggregate on one integer; its result, a row per
    instrument, is joined back to the fact on the fact's key.
    """
    fact = wh.fact_daily_price
    newest = fact.groupBy("instrument_key").agg(F.max("date_key").alias("date_key"))
    rows = fact.join(newest, ["instrument_key", "date_key"])
    return star(wh, rows).select("ticker", "company_name", "sector_name", "full_date", "close_price", "daily_return",
                                 "ma_20", "ma_50", "volatility_20d")


# Levels whose key the fact holds: the table with the name, and the key.
LEVELS = {"ticker": ("dim_instrument", "instrument_key"), "sector_name": ("dim_sector", "sector_key")}


def latest_measure(wh: Warehouse, measure, level: str = "ticker") -> DataFrame:
    """``measures.latest_close`` or ``price_vs_ma50`` per ticker or sector, aggregated by key below
    the join: the fact is read once and its few results are given names."""
    table, key = LEVELS[level]
    # (instrument_key, date_key) is the fact's key, checked before each commit
    found = measure(wh.fact_daily_price, [key], one_a_day=key == "instrument_key")
    names = getattr(wh, table).select(key, level)
    return found.join(names, key).select(level, *[c for c in found.columns if c != key])


def instrument_drilldown(wh: Warehouse, ticker: str | None = None, days: int = 365) -> DataFrame:
    """Close and moving averages over each instrument's trailing ``days`` (or one ticker's).

    The last day of each instrument needs the keys only; the earliest of the days wanted then prunes
    year folders and row groups of the second read, and each instrument's own bound filters its rows.
    """
    inst, sec, _ = _dims(wh)
    fact = wh.fact_daily_price
    if ticker is not None:
        inst = inst.filter(F.col("ticker") == ticker)
        fact = fact.join(inst.select("instrument_key"), "instrument_key", "left_semi")
    last = fact.groupBy("instrument_key").agg(F.max("date_key").alias("_last"))

    def day(key: str) -> Column:
        k = F.col(key)
        return F.make_date((k / 10000).cast("int"), (k / 100).cast("int") % 100, k % 100)

    bounds = last.select("instrument_key", key_of(F.date_sub(day("_last"), days)).alias("_since"))
    least = bounds.agg(F.min("_since")).scalar()
    rows = fact.filter((F.col("fact_year") >= (least / 10000).cast("int")) & (F.col("date_key") >= least))
    return (rows.join(bounds, "instrument_key").filter(F.col("date_key") >= F.col("_since"))
            .join(inst.select("instrument_key", "ticker"), "instrument_key").join(sec, "sector_key")
            .select("ticker", "sector_name", day("date_key").alias("full_date"), "close_price", "ma_20", "ma_50"))


def sector_monthly(wh: Warehouse) -> DataFrame:
    """vw_sector_monthly."""
    return (star(wh).groupBy("sector_name", "year", "quarter", "month")
            .agg(F.avg("daily_return").alias("avg_daily_return"),
                 F.avg("volatility_20d").alias("avg_volatility"),
                 F.sum(F.col("close_price") * F.col("volume")).alias("traded_value"),
                 F.count(F.lit(1)).alias("price_rows")))


def data_quality(wh: Warehouse) -> DataFrame:
    """vw_data_quality: one row per load run with the reject rate."""
    r = wh.etl_load_run
    return r.select("load_run_id", "started_at", "finished_at", "status", "rows_read", "rows_loaded",
                    "rows_rejected", guarded_ratio("rows_rejected", "rows_read").alias("reject_rate"))


def sector_year_return(wh: Warehouse) -> DataFrame:
    """Annualised return and average volatility by sector and year."""
    return (star(wh).groupBy("sector_name", "year")
            .agg((F.avg("daily_return") * TRADING_DAYS).alias("annualised_return"),
                 F.avg("volatility_20d").alias("avg_volatility"))
            .orderBy("year", F.desc("annualised_return")))


def golden_crosses(wh: Warehouse) -> DataFrame:
    """Every day the 20-day average is above the 50-day average after being at or below it on the
    instrument's previous fact row; the stored averages are compared as they are."""
    series = Window.partitionBy("instrument_key").orderBy("date_key")
    above = F.col("ma_20") > F.col("ma_50")
    rows = (wh.fact_daily_price.select("instrument_key", "date_key", "close_price", "ma_20", "ma_50")
            .withColumn("_was_above", F.lag(above).over(series)).filter(above & ~F.col("_was_above")))
    inst, _, day = _dims(wh)
    return (rows.join(inst, "instrument_key").join(day.select("date_key", "full_date"), "date_key")
            .select("ticker", "full_date", "close_price", "ma_20", "ma_50"))


def golden_cross(wh: Warehouse, top: int = 20) -> DataFrame:
    """The ``top`` newest golden crosses (ties broken by ticker)."""
    return golden_crosses(wh).orderBy(F.desc("full_date"), "ticker").limit(top)


def quarter_bounds(wh: Warehouse, year: int | None = None, quarter: int | None = None) -> tuple[Column, Column]:
    """First and last date key of a quarter, by default the newest in the calendar dimension (it
    holds the days of the facts, so the fact is not read for it)."""
    if year is not None and quarter is not None:
        return F.lit(year * 10000 + quarter * 300 - 199), F.lit(year * 10000 + quarter * 300 + 31)
    days = wh.dim_date
    if year is not None:
        days = days.filter(F.col("year") == year)
    if quarter is not None:
        days = days.filter(F.col("quarter") == quarter)
    at = days.agg(F.max(F.col("year") * 10 + F.col("quarter")).alias("q"))
    start = (F.floor(F.col("q") / 10) * 10000 + (F.col("q") % 10) * 300).cast("int")
    return at.select(start - 199).scalar(), at.select(start + 31).scalar()


def most_volatile(wh: Warehouse, year=None, quarter=None, top: int = 10) -> DataFrame:
    """Top instruments by average volatility in one quarter (default: newest in the data)."""
    rows = star(wh, fact_rows_between(wh, *quarter_bounds(wh, year, quarter)))
    return (rows.groupBy("ticker", "sector_name").agg(F.avg("volatility_20d").alias("avg_vol"))
            .orderBy(F.desc_nulls_last("avg_vol"), "ticker").limit(top))


def trace_run(wh: Warehouse, ticker: str | None = None, date_key: int | Column | None = None) -> DataFrame:
    """Traceability: the run behind each fact row asked for, and when it finished."""
    fact = wh.fact_daily_price
    if date_key is not None:
        day = F.lit(date_key) if isinstance(date_key, int) else date_key
        fact = fact_rows_between(wh, day, day)
    inst, _, _ = _dims(wh)
    if ticker is not None:
        inst = inst.filter(F.col("ticker") == ticker)
    return (fact.select("instrument_key", "date_key", "load_run_id").join(inst, "instrument_key")
            .join(wh.etl_load_run.select("load_run_id", "finished_at"), "load_run_id")
            .select("ticker", "date_key", "load_run_id", "finished_at"))


def trace_files(wh: Warehouse, ticker: str | None = None, date_key: int | Column | None = None) -> DataFrame:
    """The runs behind the fact rows asked for, one row per run and file it read. For all rows the
    commit's own list of runs in each part answers, and the fact is not read."""
    if ticker is None and date_key is None:
        ledger = wh.etl_load_run.select("load_run_id", "finished_at")
        runs = wh.fact_run.select("load_run_id").distinct().join(ledger, "load_run_id")
    else:
        runs = trace_run(wh, ticker, date_key).select("load_run_id", "finished_at").distinct()
    return runs.join(wh.etl_run_file, "load_run_id").select("load_run_id", "finished_at", "source_file")


def latest_successful_run(wh: Warehouse):
    """Scalar-subquery column: the newest SUCCEEDED run id."""
    return wh.etl_load_run.filter(F.col("status") == "SUCCEEDED").agg(F.max("load_run_id")).scalar()


def reject_drilldown(wh: Warehouse) -> DataFrame:
    """Rejected rows of the latest successful run by file and reason string."""
    return (wh.etl_rejected_row.filter(F.col("load_run_id") == latest_successful_run(wh))
            .groupBy("source_file", "reject_reason").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "source_file", "reject_reason"))


def drilldown_rollup(wh: Warehouse) -> DataFrame:
    """Sector -> instrument drill-down with subtotals (rollup) and the grouping level."""
    return (star(wh).rollup("sector_name", "ticker")
            .agg(F.grouping_id().cast("int").alias("level"),
                 F.avg("daily_return").alias("avg_daily_return"),
                 F.sum(F.col("close_price") * F.col("volume")).alias("traded_value"),
                 F.count(F.lit(1)).alias("price_rows")))


def calendar_rollup(wh: Warehouse) -> DataFrame:
    """Year -> quarter -> month drill-down with subtotals (rollup) and the grouping level."""
    return (star(wh).rollup("year", "quarter", "month")
            .agg(F.grouping_id().cast("int").alias("level"),
                 F.avg("daily_return").alias("avg_daily_return"),
                 F.avg("volatility_20d").alias("avg_volatility"),
                 F.count(F.lit(1)).alias("price_rows")))
