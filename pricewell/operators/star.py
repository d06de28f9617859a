"""Star-schema building: dimensions (insert-only), fact projection, range replace, checks.

Surrogate keys of new dimension members continue after the current maximum key, in the order of
the natural key (:func:`with_ordered_index`, no single-task window). "Insert if absent" is an anti
join on keys that are never NULL: tickers without text are no instruments, and instruments without
a sector belong to the member ``UNKNOWN_SECTOR``. No join is hinted; AQE and the session's
broadcast threshold choose from measured sizes.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_columns, date_key, lenient_date, normalise_ticker
from .joins import bounded_list, with_ordered_index

UNKNOWN_SECTOR = "Unknown"
DIM_SECTOR_COLS = ["sector_key", "sector_name"]
DIM_INSTRUMENT_COLS = ["instrument_key", "ticker", "company_name", "exchange", "sector_key", "listing_date"]
DIM_DATE_COLS = ["date_key", "full_date", "year", "quarter", "month", "month_name", "week_of_year",
                 "day_of_week", "day_name", "is_month_end"]
FACT_COLS = ["instrument_key", "date_key", "sector_key", "open_price", "high_price", "low_price",
             "close_price", "volume", "daily_return", "log_return", "ma_20", "ma_50", "volatility_20d",
             "load_run_id"]
METRIC_COLS = ["daily_return", "log_return", "ma_20", "ma_50", "volatility_20d"]


def normalise_reference(instruments: DataFrame) -> DataFrame:
    """Instrument reference with normalised, unique tickers and a sector for each.

    The same normalisation as the price feed, so every validated ticker finds its instrument. Rows
    without a ticker are left out: prices under it break ``unknown_instrument``. A ticker listed
    twice keeps its smallest (company_name, sector, exchange, listing_date).
    """
    best = F.min(F.struct("company_name", "sector", "exchange", "listing_date")).alias("_b")
    return (instruments.select(normalise_ticker("ticker").alias("ticker"), "company_name", "sector",
                               "exchange", "listing_date")
            .filter("ticker <> ''").groupBy("ticker").agg(best)
            .select("ticker", "_b.company_name",
                    F.coalesce(F.nullif(F.trim("_b.sector"), F.lit("")), F.lit(UNKNOWN_SECTOR)).alias("sector"),
                    "_b.exchange", "_b.listing_date"))


def _next_key_start(existing: DataFrame | None, key: str):
    if existing is None:
        return 0
    return F.coalesce(existing.agg(F.max(key)).scalar(), F.lit(0))


def dim_sector_new(reference: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New sectors (not yet in ``existing``), keys appended in name order."""
    names = reference.select(F.col("sector").alias("sector_name")).distinct()
    if existing is not None:
        names = names.join(existing.select("sector_name"), "sector_name", "left_anti")
    return with_ordered_index(names, ["sector_name"], "sector_key",
                              _next_key_start(existing, "sector_key")).select(*DIM_SECTOR_COLS)


def dim_instrument_new(reference: DataFrame, dim_sector: DataFrame,
                       existing: DataFrame | None = None) -> DataFrame:
    """New instruments (type-0: existing tickers are never updated), keys in ticker order. Every
    instrument stays; one whose sector has no key would show in the integrity checks."""
    new = reference
    if existing is not None:
        new = new.join(existing.select("ticker"), "ticker", "left_anti")
    sectors = dim_sector.select(F.col("sector_name").alias("sector"), "sector_key")
    new = (new.join(sectors, "sector", "left")
           .select("ticker", "company_name", "exchange", "sector_key",
                   lenient_date("listing_date").alias("listing_date")))
    return with_ordered_index(new, ["ticker"], "instrument_key",
                              _next_key_start(existing, "instrument_key")).select(*DIM_INSTRUMENT_COLS)


def dim_date_new(dates: DataFrame, existing: DataFrame | None = None, col: str = "trade_date") -> DataFrame:
    """Calendar rows for dates seen in the facts and not yet in ``existing`` (no gap filling)."""
    days = dates.select(F.col(col).alias("_d")).distinct().select(
        *[c.alias(n) for n, c in calendar_columns("_d").items()])
    if existing is not None:
        days = days.join(existing.select("date_key"), "date_key", "left_anti")
    return days.select(*DIM_DATE_COLS)


def fact_rows(metrics: DataFrame, dim_instrument: DataFrame, run_id) -> DataFrame:
    """Fact projection: keys by ticker, date key, renamed prices, run id.

    A left join, so no price is lost: one without an instrument keeps NULL keys and fails the
    integrity checks. ``sector_key`` is taken from the instrument dimension (denormalised at load
    time).
    """
    keys = bounded_list(dim_instrument.select("ticker", "instrument_key", "sector_key"))
    return (metrics.join(keys, "ticker", "left")
            .select("instrument_key", date_key("trade_date").alias("date_key"), "sector_key",
                    F.col("open").alias("open_price"), F.col("high").alias("high_price"),
                    F.col("low").alias("low_price"), F.col("close").alias("close_price"),
                    "volume", *METRIC_COLS,
                    F.lit(run_id).cast("int").alias("load_run_id")))


def replaced_ranges(new_fact: DataFrame) -> DataFrame:
    """Per instrument, the date-key range a new batch replaces."""
    return new_fact.groupBy("instrument_key").agg(F.min("date_key").alias("_lo"),
                                                  F.max("date_key").alias("_hi"),
                                                  F.count(F.lit(1)).alias("_rows"))


def range_replace(existing: DataFrame, new_fact: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Idempotent load: drop existing rows of each instrument inside the batch's min..max date
    range, then add the batch. Re-running a batch replaces, never duplicates. The range table has
    one row per instrument of the batch; a written one may be given as ``ranges``."""
    ranges = (replaced_ranges(new_fact) if ranges is None else ranges).select(F.col("instrument_key").alias("_ik"), "_lo", "_hi")
    kept = existing.join(ranges, (existing["instrument_key"] == ranges["_ik"])
                         & existing["date_key"].between(ranges["_lo"], ranges["_hi"]), "left_anti")
    return kept.unionByName(new_fact.select(*existing.columns))


def integrity_checks(fact: DataFrame, dim_date: DataFrame, dim_instrument: DataFrame, dim_sector: DataFrame,
                     ledger: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row: duplicate fact keys; facts without their date, instrument, sector or run;
    instruments without their sector; rejects without their run; invalid values; the number of runs
    the facts point at and whether all point at the newest successful run.

    The fact is read twice: once joined to the keys of all dimensions for every row-wise check, once
    grouped by its key.
    """
    one = F.count(F.lit(1))

    def known(df: DataFrame, key: str) -> DataFrame:
        return bounded_list(df.select(F.col(key), F.lit(1).alias(f"_has_{key}")).distinct())

    rows = fact.select("instrument_key", "date_key", "sector_key", "load_run_id", "close_price", "high_price", "low_price", "volume")
    for df, key in ((dim_date, "date_key"), (dim_instrument, "instrument_key"), (dim_sector, "sector_key"), (ledger, "load_run_id")):
        rows = rows.join(known(df, key), key, "left")
    bad = (F.col("close_price") <= 0) | (F.col("high_price") < F.col("low_price")) | (F.col("volume") < 0)
    by_row = rows.agg(
        *[F.count_if(F.isnull(f"_has_{key}")).alias(name) for name, key in (
            ("orphan_dates", "date_key"), ("orphan_instruments", "instrument_key"), ("orphan_sectors", "sector_key"),
            ("orphan_runs", "load_run_id"))],
        F.count_if(bad).alias("bad_values"), F.min("load_run_id").alias("_lo"), F.max("load_run_id").alias("_hi"))
    single = {
        "dup_keys": fact.groupBy("instrument_key", "date_key").agg(one.alias("_n")).filter("_n > 1").agg(one),
        "fact_runs": fact.select("load_run_id").distinct().agg(one),
        "homeless_instruments": (dim_instrument.select("sector_key").join(known(dim_sector, "sector_key"), "sector_key", "left")
                                 .filter(F.isnull("_has_sector_key")).agg(one)),
        "orphan_rejects": (rejects.select("load_run_id").groupBy("load_run_id").agg(one.alias("_n"))
                           .join(known(ledger, "load_run_id"), "load_run_id", "left_anti")
                           .agg(F.coalesce(F.sum("_n"), F.lit(0)))),
    }
    latest = ledger.filter(F.col("status") == "SUCCEEDED").agg(F.max("load_run_id")).scalar()
    return by_row.select(
        *[df.scalar().cast("bigint").alias(name) for name, df in single.items()],
        "orphan_dates", "orphan_instruments", "orphan_sectors", "orphan_runs", "bad_values",
        ((F.col("_lo") == latest) & (F.col("_hi") == latest)).cast("int").alias("all_latest"))


# What must be 0 before a run is committed.
MUST_BE_ZERO = ["dup_keys", "homeless_instruments", "orphan_rejects", "orphan_dates", "orphan_instruments",
                "orphan_sectors", "orphan_runs", "bad_values"]
