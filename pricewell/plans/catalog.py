"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables through the tape source, so its work grows with them.
Floating-point outputs are rounded (returns 8, averages of prices 4, volatility 6, money 2)
only so that an independent engine's summation order cannot change the compared digits.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalise_ticker, safe_date
from ..operators import measures as M
from ..operators.metrics import add_rolling_metrics, sector_daily
from ..operators.quality import (CONFLICTING_DUPLICATE, EXACT_DUPLICATE, REJECT_COLS, parse_feed, reject_counts,
                                 rule_flags, source_files, staging_totals, validate)
from ..operators.star import FACT_COLS, integrity_checks, normalise_reference, replaced_ranges
from ..sources.feed import subset
from . import views as V
from .scenario import full_load, tape, two_runs

# Digits kept per kind of floating-point output.
DIGITS = {"daily_return": 8, "log_return": 8, "ma_20": 4, "ma_50": 4, "volatility_20d": 6,
          "avg_daily_return": 8, "annualised_return": 8, "avg_volatility": 6, "avg_vol": 6,
          "traded_value": 2, "sector_return": 8, "index_value": 4, "reject_rate": 8,
          "price_vs_ma50": 8}


def rounded(df: DataFrame) -> DataFrame:
    """Round every column named in DIGITS, keep the rest and the column order."""
    return df.select(*[F.round(c, DIGITS[c]).alias(c) if c in DIGITS else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- staging (one run, whole tape)

def _staging(spark, d):
    raw, inst = tape(spark, d)
    return raw, inst, validate(raw, normalise_reference(inst))


def q_raw_record(spark, d):
    raw, _ = tape(spark, d)
    return raw


def q_normalise_ticker(spark, d):
    raw, _ = tape(spark, d)
    return (raw.groupBy(F.col("ticker").alias("ticker_raw"), normalise_ticker("ticker").alias("ticker"))
            .agg(F.count(F.lit(1)).alias("n")))


def q_safe_date(spark, d):
    raw, _ = tape(spark, d)
    return (raw.groupBy(F.col("trade_date").alias("trade_date_raw"), safe_date("trade_date").alias("trade_date"))
            .agg(F.count(F.lit(1)).alias("n")))


def q_safe_numeric(spark, d):
    raw, _ = tape(spark, d)
    return parse_feed(raw).select("source_file", "raw_record", "open", "high", "low", "close", "volume")


def q_rule_flags(spark, d):
    return rule_flags(_staging(spark, d)[2].checked)


def q_reject_reason(spark, d):
    return _staging(spark, d)[2].checked.select("source_file", "ticker", "trade_date_raw", "raw_record",
                                                "reject_reason")


def q_unknown_instrument(spark, d):
    checked = _staging(spark, d)[2].checked
    return (checked.filter(F.array_contains(F.split("reject_reason", ";"), F.lit("unknown_instrument")))
            .select("source_file", "ticker", "raw_record"))


def _dup_rejects(reason):
    def q(spark, d):
        rej = _staging(spark, d)[2].rejects
        return rej.filter(F.col("reject_reason") == reason).select("source_file", "ticker", "trade_date_raw",
                                                                    "raw_record")
    return q


def q_clean_prices(spark, d):
    return _staging(spark, d)[2].clean


def q_rejects(spark, d):
    return _staging(spark, d)[2].rejects.select(*REJECT_COLS)


def q_reject_counts(spark, d):
    return reject_counts(_staging(spark, d)[2].refused, "_n")


def q_staging_totals(spark, d):
    return staging_totals(_staging(spark, d)[2])


def q_source_files(spark, d):
    raw, _ = tape(spark, d)
    return source_files(raw)


def q_ticker_subset(spark, d):
    """The same job on a subset of the universe: the instruments of the first sector by name.

    The wanted list is itself a DataFrame (it grows with the reference), applied by semi-joins.
    """
    raw, inst = tape(spark, d)
    ref = normalise_reference(inst)
    first_sector = ref.agg(F.min("sector")).scalar()
    wanted = ref.filter(F.col("sector") == first_sector).select("ticker")
    raw_sub, inst_sub = subset(raw, inst, wanted)
    ref_sub = normalise_reference(inst_sub)
    m = add_rolling_metrics(validate(raw_sub, ref_sub).clean)
    return rounded(m.select("ticker", "trade_date", "close", "daily_return", "ma_20", "ma_50", "volatility_20d"))


# ---------------------------------------------------------------- metrics (whole tape)

def _metrics(spark, d):
    return add_rolling_metrics(_staging(spark, d)[2].clean)


def _metric_cols(*cols):
    def q(spark, d):
        return rounded(_metrics(spark, d).select("ticker", "trade_date", *cols))
    return q


def q_rolling_metrics(spark, d):
    return rounded(_metrics(spark, d))


def _enriched(spark, d):
    raw, inst, st = _staging(spark, d)
    ref = normalise_reference(inst).select("ticker", "sector")
    return add_rolling_metrics(st.clean).join(ref, "ticker", "left")


def q_enrich_sector(spark, d):
    return rounded(_enriched(spark, d).select("ticker", "trade_date", "sector", "close", "daily_return"))


def q_sector_daily(spark, d):
    return rounded(sector_daily(_enriched(spark, d)))


# ---------------------------------------------------------------- star schema (one full run)

def _wh(spark, d):
    return full_load(spark, d).read()


def q_dim_sector(spark, d):
    return _wh(spark, d).dim_sector


def q_dim_instrument(spark, d):
    return _wh(spark, d).dim_instrument


def q_dim_date(spark, d):
    return _wh(spark, d).dim_date


def q_fact_load(spark, d):
    return rounded(_wh(spark, d).fact_daily_price.select(*FACT_COLS))


def q_star_join(spark, d):
    return rounded(V.star(_wh(spark, d)).select("ticker", "sector_name", "full_date", "close_price",
                                                "daily_return", "ma_20", "ma_50", "volatility_20d"))


# ---------------------------------------------------------------- two runs (insert-if-absent, replace)

def q_dim_insert_if_absent(spark, d):
    store = two_runs(spark, d)
    dims = {"dim_sector": ("sector_name", "sector_key"), "dim_instrument": ("ticker", "instrument_key"),
            "dim_date": ("full_date", "date_key")}
    parts = [store.read_run_table(dim, run).select(F.lit(dim).alias("dim"), F.col(natural).cast("string").alias("natural_key"),
                                                   F.col(key).alias("surrogate_key"), F.lit(run).alias("inserted_by_run"))
             for run in store.committed_runs() for dim, (natural, key) in dims.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_scan_fact(spark, d):
    return rounded(two_runs(spark, d).read().fact_daily_price.select(*FACT_COLS))


def q_range_replace(spark, d):
    store = two_runs(spark, d)
    newest = store.committed_runs()[-1]
    ranges = replaced_ranges(store.read().fact_daily_price.filter(F.col("load_run_id") == newest))
    old = store.read(as_of=newest - 1).fact_daily_price.select(F.col("instrument_key").alias("_ik"), F.col("date_key").alias("_dk"))
    replaced = (old.join(ranges, (old["_ik"] == ranges["instrument_key"])
                         & old["_dk"].between(ranges["_lo"], ranges["_hi"]))
                .groupBy("instrument_key").agg(F.count(F.lit(1)).alias("rows_replaced")))
    return (ranges.join(replaced, "instrument_key", "left")
            .select("instrument_key", F.col("_lo").alias("from_date_key"), F.col("_hi").alias("to_date_key"),
                    F.col("_rows").alias("rows_inserted"),
                    F.coalesce("rows_replaced", F.lit(0)).alias("rows_replaced")))


def q_integrity_checks(spark, d):
    wh = two_runs(spark, d).read()
    return integrity_checks(wh.fact_daily_price, wh.dim_date, wh.dim_instrument, wh.dim_sector, wh.etl_load_run, wh.etl_rejected_row)


def q_data_quality(spark, d):
    return rounded(V.data_quality(two_runs(spark, d).read()))


def q_trace_run(spark, d):
    return V.trace_run(two_runs(spark, d).read())


def q_trace_files(spark, d):
    """The runs and files behind all prices."""
    return V.trace_files(two_runs(spark, d).read())


def q_trace_files_newest_day(spark, d):
    """The runs and files behind every price of the newest day."""
    wh = two_runs(spark, d).read()
    return V.trace_files(wh, date_key=wh.dim_date.agg(F.max("date_key")).scalar())


def q_stored_rejects(spark, d):
    """The stored reject table; reject_id is unique in its run, so it shows as a count."""
    rejects = two_runs(spark, d).read().etl_rejected_row
    return rejects.groupBy("load_run_id", *REJECT_COLS).agg(F.count_distinct("reject_id").alias("reject_ids"))


def q_reject_drilldown(spark, d):
    return V.reject_drilldown(two_runs(spark, d).read())


def q_latest_run(spark, d):
    wh = two_runs(spark, d).read()
    return rounded(M.latest_run_card(wh.etl_load_run, wh.etl_rejected_row))


def q_latest_reject_counts(spark, d):
    wh = two_runs(spark, d).read()
    return rounded(M.latest_reject_counts(wh.etl_load_run, wh.etl_rejected_row))


# ---------------------------------------------------------------- views, queries, measures (one full run)

def q_instrument_latest(spark, d):
    return rounded(V.instrument_latest(_wh(spark, d)))


def q_sector_monthly(spark, d):
    return rounded(V.sector_monthly(_wh(spark, d)))


def q_sector_year_return(spark, d):
    return rounded(V.sector_year_return(_wh(spark, d)))


def q_golden_cross(spark, d):
    return rounded(V.golden_cross(_wh(spark, d)))


def q_golden_crosses(spark, d):
    return rounded(V.golden_crosses(_wh(spark, d)))


def q_most_volatile(spark, d):
    return rounded(V.most_volatile(_wh(spark, d)))


def q_drilldown_rollup(spark, d):
    return rounded(V.drilldown_rollup(_wh(spark, d)))


def q_calendar_rollup(spark, d):
    return rounded(V.calendar_rollup(_wh(spark, d)))


def q_measures_by_sector(spark, d):
    return rounded(M.basic_measures(V.star(_wh(spark, d)), ["sector_name"]))


def q_latest_close(spark, d):
    return V.latest_measure(_wh(spark, d), M.latest_close)


def q_price_vs_ma50(spark, d):
    return rounded(V.latest_measure(_wh(spark, d), M.price_vs_ma50))


def q_sector_index(spark, d):
    return rounded(M.sector_index(V.star(_wh(spark, d))))


def q_sector_stats(spark, d):
    return rounded(M.sector_stats(V.star(_wh(spark, d))))


def q_instrument_drilldown(spark, d):
    return rounded(V.instrument_drilldown(_wh(spark, d)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # scans, scalar functions, rules
    "raw_record": q_raw_record,
    "normalise_ticker": q_normalise_ticker,
    "safe_date": q_safe_date,
    "safe_numeric": q_safe_numeric,
    "rule_flags": q_rule_flags,
    "reject_reason": q_reject_reason,
    "unknown_instrument": q_unknown_instrument,
    "exact_duplicates": _dup_rejects(EXACT_DUPLICATE),
    "conflicting_duplicates": _dup_rejects(CONFLICTING_DUPLICATE),
    "clean_prices": q_clean_prices,
    "rejects": q_rejects,
    "reject_counts": q_reject_counts,
    "staging_totals": q_staging_totals,
    "source_files": q_source_files,
    "ticker_subset": q_ticker_subset,
    # rolling metrics
    "daily_return": _metric_cols("daily_return"),
    "log_return": _metric_cols("log_return"),
    "moving_averages": _metric_cols("ma_20", "ma_50"),
    "volatility_20d": _metric_cols("volatility_20d"),
    "rolling_metrics": q_rolling_metrics,
    "enrich_sector": q_enrich_sector,
    "sector_daily": q_sector_daily,
    # star schema
    "dim_sector": q_dim_sector,
    "dim_instrument": q_dim_instrument,
    "dim_date": q_dim_date,
    "fact_load": q_fact_load,
    "star_join": q_star_join,
    "dim_insert_if_absent": q_dim_insert_if_absent,
    "scan_fact": q_scan_fact,
    "range_replace": q_range_replace,
    "integrity_checks": q_integrity_checks,
    # views and analytical queries
    "instrument_latest": q_instrument_latest,
    "sector_monthly": q_sector_monthly,
    "data_quality": q_data_quality,
    "sector_year_return": q_sector_year_return,
    "golden_cross": q_golden_cross,
    "golden_crosses": q_golden_crosses,
    "most_volatile": q_most_volatile,
    "trace_run": q_trace_run,
    "trace_files": q_trace_files,
    "trace_files_newest_day": q_trace_files_newest_day,
    "stored_rejects": q_stored_rejects,
    "reject_drilldown": q_reject_drilldown,
    "drilldown_rollup": q_drilldown_rollup,
    "calendar_rollup": q_calendar_rollup,
    # measures and dashboard data sets
    "measures_by_sector": q_measures_by_sector,
    "latest_close": q_latest_close,
    "price_vs_ma50": q_price_vs_ma50,
    "latest_run": q_latest_run,
    "latest_reject_counts": q_latest_reject_counts,
    "sector_index": q_sector_index,
    "sector_stats": q_sector_stats,
    "instrument_drilldown": q_instrument_drilldown,
}
