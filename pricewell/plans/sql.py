"""The warehouse as SQL: temp views for its tables, the BI views from their DataFrame plans, and the
analytical example queries as text.

``register(spark, wh)`` (re)creates every view; ``example(spark, name, **parameters)`` runs a query.
The examples read ``priced``, the fact set with its dimensions' names.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import views
from .load import TABLES, Warehouse

VIEWS = {"priced": views.star, "vw_instrument_latest": views.instrument_latest,
         "vw_sector_monthly": views.sector_monthly, "vw_data_quality": views.data_quality}

EXAMPLES = {
    "sector_year_return": """
        select sector_name, year, 252 * mean(daily_return) as annualised_return, mean(volatility_20d) as avg_volatility
        from priced group by all order by year, annualised_return desc""",
    "golden_crosses": """
        with signal as (
          select ticker, full_date, close_price, ma_20, ma_50, ma_20 > ma_50 as above,
                 lag(ma_20 > ma_50) over (partition by ticker order by full_date) as was_above
          from priced)
        select ticker, full_date, close_price, ma_20, ma_50 from signal
        where above and not was_above order by full_date desc, ticker limit 20""",
    "most_volatile": """
        select ticker, sector_name, mean(volatility_20d) as avg_vol from priced
        where year = :year and quarter = :quarter group by all order by avg_vol desc nulls last, ticker limit 10""",
    "trace_run": """
        select load_run_id, finished_at, source_file
        from priced join etl_load_run using (load_run_id) join etl_run_file using (load_run_id)
        where ticker = :ticker and date_key = :date_key""",
    "reject_drilldown": """
        with newest as (select max(load_run_id) as load_run_id from etl_load_run where status = 'SUCCEEDED')
        select source_file, reject_reason, count(*) as n
        from etl_rejected_row join newest using (load_run_id) group by all order by n desc, source_file, reject_reason""",
}


def register(spark: SparkSession, wh: Warehouse) -> None:
    """Create or replace the temp views of the tables and the BI views."""
    for name in TABLES:
        getattr(wh, name).createOrReplaceTempView(name)
    for name, plan in VIEWS.items():
        plan(wh).createOrReplaceTempView(name)


def example(spark: SparkSession, name: str, **parameters) -> DataFrame:
    """Run one example query (after :func:`register`)."""
    return spark.sql(EXAMPLES[name], args=parameters)
