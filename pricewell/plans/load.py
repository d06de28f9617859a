"""The tables of the warehouse."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

LEDGER_COLS = ["load_run_id", "started_at", "finished_at", "status", "rows_read", "rows_loaded",
               "rows_rejected", "error_message"]
TABLES = ["dim_sector", "dim_instrument", "dim_date", "fact_daily_price", "etl_load_run", "etl_run_file",
          "etl_rejected_row"]


@dataclass
class Warehouse:
    dim_sector: DataFrame
    dim_instrument: DataFrame
    dim_date: DataFrame
    fact_daily_price: DataFrame   # with the partition columns fact_year and fact_bucket
    etl_load_run: DataFrame       # every run: RUNNING, SUCCEEDED and FAILED
    etl_run_file: DataFrame       # the files of each run, one row each
    etl_rejected_row: DataFrame
    fact_run: DataFrame           # fact_year, fact_bucket, load_run_id: the runs whose rows a live part holds
