"""Declared schemas of the warehouse tables (nothing is inferred)."""
from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


STR, INT, LONG, DBL = StringType(), IntegerType(), LongType(), DoubleType()

SCHEMAS: dict[str, StructType] = {
    "dim_sector": _s(("sector_key", INT), ("sector_name", STR)),
    "dim_instrument": _s(("instrument_key", INT), ("ticker", STR), ("company_name", STR), ("exchange", STR),
                         ("sector_key", INT), ("listing_date", DateType())),
    "dim_date": _s(("date_key", INT), ("full_date", DateType()), ("year", INT), ("quarter", INT), ("month", INT),
                   ("month_name", STR), ("week_of_year", INT), ("day_of_week", INT), ("day_name", STR),
                   ("is_month_end", INT)),
    "fact_daily_price": _s(("instrument_key", INT), ("date_key", INT), ("sector_key", INT), ("open_price", DBL),
                           ("high_price", DBL), ("low_price", DBL), ("close_price", DBL), ("volume", LONG),
                           ("daily_return", DBL), ("log_return", DBL), ("ma_20", DBL), ("ma_50", DBL),
                           ("volatility_20d", DBL), ("load_run_id", INT)),
    # Row counts are 64-bit: a run at scale reads more than 2^31 rows.
    "etl_load_run": _s(("load_run_id", INT), ("started_at", TimestampType()), ("finished_at", TimestampType()),
                       ("status", STR), ("rows_read", LONG), ("rows_loaded", LONG),
                       ("rows_rejected", LONG), ("error_message", STR)),
    # One row per file of a run; the ledger row holds no list.
    "etl_run_file": _s(("load_run_id", INT), ("source_file", STR)),
    # reject_id is unique within its run; (load_run_id, reject_id) is the table key.
    "etl_rejected_row": _s(("reject_id", LONG), ("load_run_id", INT), ("source_file", STR), ("ticker", STR),
                           ("trade_date_raw", STR), ("reject_reason", STR), ("raw_record", STR)),
}


def with_parts(schema: StructType) -> StructType:
    """A copy of ``schema`` plus the partition columns of the fact table."""
    return StructType([*schema.fields, StructField("fact_year", INT, True), StructField("fact_bucket", INT, True)])
