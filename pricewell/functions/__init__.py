"""Column expressions used across the engine. All are built-in Spark functions (codegen'd)."""
from .columns import (calendar_columns, date_key, finite_or_null, guarded_ratio, lenient_date, normalise_ticker,
                      raw_record, safe_bigint, safe_date, safe_double, two_digits)

__all__ = ["calendar_columns", "date_key", "finite_or_null", "guarded_ratio", "normalise_ticker",
           "raw_record", "safe_bigint", "safe_date", "safe_double", "two_digits"]
