"""Scalar column expressions.

Every function returns a ``Column`` made only of built-in expressions, so Catalyst can fold,
push down and code-generate them.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date text format accepted for trade and listing dates.
DATE_FORMAT = "yyyy-MM-dd"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalise_ticker(x) -> Column:
    """Key normalisation used on both sides of every ticker lookup: ``upper(trim(x))``."""
    return F.upper(F.trim(_c(x)))


def safe_date(x) -> Column:
    """Strict ``yyyy-MM-dd`` parse; anything else (and NULL) gives NULL instead of an error. Text of that
    shape is cast, which costs much less; only the rest is left to the format."""
    text = _c(x)
    plain = F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), text.try_cast("date"))
    return F.coalesce(plain, F.to_date(F.try_to_timestamp(text, F.lit(DATE_FORMAT))))


# Text formats of listing dates, tried in this order; the third takes what has no
# such month.
LISTING_FORMATS = ["yyyy-MM-dd", "M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "yyyyMMdd", "d MMM yyyy", "MMM d, yyyy"]


def lenient_date(x) -> Column:
    """A date in any of ``LISTING_FORMATS``, month before day where both fit; else NULL."""
    text = F.trim(_c(x))
    return F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in LISTING_FORMATS])


def finite_or_null(x: Column) -> Column:
    """NaN and +-Infinity become NULL, so a non-finite price counts as a missing value."""
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


def safe_double(x) -> Column:
    """``try_cast(x AS DOUBLE)`` with non-finite results mapped to NULL."""
    return finite_or_null(_c(x).try_cast("double"))


def safe_bigint(x) -> Column:
    """``try_cast(x AS BIGINT)``: "10.0" or "1e3" give NULL, " 10 " gives 10."""
    return _c(x).try_cast("bigint")


def two_digits(hundredths: str) -> Column:
    """The text of a column of whole hundredths, with two digits behind the point. The column should be
    a plain one: it is read several times."""
    sign = F.when(F.col(hundredths) < 0, F.lit("-")).otherwise(F.lit(""))
    behind = F.substr((F.abs(hundredths) % 100 + 100).cast("string"), F.lit(2))
    return F.concat(sign, F.expr(f"abs({hundredths}) div 100").cast("string"), F.lit("."), behind)


def raw_record(*cols) -> Column:
    """The raw columns re-joined with ``,``; NULL fields become empty text."""
    return F.concat_ws(",", *[F.coalesce(_c(c), F.lit("")) for c in cols])


def date_key(d) -> Column:
    """Integer ``yyyymmdd`` key of a date."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d) -> dict[str, Column]:
    """Calendar parts of ``dim_date``: ISO week, Monday = 1, calendar month end flag."""
    d = _c(d)
    return {
        "date_key": date_key(d),
        "full_date": d,
        "year": F.year(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "month": F.month(d).cast("int"),
        "month_name": F.date_format(d, "MMMM"),
        "week_of_year": F.weekofyear(d).cast("int"),
        "day_of_week": (F.weekday(d) + 1).cast("int"),
        "day_name": F.date_format(d, "EEEE"),
        "is_month_end": (d == F.last_day(d)).cast("int"),
    }


def guarded_ratio(num, den) -> Column:
    """``num / den`` when ``den > 0``, else NULL (ANSI mode raises on a bare division by zero)."""
    num, den = _c(num), _c(den)
    return F.when(den > 0, num.cast("double") / den.cast("double"))
