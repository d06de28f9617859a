"""The "tape": a raw daily price feed derived from the driver's TPC-H-style tables.

One raw price row per ``lineitem`` row. Instrument = supplier (``s_name``), exchange = nation
(``n_name``), sector = region (``r_name``). Defects are chosen by remainders of a per-row hash
``h`` so any SQL engine derives the same rows; prices are two-digit decimals so their text forms
agree across engines. Every column of the feed is text, as in a CSV drop.

Fixed values (must stay equal across engines, see FIXTURES.md section 2):

    h = l_orderkey*7 + l_linenumber*13 + l_partkey
    px = 100 + (l_extendedprice as decimal(12,2)) % 10 ; open = px
    close = px + (l_linenumber - 4) * 0.25
    h % 257 = 0 -> ticker 'ZZZZ'                     (unknown_instrument)
    h % 241 = 0 -> ticker of two blanks              (unknown_instrument)
    h % 5   = 0 -> ticker ' ' || lower(s_name) || ' ' (normalised, still good)
    h % 263 = 0 -> trade_date '31/13/2021'           (unparseable_date)
    h % 199 = 0 -> high and low crossed              (ohlc_inconsistent)
    h % 101 = 0 -> close NULL ; h % 103 = 0 -> close negated ; h % 107 = 0 -> close 'abc'
    h % 229 = 0 -> volume '-1'                       (negative_volume)
    h % 97  = 0 -> the row is delivered twice        (exact_duplicate)
    source_file = 'prices_' || year(ship date) || '.csv'
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import raw_record, two_digits
from ..operators.joins import bounded_list
from .feed import RAW_COLUMNS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tape_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file names of the feed, each once; no row is dealt for them."""
    supplier = bounded_list(_table(spark, sf_dir, "supplier").select("s_suppkey"))
    li = _table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("dt"))
    return (li.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
            .select(_source_file().alias("source_file")).distinct())


def _source_file():
    return F.concat(F.lit("prices_"), F.year("dt").cast("string"), F.lit(".csv"))


def hundredths(x: str) -> Column:
    """``cast(x as decimal(12,2))`` as a whole number of hundredths. Away from the middle between two
    of them, doubles give the same; only the rest, and what is very large, takes decimals."""
    scaled = F.col(x).cast("double") * 100
    near = F.rint(scaled)
    plain = (F.abs(scaled) < 1e11) & (F.abs(scaled - near) < 0.25)
    return F.when(plain, near.cast("bigint")).otherwise((F.col(x).cast("decimal(12,2)") * 100).cast("bigint"))


def tape_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed: the 7 text columns plus ``source_file`` and ``raw_record``."""
    supplier = bounded_list(_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))
    # one row group of the table is one task's, however many rows it has: the few numbers that the
    # text is made of are dealt over all tasks first
    li = (_table(spark, sf_dir, "lineitem")
          .select(
              "l_suppkey", "l_linenumber",
              F.col("l_shipdate").cast("date").alias("dt"),
              F.col("l_quantity").cast("bigint").alias("qty"),
              (F.lit(10000) + hundredths("l_extendedprice") % 1000).alias("o"),
              (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey")).alias("h"))
          .repartition("h", "l_linenumber", "l_suppkey", "dt", "o")
          .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
          .drop("l_suppkey", "s_suppkey"))
    # prices stay whole hundredths until their text is made
    h, o, c, n = F.col("h"), F.col("o"), F.col("c"), F.col("l_linenumber").cast("bigint")
    crossed = h % 199 == 0
    li = li.withColumn("c", o + (n - 4) * 25)
    li = li.withColumns({
        "hi": F.when(crossed, F.least(o, c) - 100).otherwise(F.greatest(o, c) + n * 100),
        "lo": F.when(crossed, F.greatest(o, c) + 100).otherwise(F.least(o, c) - n * 100),
        "cl": F.when(h % 103 == 0, -c).otherwise(c)})
    raw = li.select(
        h,
        F.when(h % 257 == 0, F.lit("ZZZZ"))
         .when(h % 241 == 0, F.lit("  "))
         .when(h % 5 == 0, F.concat(F.lit(" "), F.lower("s_name"), F.lit(" ")))
         .otherwise(F.col("s_name")).alias("ticker"),
        F.when(h % 263 == 0, F.lit("31/13/2021")).otherwise(F.col("dt").cast("string")).alias("trade_date"),
        two_digits("o").alias("open"), two_digits("hi").alias("high"), two_digits("lo").alias("low"),
        F.when(h % 101 == 0, F.lit(None).cast("string"))
         .when((h % 107 == 0) & (h % 103 != 0), F.lit("abc"))
         .otherwise(two_digits("cl")).alias("close"),
        F.when(h % 229 == 0, F.lit("-1")).otherwise(F.col("qty").cast("string")).alias("volume"),
        _source_file().alias("source_file"),
    )
    # Exact copies: the same delivery twice, generated in place (one scan, no union).
    feed = raw.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(h % 97 == 0, 2).otherwise(1))))
    return feed.select(*RAW_COLUMNS, "source_file", raw_record(*RAW_COLUMNS).alias("raw_record"))


def tape_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instrument reference, all text like a headered CSV:
    ticker, company_name, sector, exchange, listing_date.

    The listing date is derived from the supplier key; every 11th is blank and every 13th is written
    day first. Every 17th supplier has no sector (NULL or a blank), and every 19th is listed a second
    time without a ticker (NULL or blanks).
    """
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("s_suppkey")
    listed = F.date_add(F.lit("1994-01-03").cast("date"), (k % 365).cast("int"))
    return (supplier
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.explode(F.when(k % 38 == 0, F.array("s_name", F.lit(None).cast("string")))
                          .when(k % 19 == 0, F.array("s_name", F.lit("  "))).otherwise(F.array("s_name"))).alias("ticker"),
                F.concat(F.col("s_name"), F.lit(" Holdings")).alias("company_name"),
                F.when(k % 34 == 0, F.lit(None).cast("string")).when(k % 17 == 0, F.lit(" ")).otherwise(F.col("r_name")).alias("sector"),
                F.col("n_name").alias("exchange"),
                F.when(k % 11 == 0, F.lit(None).cast("string"))
                 .when(k % 13 == 0, F.date_format(listed, "dd/MM/yyyy"))
                 .otherwise(listed.cast("string")).alias("listing_date")))
