"""Oracle SQL, DuckDB dialect, for every registered query.

Written independently of the Spark plans: duplicates are found with plain ``row_number`` /
``count`` windows over all rows (no collapsing), the latest row per instrument with a correlated
MAX subquery, range replace with ``NOT EXISTS`` and so on. Each query is a ``WITH`` chain built
from the CTE groups below; the driver tables are pre-registered views.

Scenarios (same as the Spark side):

* ``F``: one run over the whole tape (run id 1);
* ``A`` then ``B``: run 1 loads every file but the newest, run 2 fails, run 3 loads the two newest
  files.
"""
from __future__ import annotations

# ---------------------------------------------------------------- tape (FIXTURES.md section 2)

TAPE = [
    """tape_li AS (
  SELECT s_name, CAST(l_shipdate AS DATE) dt, l_linenumber, CAST(l_quantity AS BIGINT) qty,
         CAST(100 + CAST(l_extendedprice AS DECIMAL(12,2)) % 10 AS DECIMAL(12,2)) o,
         (l_orderkey*7 + l_linenumber*13 + l_partkey) h
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)""",
    """tape_b AS (
  SELECT h, l_linenumber n, qty, o, CAST(o + (l_linenumber-4)*0.25 AS DECIMAL(12,2)) c, s_name, dt FROM tape_li)""",
    """tape_r AS (
  SELECT h,
    CASE WHEN h%257=0 THEN 'ZZZZ' WHEN h%241=0 THEN '  ' WHEN h%5=0 THEN concat(' ', lower(s_name), ' ') ELSE s_name END ticker,
    CASE WHEN h%263=0 THEN '31/13/2021' ELSE CAST(dt AS VARCHAR) END trade_date,
    CAST(o AS VARCHAR) open,
    CAST(CASE WHEN h%199=0 THEN least(o,c)-1 ELSE greatest(o,c)+n END AS VARCHAR) high,
    CAST(CASE WHEN h%199=0 THEN greatest(o,c)+1 ELSE least(o,c)-n END AS VARCHAR) low,
    CASE WHEN h%101=0 THEN CAST(NULL AS VARCHAR) WHEN h%103=0 THEN CAST(-c AS VARCHAR)
         WHEN h%107=0 THEN 'abc' ELSE CAST(c AS VARCHAR) END close,
    CASE WHEN h%229=0 THEN '-1' ELSE CAST(qty AS VARCHAR) END volume,
    'prices_' || CAST(year(dt) AS VARCHAR) || '.csv' source_file
  FROM tape_b)""",
    """raw AS (
  SELECT ticker, trade_date, open, high, low, close, volume, source_file,
         concat_ws(',', coalesce(ticker,''), coalesce(trade_date,''), coalesce(open,''), coalesce(high,''),
                   coalesce(low,''), coalesce(close,''), coalesce(volume,'')) raw_record
  FROM (SELECT * FROM tape_r UNION ALL SELECT * FROM tape_r WHERE h%97=0))""",
    """ref_raw AS (
  SELECT unnest(CASE WHEN s_suppkey % 38 = 0 THEN [s_name, NULL] WHEN s_suppkey % 19 = 0 THEN [s_name, '  '] ELSE [s_name] END) ticker,
    s_name || ' Holdings' company_name,
    CASE WHEN s_suppkey % 34 = 0 THEN NULL WHEN s_suppkey % 17 = 0 THEN ' ' ELSE r_name END sector, n_name exchange,
    CASE WHEN s_suppkey % 11 = 0 THEN NULL
         WHEN s_suppkey % 13 = 0 THEN strftime(DATE '1994-01-03' + CAST(s_suppkey % 365 AS INTEGER), '%d/%m/%Y')
         ELSE CAST(DATE '1994-01-03' + CAST(s_suppkey % 365 AS INTEGER) AS VARCHAR) END listing_date
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    # supplier names are unique, so one row per normalised ticker already
    """ref AS (
  SELECT upper(trim(ticker)) ticker, company_name,
         CASE WHEN length(trim(coalesce(sector, ''))) > 0 THEN trim(sector) ELSE 'Unknown' END sector, exchange, listing_date
  FROM ref_raw WHERE length(trim(coalesce(ticker, ''))) > 0)""",
]

BATCH = {
    "F": "TRUE",
    "A": "source_file < (SELECT max(source_file) FROM raw)",
    "B": "source_file >= (SELECT max(source_file) FROM raw WHERE source_file < (SELECT max(source_file) FROM raw))",
}


def staging(t: str, where: str, raw: str = "raw", ref: str = "ref") -> list[str]:
    """typed_t, checked_t, ranked_t, dedup_t, clean_t, rejects_t, metrics_t for one batch."""
    fin = "CASE WHEN isfinite(try_cast({c} AS DOUBLE)) THEN try_cast({c} AS DOUBLE) END {c}"
    return [
        f"""typed_{t} AS (
  SELECT upper(trim(ticker)) ticker, trade_date trade_date_raw, try_strptime(trade_date, '%Y-%m-%d')::DATE trade_date,
         {fin.format(c='open')}, {fin.format(c='high')}, {fin.format(c='low')}, {fin.format(c='close')},
         try_cast(volume AS BIGINT) volume, source_file, raw_record
  FROM {raw} WHERE {where})""",
        f"""checked_{t} AS (
  SELECT x.*, k.ticker known_ticker,
    concat_ws(';',
      CASE WHEN x.trade_date IS NULL THEN 'unparseable_date' END,
      CASE WHEN x.open IS NULL OR x.high IS NULL OR x.low IS NULL OR x.close IS NULL OR x.volume IS NULL
           THEN 'missing_value' END,
      CASE WHEN least(coalesce(x.open,1.0), coalesce(x.high,1.0), coalesce(x.low,1.0), coalesce(x.close,1.0)) <= 0
           THEN 'non_positive_price' END,
      CASE WHEN x.high < x.low OR x.high < greatest(x.open, x.close) OR x.low > least(x.open, x.close)
           THEN 'ohlc_inconsistent' END,
      CASE WHEN x.volume < 0 THEN 'negative_volume' END,
      CASE WHEN k.ticker IS NULL THEN 'unknown_instrument' END) reject_reason
  FROM typed_{t} x LEFT JOIN (SELECT DISTINCT ticker FROM {ref}) k ON x.ticker = k.ticker)""",
        f"""ranked_{t} AS (
  SELECT *, row_number() OVER (PARTITION BY ticker, trade_date, open, high, low, close, volume
                               ORDER BY source_file, raw_record) rn
  FROM checked_{t} WHERE reject_reason = '')""",
        f"""dedup_{t} AS (
  SELECT *, count(*) OVER (PARTITION BY ticker, trade_date) versions FROM ranked_{t} WHERE rn = 1)""",
        f"""clean_{t} AS (
  SELECT ticker, trade_date, open, high, low, close, volume, source_file FROM dedup_{t} WHERE versions = 1)""",
        f"""rejects_{t} AS (
  SELECT source_file, ticker, trade_date_raw, reject_reason, raw_record FROM checked_{t} WHERE reject_reason <> ''
  UNION ALL SELECT source_file, ticker, trade_date_raw, 'exact_duplicate', raw_record FROM ranked_{t} WHERE rn > 1
  UNION ALL SELECT source_file, ticker, trade_date_raw, 'conflicting_duplicate', raw_record FROM dedup_{t}
            WHERE versions > 1)""",
        f"""m1_{t} AS (
  SELECT *, close / lag(close) OVER w - 1 daily_return, ln(close / lag(close) OVER w) log_return,
         row_number() OVER w n_
  FROM clean_{t} WINDOW w AS (PARTITION BY ticker ORDER BY trade_date))""",
        f"""metrics_{t} AS (
  SELECT ticker, trade_date, open, high, low, close, volume, source_file, daily_return, log_return,
    -- summed in date order, so that ties between the two averages are the same in every engine
    CASE WHEN n_ >= 20 THEN list_reduce(list(close) OVER (PARTITION BY ticker ORDER BY trade_date
         ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), lambda x, y: x + y) / 20 END ma_20,
    CASE WHEN n_ >= 50 THEN list_reduce(list(close) OVER (PARTITION BY ticker ORDER BY trade_date
         ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), lambda x, y: x + y) / 50 END ma_50,
    CASE WHEN n_ > 20 THEN stddev_samp(log_return) OVER (PARTITION BY ticker ORDER BY trade_date
         ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) * sqrt(252) END volatility_20d
  FROM m1_{t})""",
    ]


def _calendar(src: str) -> str:
    return f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) date_key, d full_date, CAST(year(d) AS INTEGER) AS "year",
         CAST(quarter(d) AS INTEGER) AS "quarter", CAST(month(d) AS INTEGER) AS "month", monthname(d) month_name,
         CAST(week(d) AS INTEGER) week_of_year, CAST(isodow(d) AS INTEGER) day_of_week, dayname(d) day_name,
         CAST(d = last_day(d) AS INTEGER) is_month_end
  FROM (SELECT DISTINCT trade_date d FROM {src})"""


FACT_SELECT = """SELECT i.instrument_key, CAST(strftime(m.trade_date, '%Y%m%d') AS INTEGER) date_key, i.sector_key,
         m.open open_price, m.high high_price, m.low low_price, m.close close_price, m.volume,
         m.daily_return, m.log_return, m.ma_20, m.ma_50, m.volatility_20d, CAST({run} AS INTEGER) load_run_id
  FROM metrics_{t} m JOIN dim_instrument_{t} i ON i.ticker = m.ticker"""

CLOCK = {1: ("2025-01-06 18:00:00", "2025-01-06 18:00:23"), 2: ("2025-01-07 09:30:00", "2025-01-07 09:30:05"),
         3: ("2025-01-07 18:00:00", "2025-01-07 18:00:19")}
LISTING = ("coalesce(" + ", ".join(f"try_strptime(r.listing_date, '{f}')" for f in ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y"))
           + ")::DATE listing_date")


def _ledger_row(t: str, run: int) -> str:
    start, end = CLOCK[run]
    return f"""SELECT CAST({run} AS INTEGER) load_run_id, TIMESTAMP '{start}' started_at, TIMESTAMP '{end}' finished_at,
         'SUCCEEDED' status,
         (SELECT count(*) FROM typed_{t}) rows_read, (SELECT count(*) FROM newfact_{t}) rows_loaded,
         (SELECT count(*) FROM rejects_{t}) rows_rejected, CAST(NULL AS VARCHAR) error_message"""


FAILED_RUN = f"""SELECT CAST(2 AS INTEGER), TIMESTAMP '{CLOCK[2][0]}', TIMESTAMP '{CLOCK[2][1]}', 'FAILED',
         CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), 'feed ends early'"""


def first_run(t: str) -> list[str]:
    """Dimensions, facts, ledger and rejects of a first run into an empty warehouse."""
    return [
        f"""dim_sector_{t} AS (
  SELECT CAST(row_number() OVER (ORDER BY sector_name) AS INTEGER) sector_key, sector_name
  FROM (SELECT DISTINCT sector sector_name FROM ref))""",
        f"""dim_instrument_{t} AS (
  SELECT CAST(row_number() OVER (ORDER BY r.ticker) AS INTEGER) instrument_key, r.ticker, r.company_name,
         r.exchange, s.sector_key, {LISTING}
  FROM ref r JOIN dim_sector_{t} s ON s.sector_name = r.sector)""",
        f"""dim_date_{t} AS ({_calendar(f'clean_{t}')})""",
        f"""newfact_{t} AS ({FACT_SELECT.format(run=1, t=t)})""",
        f"""fact_{t} AS (SELECT * FROM newfact_{t})""",
        f"""ledger_{t} AS ({_ledger_row(t, 1)})""",
        f"""rejected_{t} AS (SELECT CAST(1 AS INTEGER) load_run_id, * FROM rejects_{t})""",
    ]


def second_run(t: str, p: str) -> list[str]:
    """The third run (batch ``t``) on top of the warehouse left by run 1 (batch ``p``)."""
    return [
        f"""new_sector_{t} AS (
  SELECT CAST((SELECT coalesce(max(sector_key), 0) FROM dim_sector_{p})
              + row_number() OVER (ORDER BY sector_name) AS INTEGER) sector_key, sector_name
  FROM (SELECT DISTINCT sector sector_name FROM ref WHERE sector NOT IN (SELECT sector_name FROM dim_sector_{p})))""",
        f"""dim_sector_{t} AS (SELECT * FROM dim_sector_{p} UNION ALL SELECT * FROM new_sector_{t})""",
        f"""new_instrument_{t} AS (
  SELECT CAST((SELECT coalesce(max(instrument_key), 0) FROM dim_instrument_{p})
              + row_number() OVER (ORDER BY r.ticker) AS INTEGER) instrument_key, r.ticker, r.company_name,
         r.exchange, s.sector_key, {LISTING}
  FROM ref r JOIN dim_sector_{t} s ON s.sector_name = r.sector
  WHERE r.ticker NOT IN (SELECT ticker FROM dim_instrument_{p}))""",
        f"""dim_instrument_{t} AS (SELECT * FROM dim_instrument_{p} UNION ALL SELECT * FROM new_instrument_{t})""",
        f"""new_date_{t} AS (
  SELECT * FROM ({_calendar(f'clean_{t}')}) WHERE date_key NOT IN (SELECT date_key FROM dim_date_{p}))""",
        f"""dim_date_{t} AS (SELECT * FROM dim_date_{p} UNION ALL SELECT * FROM new_date_{t})""",
        f"""newfact_{t} AS ({FACT_SELECT.format(run=3, t=t)})""",
        f"""ranges_{t} AS (
  SELECT instrument_key, min(date_key) lo, max(date_key) hi, count(*) n FROM newfact_{t} GROUP BY instrument_key)""",
        f"""fact_{t} AS (
  SELECT * FROM fact_{p} f WHERE NOT EXISTS (SELECT 1 FROM ranges_{t} r WHERE r.instrument_key = f.instrument_key
                                               AND f.date_key BETWEEN r.lo AND r.hi)
  UNION ALL SELECT * FROM newfact_{t})""",
        f"""ledger_{t} AS (SELECT * FROM ledger_{p} UNION ALL {FAILED_RUN}
  UNION ALL {_ledger_row(t, 3)})""",
        f"""files_{t} AS (
  SELECT DISTINCT CAST(1 AS INTEGER) load_run_id, source_file FROM typed_{p}
  UNION ALL SELECT DISTINCT CAST(3 AS INTEGER), source_file FROM typed_{t})""",
        f"""rejected_{t} AS (SELECT * FROM rejected_{p} UNION ALL SELECT CAST(3 AS INTEGER), * FROM rejects_{t})""",
        f"""star_{t} AS (
  SELECT f.*, i.ticker, i.company_name, s.sector_name, d.full_date, d.year, d.quarter, d.month
  FROM fact_{t} f JOIN dim_instrument_{t} i ON i.instrument_key = f.instrument_key
  JOIN dim_sector_{t} s ON s.sector_key = f.sector_key JOIN dim_date_{t} d ON d.date_key = f.date_key)""",
    ]


def star_cte(t: str) -> str:
    return f"""star_{t} AS (
  SELECT f.*, i.ticker, i.company_name, s.sector_name, d.full_date, d.year, d.quarter, d.month
  FROM fact_{t} f JOIN dim_instrument_{t} i ON i.instrument_key = f.instrument_key
  JOIN dim_sector_{t} s ON s.sector_key = f.sector_key JOIN dim_date_{t} d ON d.date_key = f.date_key)"""


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def full(body: str) -> str:
    """Query over the single full run F."""
    return _with(TAPE + staging("F", BATCH["F"]) + first_run("F") + [star_cte("F")], body)


def staged(body: str) -> str:
    """Query over the staging of the whole tape only."""
    return _with(TAPE + staging("F", BATCH["F"]), body)


def two(body: str) -> str:
    """Query over the warehouse after runs A (id 1), a failed one (id 2) and B (id 3)."""
    return _with(TAPE + staging("A", BATCH["A"]) + staging("B", BATCH["B"]) + first_run("A")
                 + second_run("B", "A"), body)


def r(col: str, digits: int, alias: str | None = None) -> str:
    return f"round({col}, {digits}) {alias or col.split('.')[-1]}"


METRICS_ROUNDED = ", ".join([r("daily_return", 8), r("log_return", 8), r("ma_20", 4), r("ma_50", 4),
                             r("volatility_20d", 6)])
FACT_ROUNDED = ("instrument_key, date_key, sector_key, open_price, high_price, low_price, close_price, volume, "
                + METRICS_ROUNDED + ", load_run_id")

SUBSET = [
    "wanted AS (SELECT ticker FROM ref WHERE sector = (SELECT min(sector) FROM ref))",
    "raw_sub AS (SELECT * FROM raw WHERE upper(trim(ticker)) IN (SELECT ticker FROM wanted))",
    "ref_sub AS (SELECT * FROM ref WHERE ticker IN (SELECT ticker FROM wanted))",
]

LATEST = "(SELECT max(load_run_id) FROM ledger_B WHERE status = 'SUCCEEDED')"

# The stored averages are compared as they are, with the instrument's row before.
CROSSES = """
        SELECT f.ticker, f.full_date, f.close_price, round(f.ma_20, 4) ma_20, round(f.ma_50, 4) ma_50
        FROM star_F f JOIN (
          SELECT instrument_key, date_key, lag(date_key) OVER (PARTITION BY instrument_key ORDER BY date_key) before FROM fact_F) k
          ON k.instrument_key = f.instrument_key AND k.date_key = f.date_key
        JOIN fact_F p ON p.instrument_key = f.instrument_key AND p.date_key = k.before
        WHERE f.ma_20 > f.ma_50 AND p.ma_20 <= p.ma_50"""

ORACLE_SQL: dict[str, str] = {
    "raw_record": _with(TAPE, "SELECT * FROM raw"),
    "normalise_ticker": _with(TAPE, "SELECT ticker ticker_raw, upper(trim(ticker)) ticker, count(*) n FROM raw "
                                    "GROUP BY ALL"),
    "safe_date": _with(TAPE, "SELECT trade_date trade_date_raw, try_strptime(trade_date, '%Y-%m-%d')::DATE trade_date, "
                             "count(*) n FROM raw GROUP BY ALL"),
    "safe_numeric": staged("SELECT source_file, raw_record, open, high, low, close, volume FROM typed_F"),
    "rule_flags": staged("""SELECT source_file, raw_record,
        CAST(trade_date IS NULL AS INTEGER) f_unparseable_date,
        CAST(open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL AS INTEGER) f_missing_value,
        CAST(least(coalesce(open,1.0), coalesce(high,1.0), coalesce(low,1.0), coalesce(close,1.0)) <= 0 AS INTEGER)
          f_non_positive_price,
        coalesce(CAST(high < low OR high < greatest(open, close) OR low > least(open, close) AS INTEGER), 0)
          f_ohlc_inconsistent,
        coalesce(CAST(volume < 0 AS INTEGER), 0) f_negative_volume,
        CAST(known_ticker IS NULL AS INTEGER) f_unknown_instrument
      FROM checked_F"""),
    "reject_reason": staged("SELECT source_file, ticker, trade_date_raw, raw_record, reject_reason FROM checked_F"),
    "unknown_instrument": staged("SELECT source_file, ticker, raw_record FROM checked_F WHERE known_ticker IS NULL"),
    "exact_duplicates": staged("SELECT source_file, ticker, trade_date_raw, raw_record FROM rejects_F "
                               "WHERE reject_reason = 'exact_duplicate'"),
    "conflicting_duplicates": staged("SELECT source_file, ticker, trade_date_raw, raw_record FROM rejects_F "
                                     "WHERE reject_reason = 'conflicting_duplicate'"),
    "clean_prices": staged("SELECT * FROM clean_F"),
    "rejects": staged("SELECT * FROM rejects_F"),
    "reject_counts": staged("SELECT reason, count(*) n FROM (SELECT unnest(string_split(reject_reason, ';')) reason "
                            "FROM rejects_F) GROUP BY reason"),
    "staging_totals": staged("SELECT (SELECT count(*) FROM typed_F) rows_read, (SELECT count(*) FROM clean_F) rows_clean, "
                             "(SELECT count(*) FROM rejects_F) rows_rejected"),
    "source_files": _with(TAPE, "SELECT DISTINCT source_file FROM raw"),
    "ticker_subset": _with(TAPE + SUBSET + staging("S", "TRUE", raw="raw_sub", ref="ref_sub"),
                           f"SELECT ticker, trade_date, close, {r('daily_return', 8)}, {r('ma_20', 4)}, "
                           f"{r('ma_50', 4)}, {r('volatility_20d', 6)} FROM metrics_S"),
    "daily_return": staged(f"SELECT ticker, trade_date, {r('daily_return', 8)} FROM metrics_F"),
    "log_return": staged(f"SELECT ticker, trade_date, {r('log_return', 8)} FROM metrics_F"),
    "moving_averages": staged(f"SELECT ticker, trade_date, {r('ma_20', 4)}, {r('ma_50', 4)} FROM metrics_F"),
    "volatility_20d": staged(f"SELECT ticker, trade_date, {r('volatility_20d', 6)} FROM metrics_F"),
    "rolling_metrics": staged("SELECT ticker, trade_date, open, high, low, close, volume, source_file, "
                              + METRICS_ROUNDED + " FROM metrics_F"),
    "enrich_sector": staged(f"SELECT m.ticker, m.trade_date, f.sector, m.close, {r('m.daily_return', 8)} "
                            "FROM metrics_F m LEFT JOIN ref f ON f.ticker = m.ticker"),
    "sector_daily": staged(f"""SELECT f.sector, m.trade_date, {r('avg(m.daily_return)', 8, 'sector_return')},
        {r('sum(m.close * m.volume)', 2, 'traded_value')}, count(*) instruments
        FROM metrics_F m LEFT JOIN ref f ON f.ticker = m.ticker GROUP BY f.sector, m.trade_date"""),
    "dim_sector": full("SELECT * FROM dim_sector_F"),
    "dim_instrument": full("SELECT * FROM dim_instrument_F"),
    "dim_date": full("SELECT * FROM dim_date_F"),
    "fact_load": full(f"SELECT {FACT_ROUNDED} FROM fact_F"),
    "star_join": full(f"SELECT ticker, sector_name, full_date, close_price, {METRICS_ROUNDED.replace(r('log_return', 8) + ', ', '')} "
                      "FROM star_F"),
    "dim_insert_if_absent": two("""
        SELECT 'dim_sector' dim, sector_name natural_key, sector_key surrogate_key, 1 inserted_by_run FROM dim_sector_A
        UNION ALL SELECT 'dim_instrument', ticker, instrument_key, 1 FROM dim_instrument_A
        UNION ALL SELECT 'dim_date', CAST(full_date AS VARCHAR), date_key, 1 FROM dim_date_A
        UNION ALL SELECT 'dim_sector', sector_name, sector_key, 3 FROM new_sector_B
        UNION ALL SELECT 'dim_instrument', ticker, instrument_key, 3 FROM new_instrument_B
        UNION ALL SELECT 'dim_date', CAST(full_date AS VARCHAR), date_key, 3 FROM new_date_B"""),
    "scan_fact": two(f"SELECT {FACT_ROUNDED} FROM fact_B"),
    "range_replace": two("""
        SELECT r.instrument_key, r.lo from_date_key, r.hi to_date_key, r.n rows_inserted,
               coalesce(x.cnt, 0) rows_replaced
        FROM ranges_B r LEFT JOIN (
          SELECT r.instrument_key, count(*) cnt FROM fact_A f JOIN ranges_B r
            ON f.instrument_key = r.instrument_key AND f.date_key BETWEEN r.lo AND r.hi GROUP BY r.instrument_key) x
        ON x.instrument_key = r.instrument_key"""),
    "integrity_checks": two(f"""
        SELECT (SELECT count(*) FROM (SELECT instrument_key, date_key FROM fact_B GROUP BY ALL HAVING count(*) > 1))
                 dup_keys,
               (SELECT count(*) FROM fact_B f LEFT JOIN dim_date_B d ON d.date_key = f.date_key
                 WHERE d.date_key IS NULL) orphan_dates,
               (SELECT count(*) FROM fact_B f LEFT JOIN dim_instrument_B i ON i.instrument_key = f.instrument_key
                 WHERE i.instrument_key IS NULL) orphan_instruments,
               (SELECT count(*) FROM fact_B WHERE sector_key IS NULL OR sector_key NOT IN (SELECT sector_key FROM dim_sector_B))
                 orphan_sectors,
               (SELECT count(*) FROM fact_B WHERE load_run_id NOT IN (SELECT load_run_id FROM ledger_B)) orphan_runs,
               (SELECT count(*) FROM rejected_B WHERE load_run_id NOT IN (SELECT load_run_id FROM ledger_B)) orphan_rejects,
               (SELECT count(*) FROM dim_instrument_B WHERE sector_key IS NULL
                  OR sector_key NOT IN (SELECT sector_key FROM dim_sector_B)) homeless_instruments,
               (SELECT count(*) FROM fact_B WHERE close_price <= 0 OR high_price < low_price OR volume < 0) bad_values,
               (SELECT count(DISTINCT load_run_id) FROM fact_B) fact_runs,
               CAST((SELECT bool_and(load_run_id = {LATEST}) FROM fact_B) AS INTEGER) all_latest"""),
    "data_quality": two("""
        SELECT load_run_id, started_at, finished_at, status, rows_read, rows_loaded, rows_rejected,
               round(CASE WHEN rows_read > 0 THEN CAST(rows_rejected AS DOUBLE) / rows_read END, 8) reject_rate
        FROM ledger_B"""),
    "trace_run": two("""
        SELECT i.ticker, f.date_key, f.load_run_id, l.finished_at
        FROM fact_B f JOIN ledger_B l ON l.load_run_id = f.load_run_id
        JOIN dim_instrument_B i ON i.instrument_key = f.instrument_key"""),
    "trace_files": two("""
        SELECT DISTINCT f.load_run_id, l.finished_at, x.source_file
        FROM fact_B f JOIN ledger_B l ON l.load_run_id = f.load_run_id JOIN files_B x ON x.load_run_id = f.load_run_id"""),
    "trace_files_newest_day": two("""
        SELECT DISTINCT f.load_run_id, l.finished_at, x.source_file
        FROM fact_B f JOIN ledger_B l ON l.load_run_id = f.load_run_id JOIN files_B x ON x.load_run_id = f.load_run_id
        WHERE f.date_key = (SELECT max(date_key) FROM dim_date_B)"""),
    "stored_rejects": two("""
        SELECT load_run_id, source_file, ticker, trade_date_raw, reject_reason, raw_record, count(*) reject_ids
        FROM rejected_B GROUP BY ALL"""),
    "reject_drilldown": two(f"""
        SELECT source_file, reject_reason, count(*) n FROM rejected_B WHERE load_run_id = {LATEST}
        GROUP BY source_file, reject_reason"""),
    "latest_run": two(f"""
        SELECT load_run_id latest_run_id, finished_at latest_load_time, rows_read, rows_loaded,
               (SELECT count(*) FROM rejected_B WHERE load_run_id = {LATEST}) rows_rejected,
               round(CASE WHEN rows_read > 0 THEN CAST((SELECT count(*) FROM rejected_B WHERE load_run_id = {LATEST})
                     AS DOUBLE) / rows_read END, 8) reject_rate
        FROM ledger_B WHERE load_run_id = {LATEST}"""),
    "latest_reject_counts": two(f"""
        SELECT reason, count(*) n,
               (SELECT round(CASE WHEN rows_read > 0 THEN CAST(rows_rejected AS DOUBLE) / rows_read END, 8)
                FROM ledger_B WHERE load_run_id = {LATEST}) reject_rate
        FROM (SELECT unnest(string_split(reject_reason, ';')) reason FROM rejected_B WHERE load_run_id = {LATEST})
        GROUP BY reason"""),
    "instrument_latest": full(f"""
        SELECT ticker, company_name, sector_name, full_date, close_price, {r('daily_return', 8)}, {r('ma_20', 4)},
               {r('ma_50', 4)}, {r('volatility_20d', 6)}
        FROM star_F f WHERE date_key = (SELECT max(f2.date_key) FROM fact_F f2 WHERE f2.instrument_key = f.instrument_key)"""),
    "sector_monthly": full(f"""
        SELECT sector_name, year, quarter, month, {r('avg(daily_return)', 8, 'avg_daily_return')},
               {r('avg(volatility_20d)', 6, 'avg_volatility')}, {r('sum(close_price * volume)', 2, 'traded_value')},
               count(*) price_rows
        FROM star_F GROUP BY sector_name, year, quarter, month"""),
    "sector_year_return": full(f"""
        SELECT sector_name, year, {r('avg(daily_return) * 252', 8, 'annualised_return')},
               {r('avg(volatility_20d)', 6, 'avg_volatility')}
        FROM star_F GROUP BY sector_name, year"""),
    "golden_cross": full(f"""{CROSSES} ORDER BY full_date DESC, ticker LIMIT 20"""),
    "golden_crosses": full(CROSSES),
    "most_volatile": full("""
        SELECT ticker, sector_name, round(avg(volatility_20d), 6) avg_vol FROM star_F
        WHERE year = (SELECT year(max(full_date)) FROM star_F) AND quarter = (SELECT quarter(max(full_date)) FROM star_F)
        GROUP BY ticker, sector_name ORDER BY avg(volatility_20d) DESC NULLS LAST, ticker LIMIT 10"""),
    "drilldown_rollup": full(f"""
        SELECT sector_name, ticker, CAST(grouping(sector_name, ticker) AS INTEGER) level,
               {r('avg(daily_return)', 8, 'avg_daily_return')}, {r('sum(close_price * volume)', 2, 'traded_value')},
               count(*) price_rows
        FROM star_F GROUP BY ROLLUP (sector_name, ticker)"""),
    "calendar_rollup": full(f"""
        SELECT year, quarter, month, CAST(grouping(year, quarter, month) AS INTEGER) level,
               {r('avg(daily_return)', 8, 'avg_daily_return')}, {r('avg(volatility_20d)', 6, 'avg_volatility')},
               count(*) price_rows
        FROM star_F GROUP BY ROLLUP (year, quarter, month)"""),
    "measures_by_sector": full(f"""
        SELECT sector_name, {r('avg(daily_return)', 8, 'avg_daily_return')},
               {r('avg(daily_return) * 252', 8, 'annualised_return')}, {r('avg(volatility_20d)', 6, 'avg_volatility')},
               {r('sum(close_price * volume)', 2, 'traded_value')}
        FROM star_F GROUP BY sector_name"""),
    "latest_close": full("""
        SELECT l.ticker, l.last_date_key, max(s.close_price) latest_close
        FROM (SELECT ticker, max(date_key) last_date_key FROM star_F GROUP BY ticker) l
        JOIN star_F s ON s.ticker = l.ticker AND s.date_key = l.last_date_key GROUP BY l.ticker, l.last_date_key"""),
    "price_vs_ma50": full("""
        SELECT l.ticker, l.last_date_key,
               round(max(s.close_price) / nullif(max(s.ma_50), 0) - 1, 8) price_vs_ma50
        FROM (SELECT ticker, max(date_key) last_date_key FROM star_F GROUP BY ticker) l
        JOIN star_F s ON s.ticker = l.ticker AND s.date_key = l.last_date_key GROUP BY l.ticker, l.last_date_key"""),
    "sector_index": full("""
        SELECT sector_name, full_date, round(r, 8) sector_return,
               round(100 * product(1 + r) OVER (PARTITION BY sector_name ORDER BY full_date
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) index_value
        FROM (SELECT sector_name, full_date, coalesce(avg(daily_return), 0) r FROM star_F GROUP BY ALL)"""),
    "sector_stats": full(f"""
        SELECT sector_name, {r('avg(daily_return) * 252', 8, 'annualised_return')},
               {r('avg(volatility_20d)', 6, 'avg_volatility')}
        FROM star_F GROUP BY sector_name"""),
    "instrument_drilldown": full("""
        SELECT ticker, sector_name, full_date, close_price, round(ma_20, 4) ma_20, round(ma_50, 4) ma_50
        FROM (SELECT *, max(full_date) OVER (PARTITION BY ticker) last_day FROM star_F)
        WHERE full_date >= last_day - 365"""),
}
