"""The load job on the tape and on hand-written feeds: nothing lost, nothing visible before the
commit, and a reload that touches only what it replaces."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricewell.functions import lenient_date
from pricewell.operators import measures
from pricewell.operators import star as S
from pricewell.plans import job, views
from pricewell.plans.load import TABLES
from pricewell.plans.scenario import full_load, two_runs
from pricewell.sources.feed import RAW_COLUMNS
from pricewell.sources.tape import tape_instruments, tape_prices
from pricewell.sources.warehouse import WarehouseStore, export_extracts

INSTRUMENTS = "ticker string, company_name string, sector string, exchange string, listing_date string"


def feed(spark, rows, name="prices_x.csv"):
    cells = [tuple(str(c) for c in r) for r in rows]
    df = spark.createDataFrame(cells, ", ".join(f"{c} string" for c in RAW_COLUMNS))
    return df.withColumn("source_file", F.lit(name)).withColumn("raw_record", F.concat_ws(",", *RAW_COLUMNS))


def days(ticker, first, n, price=20.0):
    d0 = dt.date.fromisoformat(first)
    return [(ticker, d0 + dt.timedelta(days=i), price, price + 1, price - 1, price + i / 1000, 5) for i in range(n)]


def reference(spark, *rows):
    return spark.createDataFrame(list(rows), INSTRUMENTS)


BIRDS = [("WREN", "Wren", "Small", "N", "2001-02-03"), ("CRANE", "Crane", "", "N", "13/02/2001"), (" crow ", "Crow", None, "N", "02/03/2001"),
         (None, "Nobody", "Small", "N", None), ("  ", "Blank", "Ghosts", "N", None)]


def test_no_sector_and_no_ticker_lose_nothing(spark, tmp_path):
    raw = feed(spark, days("WREN", "2030-12-30", 4) + days("crane", "2031-01-01", 2) + days("CROW", "2031-01-01", 1) + days("", "2031-01-01", 1))
    for run in (1, 2):
        got = job.run_load(spark, raw, reference(spark, *BIRDS), str(tmp_path))
        assert (got["load_run_id"], got["rows_read"], got["rows_loaded"], got["rows_rejected"]) == (run, 8, 7, 1)
    wh = WarehouseStore(spark, str(tmp_path)).read()
    assert sorted(r.sector_name for r in wh.dim_sector.collect()) == ["Ghosts", "Small", "Unknown"][1:]
    assert sorted((r.ticker, str(r.listing_date)) for r in wh.dim_instrument.collect()) == [
        ("CRANE", "2001-02-13"), ("CROW", "2001-02-03"), ("WREN", "2001-02-03")]
    assert {r.sector_name for r in views.star(wh).filter("ticker in ('CRANE', 'CROW')").collect()} == {"Unknown"}
    report = S.integrity_checks(wh.fact_daily_price, wh.dim_date, wh.dim_instrument, wh.dim_sector, wh.etl_load_run, wh.etl_rejected_row).head()
    assert all(report[name] == 0 for name in S.MUST_BE_ZERO) and report.fact_runs == 1 and report.all_latest == 1


def test_listing_dates(spark):
    texts = ["2020-03-04", "3/4/2020", "13/4/2020", "2020/3/4", "20200304", "4 Mar 2020", "Mar 4, 2020", " 2020-03-04 ", "?", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [str(r[0]) for r in df.select(lenient_date("t")).collect()] == [
        "2020-03-04", "2020-03-04", "2020-04-13", *["2020-03-04"] * 5, "None", "None", "None"]


def losing(df, *args):
    return S_FACT_ROWS(df, *args).filter("date_key % 2 = 0")


def homeless(reference, dim_sector, existing=None):
    return S_INSTRUMENTS(reference, dim_sector.filter("sector_name <> 'Unknown'"), existing)


def twice(df, *args):
    out = S_FACT_ROWS(df, *args)
    return out.unionByName(out.limit(1))


S_FACT_ROWS, S_INSTRUMENTS = S.fact_rows, S.dim_instrument_new


@pytest.mark.parametrize("name,broken", [("fact_rows", losing), ("fact_rows", twice), ("dim_instrument_new", homeless)])
def test_a_violated_check_keeps_the_old_data_live(spark, tmp_path, monkeypatch, name, broken):
    small = reference(spark, BIRDS[0])
    job.run_load(spark, feed(spark, days("WREN", "2031-01-01", 5)), small, str(tmp_path))
    before = sorted(WarehouseStore(spark, str(tmp_path)).read().fact_daily_price.collect())
    monkeypatch.setattr(job, name, broken)
    with pytest.raises(job.LoadCheckError):
        job.run_load(spark, feed(spark, days("WREN", "2031-01-01", 5, 30.0) + days("CRANE", "2031-01-01", 3)), reference(spark, *BIRDS), str(tmp_path))
    store = WarehouseStore(spark, str(tmp_path))
    wh = store.read()
    assert [r.status for r in wh.etl_load_run.orderBy("load_run_id").collect()] == ["SUCCEEDED", "FAILED"]
    assert sorted(wh.fact_daily_price.collect()) == before and wh.dim_instrument.count() == 1
    assert not list((tmp_path / "_staging").glob("*"))
    assert any("run=2" in p for p in store.vacuum())
    assert sorted(WarehouseStore(spark, str(tmp_path)).read().fact_daily_price.collect()) == before


def test_one_ticker_touches_its_own_buckets_only(spark, tmp_path):
    names = [f"T{i:02d}" for i in range(40)]
    ref = reference(spark, *[(t, t, "S", "N", None) for t in names])
    job.run_load(spark, feed(spark, [r for t in names for r in days(t, "2030-12-01", 60)]), ref, str(tmp_path))
    first = WarehouseStore(spark, str(tmp_path)).fact_map()
    job.run_load(spark, feed(spark, days("T07", "2031-01-10", 5, 50.0)), ref, str(tmp_path))
    store = WarehouseStore(spark, str(tmp_path))
    moved = {part for part, run in store.fact_map().items() if run == 2}
    assert len(moved) == 1 and {y for y, _ in moved} == {2031} and set(first) == set(store.fact_map())
    written = {p.parent for p in (tmp_path / "fact_daily_price" / "run=2").rglob("*.parquet")}
    assert len(written) == 1
    fact = store.read().fact_daily_price
    assert fact.count() == 40 * 60 and fact.filter("load_run_id = 2").count() == 5
    # the map of a state asked for is that state's own
    assert store.read(as_of=1).fact_daily_price.filter("load_run_id = 2").count() == 0
    gone = store.vacuum()
    assert len(gone) == 1 and store.read().fact_daily_price.count() == 40 * 60


def test_two_runs_and_a_failed_one(spark):
    store = two_runs(spark, SF_SMALL)
    wh = store.read()
    quality = views.data_quality(wh).orderBy("load_run_id").collect()
    assert [(r.load_run_id, r.status) for r in quality] == [(1, "SUCCEEDED"), (2, "FAILED"), (3, "SUCCEEDED")]
    assert quality[1].reject_rate is None and store.committed_runs() == [1, 3]
    assert "feed ends early" in wh.etl_load_run.filter("load_run_id = 2").head().error_message
    assert set(store.fact_map().values()) == {1, 3}
    assert {r.load_run_id for r in wh.etl_rejected_row.select("load_run_id").distinct().collect()} == {1, 3}
    newest = wh.dim_date.agg(F.max("date_key")).head()[0]
    files = views.trace_files(wh, date_key=newest).collect()
    assert {r.load_run_id for r in files} == {3} and len(files) == 2
    one = views.trace_run(wh, date_key=newest).orderBy("ticker").head()
    assert views.trace_run(wh, one.ticker, newest).collect() == [one]


def test_fact_filters_prune_folders(spark):
    wh = full_load(spark, SF_SMALL).read()
    df = views.most_volatile(wh, 1996, 2)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "volatility_20d" in line)
    assert "fact_year" in scan.split("PartitionFilters")[1].split("PushedFilters")[0] and "GreaterThanOrEqual(date_key" in scan


@pytest.mark.parametrize("plan", [
    views.instrument_latest, lambda wh: measures.price_vs_ma50(views.star(wh), ["ticker"]),
    lambda wh: measures.latest_close(views.star(wh), ["sector_name"])])
def test_latest_rows_aggregate_by_hash(spark, plan):
    text = plan(full_load(spark, SF_SMALL).read())._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_extracts(spark, tmp_path):
    wh = full_load(spark, SF_SMALL).read()
    paths = export_extracts(wh, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths] == TABLES
    back = spark.read.option("header", True).csv(paths[TABLES.index("fact_daily_price")])
    assert back.columns == S.FACT_COLS and back.count() == wh.fact_daily_price.count()


def test_csv_feed_end_to_end(spark, tmp_path):
    pdf = tape_prices(spark, SF_SMALL).toPandas()
    (tmp_path / "feed").mkdir()
    for name, part in pdf.groupby("source_file"):
        part[RAW_COLUMNS].to_csv(tmp_path / "feed" / name, index=False, na_rep="")
    tape_instruments(spark, SF_SMALL).toPandas().to_csv(tmp_path / "feed" / "instruments.csv", index=False, na_rep="")
    got = job.run_pipeline(spark, str(tmp_path / "feed"), str(tmp_path / "wh"))
    same = full_load(spark, SF_SMALL).read().etl_load_run.head()
    assert (got["rows_read"], got["rows_loaded"], got["rows_rejected"]) == (same.rows_read, same.rows_loaded, same.rows_rejected)
    one = job.run_pipeline(spark, str(tmp_path / "feed"), str(tmp_path / "one"), tickers=["supplier#000000003"])
    wh = WarehouseStore(spark, str(tmp_path / "one")).read()
    assert one["rows_loaded"] == wh.fact_daily_price.count() > 0 and wh.dim_instrument.count() == 1
    assert wh.etl_run_file.count() == len(list((tmp_path / "feed").glob("prices_*.csv")))


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_part_of_any_size_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    names = [f"T{i:02d}" for i in range(30)]
    ref = reference(spark, *[(t, t, "S", "N", None) for t in names])
    raw = feed(spark, [r for t in names for r in days(t, "2030-01-01", 200)])
    # several tasks read the batch, and each hands on more than the advisory size
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.files.openCostInBytes": "1m", "spark.sql.files.maxPartitionBytes": "1m"}
    before = {k: spark.conf.get(k) for k in conf}
    monkeypatch.setattr(job, "WarehouseStore", lambda *a, **k: WarehouseStore(*a, **k, buckets=2))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        job.run_load(spark, raw, ref, str(tmp_path))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    monkeypatch.undo()
    store = WarehouseStore(spark, str(tmp_path))
    files = {}
    for p in (tmp_path / "fact_daily_price").rglob("*.parquet"):
        files.setdefault(p.parent, []).append(p)
    assert set(store.fact_map()) == {(2030, 0), (2030, 1)} and all(len(f) > 1 for f in files.values())
    # the warehouse keeps its number of buckets, whatever later runs would begin with
    job.run_load(spark, feed(spark, days("T07", "2030-03-01", 5, 50.0)), ref, str(tmp_path))
    store = WarehouseStore(spark, str(tmp_path))
    assert store.state().buckets == 2 and set(store.fact_map()) == {(2030, 0), (2030, 1)}
    fact = store.read().fact_daily_price
    assert fact.count() == 30 * 200 and fact.select("instrument_key", "date_key").distinct().count() == 30 * 200
    assert sorted(store.state().runs.values()) == [(1,), (1, 2)]


def test_all_days_are_traced_without_the_fact(spark):
    wh = two_runs(spark, SF_SMALL).read()
    df = views.trace_files(wh)
    text = plan_of(df)
    assert "fact_daily_price" not in text
    slow = wh.fact_daily_price.select("load_run_id").distinct().join(wh.etl_run_file, "load_run_id")
    assert {(r.load_run_id, r.source_file) for r in df.collect()} == {(r.load_run_id, r.source_file) for r in slow.collect()}


def test_latest_values_read_the_fact_once(spark):
    wh = full_load(spark, SF_SMALL).read()
    for level in ("ticker", "sector_name"):
        for measure in (measures.latest_close, measures.price_vs_ma50):
            df = views.latest_measure(wh, measure, level)
            text = plan_of(df).split("== Initial Plan ==")[0]
            assert sum("FileScan" in x and "date_key" in x for x in text.splitlines()) == 1
            assert "SortAggregate" not in text
            assert sorted(map(str, df.collect())) == sorted(map(str, measure(views.star(wh), [level]).select(*df.columns).collect()))


def test_the_drilldown_prunes_years(spark):
    wh = full_load(spark, SF_SMALL).read()
    df = views.instrument_drilldown(wh)
    text = plan_of(df)
    scan = next(line for line in text.splitlines() if "FileScan" in line and "ma_20" in line)
    assert "fact_year" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    star = views.star(wh)
    last = star.groupBy("ticker").agg(F.max("full_date").alias("_last"))
    want = star.join(last, "ticker").filter("full_date >= date_sub(_last, 365)").select(*df.columns)
    assert sorted(map(str, df.collect())) == sorted(map(str, want.collect()))
    one = df.head().ticker
    assert sorted(map(str, views.instrument_drilldown(wh, one).collect())) == sorted(str(r) for r in df.collect() if r.ticker == one)


def test_many_runs_are_compacted_and_a_dead_one_is_closed(spark, tmp_path):
    job.run_load(spark, feed(spark, days("WREN", "2031-01-01", 5)), reference(spark, BIRDS[0]), str(tmp_path))
    job.run_load(spark, feed(spark, days("CRANE", "2031-01-03", 5)), reference(spark, *BIRDS), str(tmp_path))
    store = WarehouseStore(spark, str(tmp_path))
    for run in range(3, 51):
        store.append_event(run, "FAILED", dt.datetime(2031, 1, 1), error_message="no feed")
    store.append_event(51, "RUNNING", dt.datetime(2031, 1, 2))   # killed: it wrote this and no end
    store.write_run_table("dim_sector", 51, spark.createDataFrame([(9, "Lost")], "sector_key int, sector_name string"))
    store.stage(51, "staged", spark.range(3))
    before = {name: sorted(map(str, getattr(store.read(), name).collect())) for name in ("dim_sector", "dim_instrument", "dim_date", "fact_daily_price")}
    store.compact()
    assert len(list((tmp_path / "etl_load_run").glob("event=*"))) == 1
    store.vacuum()
    for name in ("dim_sector", "dim_instrument", "dim_date"):
        assert [p.name for p in (tmp_path / name).iterdir() if p.name != "run=51"] == ["run=base-2"]
    assert {name: sorted(map(str, getattr(WarehouseStore(spark, str(tmp_path)).read(), name).collect())) for name in before} == before
    got = job.run_load(spark, feed(spark, days("CROW", "2031-01-04", 2)), reference(spark, *BIRDS), str(tmp_path))
    assert got["load_run_id"] == 52 and not list((tmp_path / "_staging").glob("*"))
    store = WarehouseStore(spark, str(tmp_path))
    quality = {r.load_run_id: r.status for r in views.data_quality(store.read()).collect()}
    assert quality == {1: "SUCCEEDED", 2: "SUCCEEDED", **dict.fromkeys(range(3, 52), "FAILED"), 52: "SUCCEEDED"}
    assert store.read().dim_instrument.count() == 3 and store.read().fact_daily_price.count() == 12
    assert str(tmp_path / "dim_sector" / "run=51") in store.vacuum() and not (tmp_path / "dim_sector" / "run=51").exists()
