"""Parquet warehouse store: tables per load run, a run ledger, atomic commit by ledger event.

Layout under the warehouse root (any Hadoop file system)::

    etl_load_run/event=<seq>/           one small file per ledger event (RUNNING, SUCCEEDED, FAILED)
    etl_run_file/run=<id>/              the files run <id> read
    dim_sector/run=<id>/                rows inserted by run <id> (dimensions are insert-only)
    dim_instrument/run=<id>/
    dim_date/run=<id>/
    dim_*/run=base-<id>/                after ``compact``: the rows of all runs up to <id>
    fact_daily_price/run=<id>/fact_year=<y>/fact_bucket=<b>/
                                        the full content of that year and bucket of instruments
    etl_rejected_row/run=<id>/
    _staging/run=<id>/<name>/           intermediate tables of run <id>; deleted when it ends

A run's outputs become visible only when its SUCCEEDED ledger event exists; readers ignore every
directory of other runs, so a failed run changes nothing, and the ledger itself shows every run.
The SUCCEEDED event carries the live state: the number of buckets, the run up to which dimensions are
compacted, and for each year and bucket which run's directory holds it and which runs' rows it has.
A reload rewrites only the buckets of the instruments and the years it replaces, so reloading one
ticker touches one bucket a year; ``vacuum`` deletes what no live map names. One writer at a time is
assumed (as a database lock would give), so a run that is still RUNNING when the next one begins
has died: it is closed as FAILED and cleared.
"""
from __future__ import annotations

import datetime as dt
import posixpath
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

from ..plans.load import LEDGER_COLS, Warehouse
from ..plans.schema import SCHEMAS, with_parts

# Instruments are dealt to so many buckets in each year of the fact table of a new warehouse; one
# that exists keeps the number it was begun with.
BUCKETS = 16

LEDGER_SCHEMA = StructType([
    StructField("load_run_id", IntegerType()), StructField("event_seq", LongType()),
    StructField("started_at", TimestampType()), StructField("finished_at", TimestampType()),
    StructField("status", StringType()),
    StructField("rows_read", LongType()), StructField("rows_loaded", LongType()),
    StructField("rows_rejected", LongType()), StructField("error_message", StringType()),
    StructField("fact_map", StringType()),
])

Part = tuple[int, int]
FACT_RUN = "fact_year int, fact_bucket int, load_run_id int"


def bucket_of(instrument_key, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(instrument_key), F.lit(buckets)).cast("int")


@dataclass
class State:
    """What a SUCCEEDED event says about the whole warehouse. As text:
    ``buckets;base|year/bucket:folder=run+run,...``."""
    buckets: int = BUCKETS
    base: int = 0                                                    # dimensions are compacted up to this run
    folder: dict[Part, int] = field(default_factory=dict)            # the run whose directory holds a part
    runs: dict[Part, tuple[int, ...]] = field(default_factory=dict)  # the runs whose rows it has

    def text(self) -> str:
        parts = ",".join(f"{y}/{b}:{run}={'+'.join(map(str, self.runs[y, b]))}" for (y, b), run in sorted(self.folder.items()))
        return f"{self.buckets};{self.base}|{parts}"

    @classmethod
    def parse(cls, text: str | None) -> "State":
        if not text:
            return cls()
        head, _, parts = text.partition("|")
        state = cls(*map(int, head.split(";")))
        for entry in filter(None, parts.split(",")):
            part, _, held = entry.partition(":")
            folder, _, runs = held.partition("=")
            key = tuple(map(int, part.split("/")))
            state.folder[key], state.runs[key] = int(folder), tuple(map(int, runs.split("+")))
        return state


class WarehouseStore:
    def __init__(self, spark: SparkSession, root: str, cache_ledger: bool = False, buckets: int = BUCKETS):
        """``buckets``: of a new warehouse. ``cache_ledger``: keep the run states between reads until this store appends an event.
        Only the (single) writer of a run should set it; readers see other writers' events only
        without it."""
        self.spark = spark
        self.root = str(root).rstrip("/")
        self._new_buckets = buckets
        self._cache_ledger = cache_ledger
        self._ledger_cache: list | None = None

    def path(self, *parts) -> str:
        return posixpath.join(self.root, *[str(p) for p in parts])

    # ------------------------------------------------------------ ledger

    def ledger_events(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path("etl_load_run"))
        except AnalysisException:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)

    def _states(self) -> DataFrame:
        last = F.max_by(F.struct(*[c for c in LEDGER_SCHEMA.fieldNames() if c != "load_run_id"]), "event_seq")
        return self.ledger_events().groupBy("load_run_id").agg(last.alias("_e")).select("load_run_id", "_e.*")

    def ledger(self) -> DataFrame:
        """One row per run, whatever became of it: its latest event."""
        return self._states().select(*LEDGER_COLS)

    def run_states(self) -> list:
        """(load_run_id, status, started_at, fact_map) of each run on the driver; the last is a ``State``."""
        if self._ledger_cache is not None:
            return self._ledger_cache
        rows = sorted(self._states().select("load_run_id", "status", "started_at", "fact_map").collect(), key=lambda r: r.load_run_id)
        if self._cache_ledger:
            self._ledger_cache = rows
        return rows

    def append_event(self, run_id: int, status: str, started_at: dt.datetime, finished_at=None,
                     rows=(None, None, None), error_message=None, state: State | None = None) -> None:
        seq = int(dt.datetime.now(dt.timezone.utc).timestamp() * 1_000_000)
        row = (run_id, seq, started_at, finished_at, status, *rows, error_message, state and state.text())
        (self.spark.createDataFrame([row], LEDGER_SCHEMA).coalesce(1)
         .write.mode("overwrite").parquet(self.path("etl_load_run", f"event={seq}")))
        self._ledger_cache = None

    def close_dead_runs(self) -> list[int]:
        """End runs that are RUNNING though no one writes: FAILED, their intermediate tables deleted."""
        dead = [r for r in self.run_states() if r.status == "RUNNING"]
        for r in dead:
            self.append_event(r.load_run_id, "FAILED", r.started_at, error_message="the run ended without a result")
            self.drop_staging(r.load_run_id)
        return [r.load_run_id for r in dead]

    def next_run_id(self) -> int:
        return max((r.load_run_id for r in self.run_states()), default=0) + 1

    # ------------------------------------------------------------ reading committed tables

    def committed_runs(self, as_of: int | None = None) -> list[int]:
        return [r.load_run_id for r in self.run_states()
                if r.status == "SUCCEEDED" and (as_of is None or r.load_run_id <= as_of)]

    def state(self, as_of: int | None = None) -> State:
        """The state of the newest commit."""
        done = self.committed_runs(as_of)
        text = next((r.fact_map for r in self.run_states() if done and r.load_run_id == done[-1]), None)
        return State.parse(text) if text else State(self._new_buckets)

    def fact_map(self, as_of: int | None = None) -> dict[Part, int]:
        """Which run's directory holds each (year, bucket)."""
        return self.state(as_of).folder

    def _runs_table(self, name: str, runs: list[int]) -> DataFrame:
        schema = SCHEMAS[name]
        base = self.state().base if name.startswith("dim_") and runs else 0
        # an older state than the compacted one is read from the runs' own directories
        base = base if base in runs else 0
        paths = [self.path(name, f"run=base-{base}")] * bool(base) + [self.path(name, f"run={r}") for r in runs if r > base]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(*paths)
                .select(*schema.fieldNames()))

    def read_run_table(self, name: str, run_id: int) -> DataFrame:
        """The rows of a table that one run wrote."""
        return self._runs_table(name, [run_id])

    def read_dim(self, name: str, extra_runs: list[int] = ()) -> DataFrame:
        """Committed rows of an insert-only dimension plus those of ``extra_runs``."""
        return self._runs_table(name, self.committed_runs() + list(extra_runs))

    def read_fact(self, parts: list[Part] | None = None, fact_map: dict[Part, int] | None = None) -> DataFrame:
        """Live fact rows (optionally of some parts only), with the partition columns, on which a
        filter prunes directories. Only the directories the map names are listed and read."""
        live = self.fact_map() if fact_map is None else fact_map
        by_run: dict[int, list[str]] = {}
        for part in sorted(live if parts is None else parts):
            year, bucket = part
            by_run.setdefault(live[part], []).append(f"fact_year={year}/fact_bucket={bucket}")
        schema = with_parts(SCHEMAS["fact_daily_price"])
        out = None
        for run, folders in sorted(by_run.items()):
            base = self.path("fact_daily_price", f"run={run}")
            one = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
            out = one if out is None else out.unionByName(one)
        return self.spark.createDataFrame([], schema) if out is None else out

    def read_written_fact(self, run_id: int) -> DataFrame:
        """All rows of the parts that one run wrote."""
        return self.spark.read.schema(with_parts(SCHEMAS["fact_daily_price"])).parquet(self.path("fact_daily_price", f"run={run_id}"))

    def read(self, as_of: int | None = None) -> Warehouse:
        """The committed warehouse (as of a run, if given and not vacuumed) and the whole ledger."""
        runs = self.committed_runs(as_of)
        return Warehouse(
            **{name: self._runs_table(name, runs) for name in ("dim_sector", "dim_instrument", "dim_date", "etl_rejected_row", "etl_run_file")},
            fact_daily_price=self.read_fact(fact_map=self.fact_map(as_of)),
            fact_run=self.spark.createDataFrame([(*part, run) for part, runs in sorted(self.state(as_of).runs.items()) for run in runs], FACT_RUN),
            etl_load_run=self.ledger(),
        )

    # ------------------------------------------------------------ writing a run's outputs

    def write_run_table(self, name: str, run_id: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.path(name, f"run={run_id}"))

    def stage(self, run_id: int, name: str, df: DataFrame) -> DataFrame:
        """Write an intermediate table of the run and return it read back (cuts the lineage, so
        later steps and retried tasks start from the written files)."""
        p = self.path("_staging", f"run={run_id}", name)
        df.write.mode("overwrite").parquet(p)
        return self.spark.read.schema(df.schema).parquet(p)

    def write_fact_parts(self, run_id: int, df: DataFrame) -> None:
        """Write fact rows by year and bucket, sorted by (instrument_key, date_key) so the Parquet
        min/max statistics prune on both keys.

        A rebalanced exchange: AQE splits a part of more than the session's advisory size over as
        many tasks as it needs, each of which writes a file, and joins small parts in one task.
        """
        order = ["fact_year", "fact_bucket", "instrument_key", "date_key"]
        (df.withColumn("fact_year", (F.col("date_key") / 10000).cast("int"))
         .withColumn("fact_bucket", bucket_of("instrument_key", self.state().buckets))
         .hint("rebalance", "fact_year", "fact_bucket").sortWithinPartitions(*order)
         .write.mode("overwrite").partitionBy("fact_year", "fact_bucket")
         .parquet(self.path("fact_daily_price", f"run={run_id}")))

    def written_state(self, run_id: int, parts: list[Part]) -> State:
        """The live state with ``parts`` replaced by what run ``run_id`` wrote; a part that has no
        rows any more is left out."""
        now = self.state()
        held = self.read_written_fact(run_id) if parts else None
        found = held.select("fact_year", "fact_bucket", "load_run_id").distinct().collect() if parts else []
        for part in parts:
            now.folder.pop(part, None), now.runs.pop(part, None)
        for r in sorted(found):
            key = (r.fact_year, r.fact_bucket)
            now.folder[key], now.runs[key] = run_id, (*now.runs.get(key, ()), r.load_run_id)
        return now

    # ------------------------------------------------------------ clearing

    def _delete(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def drop_staging(self, run_id: int) -> None:
        self._delete(self.path("_staging", f"run={run_id}"))

    def compact(self) -> None:
        """Bring the ledger's events into one directory, and each dimension's rows into one, so that
        readers list a few directories however many runs there were. What was read before stays
        until ``vacuum``; a reader sees the old or the new state."""
        done = self.committed_runs()
        if done and self.state().base < done[-1]:
            for name in ("dim_sector", "dim_instrument", "dim_date"):
                self.read_dim(name).write.mode("overwrite").parquet(self.path(name, f"run=base-{done[-1]}"))
            state = self.state()
            state.base = done[-1]
            last = self.ledger().filter(F.col("load_run_id") == done[-1]).head()
            self.append_event(done[-1], "SUCCEEDED", last.started_at, last.finished_at,
                              (last.rows_read, last.rows_loaded, last.rows_rejected), state=state)
        old = [r.event for r in self.ledger_events().select(F.col("event").cast("string").alias("event")).distinct().collect()]
        # events that are in both directories for a moment are the same events
        events = self.ledger_events().select(*LEDGER_SCHEMA.fieldNames()).distinct()
        seq = int(dt.datetime.now(dt.timezone.utc).timestamp() * 1_000_000)
        events.coalesce(1).write.mode("overwrite").parquet(self.path("etl_load_run", f"event={seq}"))
        for event in old:
            self._delete(self.path("etl_load_run", f"event={event}"))
        self._ledger_cache = None

    def vacuum(self) -> list[str]:
        """Delete fact directories that the newest commit does not name, dimension rows that are in
        the compacted directory, and what failed runs left; returns them. Readers of an older state
        must be done."""
        live, states = self.state(), self.run_states()
        dims = ("dim_sector", "dim_instrument", "dim_date")
        gone = []
        for state in states:
            run = f"run={state.load_run_id}"
            if state.status == "FAILED":
                gone += [self.path(t, run) for t in (*dims, "fact_daily_price", "etl_rejected_row", "etl_run_file", "_staging")]
            elif state.status == "SUCCEEDED":
                gone += [self.path("fact_daily_price", run, f"fact_year={y}", f"fact_bucket={b}")
                         for (y, b), r in self.fact_map(state.load_run_id).items()
                         if r == state.load_run_id and live.folder.get((y, b)) != r]
                if state.load_run_id <= live.base:
                    gone += [self.path(t, run) for t in dims]
                    gone += [self.path(t, f"run=base-{state.load_run_id}") for t in dims if state.load_run_id < live.base]
        return [p for p in gone if self._delete(p)]


def export_extracts(wh: Warehouse, out_dir: str) -> list[str]:
    """CSV extracts of the tables (header row, one directory per table), for tools that read
    text files. Each table is written by the executors in parallel; nothing passes the driver."""
    from ..plans.load import TABLES
    paths = []
    for name in TABLES:
        p = posixpath.join(str(out_dir).rstrip("/"), name)
        getattr(wh, name).drop("fact_year", "fact_bucket").write.mode("overwrite").option("header", True).csv(p)
        paths.append(p)
    return paths
