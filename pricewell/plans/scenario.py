"""Warehouse states the registered queries read, loaded from the tape by the load job itself.

* ``full_load``: one run (id 1) over every file of the tape.
* ``two_runs``: run 1 loads every file but the newest; run 2 fails while it reads its feed; run 3
  reloads the two newest files, so it overlaps run 1 by one file, adds calendar days, replaces the
  overlapped date ranges and appends the rest.

Each state is loaded once for a session and input folder, into a warehouse below the shared
checkpoint folder. Ledger timestamps are fixed values so an independent SQL engine can repeat them.
"""
from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tape import tape_files, tape_instruments, tape_prices
from ..sources.warehouse import WarehouseStore
from .job import run_load

# Ledger clock of the runs (UTC).
RUN_CLOCK = {
    1: (dt.datetime(2025, 1, 6, 18, 0, 0), dt.datetime(2025, 1, 6, 18, 0, 23)),
    2: (dt.datetime(2025, 1, 7, 9, 30, 0), dt.datetime(2025, 1, 7, 9, 30, 5)),
    3: (dt.datetime(2025, 1, 7, 18, 0, 0), dt.datetime(2025, 1, 7, 18, 0, 19)),
}
_LOADED: dict[tuple[str, str, str], str] = {}


def tape(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return tape_prices(spark, sf_dir), tape_instruments(spark, sf_dir)


def split_files(raw: DataFrame, files: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(all files but the newest, the two newest files), by file name order.

    Both bounds come from the two last of the distinct file names (``files``, else those of the
    rows), looked up once.
    """
    names = raw.select("source_file").distinct() if files is None else files
    last = names.orderBy(F.desc("source_file")).limit(2)
    newest, second = map(F.lit, last.agg(F.max("source_file"), F.min("source_file")).head())
    return raw.filter(F.col("source_file") < newest), raw.filter(F.col("source_file") >= second)


def _load(raw: DataFrame, inst: DataFrame, root: str, run: int) -> None:
    run_load(raw.sparkSession, raw, inst, root, clock=iter(RUN_CLOCK[run]).__next__)


def _fail(raw: DataFrame, inst: DataFrame, root: str) -> None:
    """A run whose feed cannot be read to its end."""
    broken = raw.withColumn("raw_record", F.raise_error(F.lit("feed ends early")).cast("string"))
    try:
        _load(broken, inst, root, 2)
    except Exception as exc:
        if "feed ends early" not in str(exc):
            raise


def _state(spark: SparkSession, sf_dir: str, kind: str) -> WarehouseStore:
    key = (spark.sparkContext.applicationId, str(sf_dir), kind)
    if key not in _LOADED:
        root = f"{ensure_checkpoint_dir(spark)}/warehouse-{kind}-{uuid.uuid4().hex}"
        raw, inst = tape(spark, sf_dir)
        if kind == "full":
            _load(raw, inst, root, 1)
        else:
            first, second = split_files(raw, tape_files(spark, sf_dir))
            _load(first, inst, root, 1)
            _fail(second, inst, root)
            _load(second, inst, root, 3)
        _LOADED[key] = root
    return WarehouseStore(spark, _LOADED[key])


def full_load(spark: SparkSession, sf_dir: str) -> WarehouseStore:
    return _state(spark, sf_dir, "full")


def two_runs(spark: SparkSession, sf_dir: str) -> WarehouseStore:
    return _state(spark, sf_dir, "two")


__all__ = ["RUN_CLOCK", "full_load", "split_files", "tape", "two_runs"]
