"""Spark helpers of the operators: shared scratch tables, bounded cells, connected components."""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# The separators of the contracts: space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/llm-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application. Results are lazy and read them, so only
    when all results are written."""
    _delete(spark, scratch_root(spark))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps and retried tasks start
    from files that every executor sees, and Python steps above it do not run twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that no later step reads."""
    if path := getattr(df, "_scratch", None):
        _delete(df.sparkSession, path)


def pair_cells(df: DataFrame, keys: list[str], unit: Column, most: int,
               payload: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Deal the rows of each key to cells so that any two rows of a key meet in exactly one cell.

    A key of n rows is cut into ``ceil(n / most)`` blocks by the hash of ``unit``; a row goes to the
    cell of its block with each block of the key, so a cell holds about ``2 * most`` rows however
    large the key is. Keys with one row have no pair and are left out. Adds ``blk``, ``lo``, ``hi``:
    a cell with ``lo < hi`` compares rows of different ``blk`` only. ``payload`` may join what the
    comparison needs to the rows that are left. The output is partitioned and sorted by cell.
    """
    # written first: a join with an aggregate's output in its own stage can't have skewed keys split
    sizes = stored(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
                   .select(*keys, F.ceil(F.col("_n") / F.lit(most)).cast("int").alias("_blocks")), "sizes")
    dealt = (df.join(sizes, keys)
             .withColumn("blk", F.pmod(F.xxhash64(unit, F.lit("block")), F.col("_blocks")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
             .withColumn("lo", F.least("blk", "_other")).withColumn("hi", F.greatest("blk", "_other"))
             .drop("_blocks", "_other"))
    if payload is not None:
        dealt = payload(dealt)
    cell = [*keys, "lo", "hi"]
    return dealt.repartition(*cell).sortWithinPartitions(*cell)


def row_number_of() -> Column:
    """A number for each row, fixed once the table is ``stored``: the writing task and a count."""
    return F.monotonically_increasing_id().alias("rid")


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (a stored table with ``rid``) with ``nth``: rows with equal ``keys`` (nulls are equal)
    get 0, 1, 2, ..., which of them gets which follows ``rid``.

    A key's rows are numbered task by task that wrote them, after a sum over the tasks before, so a
    key with a third of all rows is numbered by many tasks. Only rows of repeated keys are shuffled.
    """
    task = F.shiftright("rid", 33)
    of_key = Window.partitionBy(*keys)
    counts = rows.groupBy(*keys, task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    again = stored(counts.withColumn("_all", F.sum("_n").over(of_key))
                   .withColumn("_before", F.sum("_n").over(of_key.orderBy("_task")) - F.col("_n"))
                   .filter("_all > 1").select(*[F.col(k).alias(f"_{k}") for k in keys], "_task", "_before"), "repeats")
    same = F.col("_task") == task
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = rows.join(again, same, "left")
    among = F.row_number().over(Window.partitionBy(*keys, "_task").orderBy("rid")) - 1
    own = [*rows.columns, "nth"]
    return (joined.filter("_before is null").withColumn("nth", F.lit(0).cast("long")).select(*own)
            .union(joined.filter("_before is not null").withColumn("nth", F.col("_before") + among).select(*own)))


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Cut a stream sorted by ``keys`` into tables of whole groups; also yields the row number at
    which each group starts, and the end. Holds one batch and one group at a time."""
    held: pa.Table | None = None

    def starts(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for k in keys:
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
        at = starts(t)
        if len(at) > 1:
            yield t.slice(0, at[-1]), at
        held = t.slice(at[-1])
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels of the components of the graph on 0..n-1 with edges (a, b): the smallest member."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): (node, root), root the smallest node
    reachable, for every node of an edge.

    Alternating large-star and small-star rounds: each replaces a node's links by links to the
    smallest neighbour. A round groups with map-side minima and joins the links with one row per
    node, written first, so that AQE can split a hub's links. Rounds end when nothing changes; they
    are about logarithmic in the longest path. Each round is written to the shared folder.
    """
    spark = edges.sparkSession

    def links(df: DataFrame) -> DataFrame:
        return df.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()

    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).head()
        return r.n, r.x

    now = stored(links(edges), "links")
    seen = mark(now)
    while seen[0]:
        # large star: the larger neighbours of u move to the smallest of u's neighbours and u
        least = stored(now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
                       .groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m")), "least")
        large = now.join(least, now.v == least.c).select(F.col("u").alias("a"), F.col("m").alias("b"))
        large = stored(links(large), "links")
        drop_stored(least)
        # small star: u and its smaller neighbours move to the smallest of them
        least = stored(large.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")), "least")
        both = large.join(least, large.u == least.c)
        small = links(both.select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
                                                    F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("e"))
                      .select("e.a", "e.b"))
        new = stored(small, "links")
        for done in (now, large, least):
            drop_stored(done)
        now, before, seen = new, seen, mark(new)
        if seen == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
