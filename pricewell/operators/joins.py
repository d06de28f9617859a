"""Distributed ordered keys, and the join with a list of bounded size."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


# A list of at most so many rows is sent to every task instead of dealing the rows it is joined with.
LIST_ROWS = 1_000_000


def bounded_list(df: DataFrame, rows: int = LIST_ROWS) -> DataFrame:
    """``df``, to be broadcast if it has at most ``rows`` rows; they are counted when this is called.
    A longer one is left to the session, which joins it by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def dealt_wide(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` dealt by ``cols`` over as many tasks as the session's shuffles have. For slim rows that
    cost much behind the exchange: joined to partitions of a size, they make fewer and longer tasks
    than a cluster has cores for."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def with_ordered_index(df: DataFrame, order_cols: list[str], name: str, start=0) -> DataFrame:
    """Append a dense 1-based index ``start + rank`` in the order of ``order_cols``.

    Distributed version of "row_number over the whole table": rows are range-partitioned,
    sorted and checkpointed once; each row gets ``monotonically_increasing_id`` (partition id in
    the high bits, position in the low 33 bits) and a per-partition row-count table (one row per
    partition, broadcast) turns that into a dense index. No step moves the table into one task.

    The checkpoint matters: range bounds come from sampling, so two separate executions of the
    range exchange could split rows differently; both the counts and the final rows must see the
    same partitions. It runs when this is called, so only the load job calls it, never a query.
    ``order_cols`` must be unique. ``start`` may be a Column (e.g. a scalar subquery) or an int.
    """
    ensure_checkpoint_dir(df.sparkSession)
    mask = (1 << 33) - 1
    ranged = (df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
              .checkpoint(eager=True)
              .withColumn("_mid", F.monotonically_increasing_id())
              .withColumn("_pid", F.shiftright("_mid", 33))
              .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(mask))))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    start_col = start if not isinstance(start, int) else F.lit(start)
    # one row per partition: bounded by the partition count, so broadcast by construction
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (start_col + F.col("_off") + F.col("_pos") + 1).cast("int"))
            .drop("_mid", "_pid", "_pos", "_off"))
