"""Embedding near-dedup by random-hyperplane sign hashing.

A vector's signs against random hyperplanes are cut into the keys of several tables of ``bits`` signs;
vectors of a label with equal keys in a table share a bucket. ``bits`` follows the number of rows of
the largest label (a bucket holds about ``BUCKET`` unrelated vectors at any size) and the number of
tables follows from the chance ``miss`` that a pair exactly at the threshold shares no bucket; closer
pairs are missed far more rarely.

Buckets are compared twice. First by the leading ``SKETCH`` signs alone, 32 bytes a row however long
the vector and however many the tables: a row stays in a bucket only if some other row of it differs
in few signs. ``miss`` bounds that step as well. Then vectors are fetched for the rows that stay and
pairs are compared exactly, by cosine in double precision. A pair that meets in several tables counts
in the first only.

Equal vectors are one row before hashing. Buckets above ``CELL`` rows are dealt to cells in which any
two rows meet once, so a bucket holding a third of all vectors is compared by many tasks. A cell
returns the rows that stay, or the number of links of each row and a spanning forest of them, never
all pairs.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import components, forest, stored, whole_groups

THRESHOLD, MISS, SEED = 0.93, 1e-4, 20240229
BUCKET, CELL, SKETCH = 64, 512, 256
SPOT = ["label", "dim", "spot", "pair"]


def plan(rows: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int, int]:
    """(bits, tables, cut) for a label of ``rows`` vectors. Two vectors at the threshold agree in a
    sign with chance 1 - angle / pi, in a table with that to the power of bits. They differ in more
    than ``cut`` signs of the sketch with a hundredth of ``miss``, the tables have the rest."""
    bits = min(30, max(4, math.ceil(math.log2(max(rows, 1) / BUCKET))))
    same = 1 - math.acos(threshold) / math.pi
    tables = max(1, math.ceil(math.log(0.99 * miss) / math.log1p(-same ** bits)))
    beyond, cut = 1.0, -1
    while beyond > 0.01 * miss and cut < SKETCH:
        cut += 1
        beyond -= math.comb(SKETCH, cut) * (1 - same) ** cut * same ** (SKETCH - cut)
    return bits, tables, cut


def _signs(bits: int, tables: int):
    """Adds to each row its signs, packed: those of the keys first, SKETCH at least."""
    total = max(SKETCH, -(-bits * tables // 8) * 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column("embedding")
            at = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            size = np.diff(at)
            packed = np.zeros((batch.num_rows, total // 8), np.uint8)
            for dim in np.unique(size):
                if dim not in planes:
                    planes[dim] = np.random.default_rng([SEED, int(dim)]).standard_normal((int(dim), total))
                own = np.flatnonzero(size == dim)
                for rows in np.split(own, range(1024, len(own), 1024)):
                    v = flat[at[rows][:, None] + np.arange(dim)]
                    signs = (v / np.sqrt((v * v).sum(axis=1, keepdims=True))) @ planes[dim] >= 0
                    packed[rows] = np.packbits(signs, axis=1, bitorder="little")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r.tobytes() for r in packed], pa.binary())],
                                             [*batch.schema.names, "signs"])
    return run


def _keys(packed: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The keys of the first ``tables`` tables, from packed signs."""
    signs = np.unpackbits(packed, axis=1, count=bits * tables, bitorder="little")
    return signs.reshape(len(packed), tables, bits) @ (1 << np.arange(bits, dtype=np.int32))


def _spots(bits: int, tables: int):
    """A row's place in each table (``table << 32 | key``) with its sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r0 in range(0, batch.num_rows, 2048):
                part = batch.slice(r0, 2048)
                packed = np.frombuffer(b"".join(part.column("signs").to_pylist()), np.uint8).reshape(part.num_rows, -1)
                spot = (np.arange(tables, dtype=np.int64) << 32) | _keys(packed, bits, tables)
                row = pa.array(np.repeat(np.arange(part.num_rows), tables))
                sketch = pa.array([r.tobytes() for r in packed[:, :SKETCH // 8]], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep").take(row), part.column("label").take(row), part.column("dim").take(row),
                     pa.array(spot.ravel()), sketch.take(row)], ["rep", "label", "dim", "spot", "sketch"])
    return run


def first_met(keys: np.ndarray, table: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row pairs (i, j) that share no key in the tables before ``table``."""
    for u in range(min(table, keys.shape[1])):
        apart = keys[i, u] != keys[j, u]
        i, j = i[apart], j[apart]
        if not len(i):
            break
    return i, j


def _close(bits: int, tables: int, cut: int):
    """Rows of a cell that differ from another one, met here first, in at most ``cut`` signs."""
    known = min(tables, SKETCH // bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, SPOT):
            t = t.combine_chunks()
            packed = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(t.num_rows, -1)
            words, blk = packed.view(np.uint64), t.column("blk").to_numpy()
            table, pair = t.column("spot").to_numpy() >> 32, t.column("pair").to_numpy()
            stay = np.zeros(t.num_rows, bool)
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                keys = None
                for r0 in range(s, e - 1, 256):
                    r1 = min(r0 + 256, e)
                    differ = np.zeros((r1 - r0, e - r0), np.uint16)
                    for w in range(words.shape[1]):
                        differ += np.bitwise_count(words[r0:r1, None, w] ^ words[None, r0:e, w])
                    i, j = np.nonzero(np.triu(differ <= cut, 1))
                    if not len(i):
                        continue
                    if pair[s] >> 31 != pair[s] & 0x7FFFFFFF:
                        other = blk[r0 + i] != blk[r0 + j]
                        i, j = i[other], j[other]
                    if keys is None:
                        keys = _keys(packed[s:e], bits, known)
                    i, j = first_met(keys, int(table[s]), i + r0 - s, j + r0 - s)
                    stay[s + i] = stay[s + j] = True
            if stay.any():
                yield from t.filter(pa.array(stay)).select([*SPOT, "blk", "rep"]).combine_chunks().to_batches()
    return run


def _links(threshold: float, bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, SPOT):
            n = t.num_rows
            t = t.combine_chunks()
            table, pair, blk = t.column("spot").to_numpy() >> 32, t.column("pair").to_numpy(), t.column("blk").to_numpy()
            rep, copies, dim = t.column("rep").to_numpy(), t.column("n").to_numpy(), t.column("dim").to_numpy()
            packed = np.frombuffer(b"".join(t.column("signs").to_pylist()), np.uint8).reshape(n, -1)
            flat = t.column("embedding").chunk(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            first = np.append(0, np.cumsum(dim))
            a_all, b_all = [], []
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                v = flat[first[s]:first[e]].reshape(e - s, int(dim[s]))
                v = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
                # a first look at all pairs of the cell; pairs near the threshold are computed alone
                i, j = np.nonzero(np.triu(v @ v.T >= threshold - 1e-9, 1))
                if not len(i):
                    continue
                if pair[s] >> 31 != pair[s] & 0x7FFFFFFF:
                    other = blk[s + i] != blk[s + j]
                    i, j = i[other], j[other]
                i, j = first_met(_keys(packed[s:e], bits, tables), int(table[s]), i, j)
                for c in range(0, len(i), 65536):
                    ci, cj = i[c:c + 65536], j[c:c + 65536]
                    ok = (v[ci] * v[cj]).sum(axis=1) >= threshold
                    a_all.append(ci[ok] + s)
                    b_all.append(cj[ok] + s)
            if not a_all:
                continue
            a, b = np.concatenate(a_all), np.concatenate(b_all)
            met = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
            # rows of one cell only are linked, so the forest over the whole table stays within cells
            label = forest(n, a, b)
            at = np.flatnonzero(met)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep[at]), pa.array(met[at].astype(np.int64)), pa.array(rep[label[at]])], ["rep", "met", "root"])
    return run


def _cells(spots: DataFrame, most: int) -> DataFrame:
    """Adds ``pair`` (``lo << 31 | hi``) and ``blk``: a bucket above ``most`` rows is cut into blocks
    by the hash of ``rep``, and a row goes to the cell of its block with each block. Only the sizes of
    such buckets are joined, so others are shuffled once, to their cell."""
    keys = SPOT[:3]
    large = stored(spots.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
                   .select(*keys, F.ceil(F.col("_n") / F.lit(most)).cast("int").alias("_blocks")), "sizes")
    blocks = F.coalesce("_blocks", F.lit(1))
    return (spots.join(large, keys, "left")
            .withColumn("blk", F.pmod(F.xxhash64("rep", F.lit("block")), blocks).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("pair", F.shiftleft(F.least("blk", "_other").cast("long"), 31) + F.greatest("blk", "_other"))
            .drop("_blocks", "_other"))


def _by_cell(df: DataFrame) -> DataFrame:
    return df.repartition(*SPOT).sortWithinPartitions(*SPOT)


def _digest() -> list[Column]:
    """128 bits of a label and a vector; equal vectors have equal ones, also where zeros differ in sign."""
    return [F.xxhash64("label", "embedding").alias("d1"), F.xxhash64(F.lit("second"), "embedding", "label").alias("d2")]


def near_dedup(vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, cell: int = CELL) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links (other rows linked
    directly), component_id (smallest vec_id reachable, itself included), kept (vec_id = component_id).

    Rows link when labels are equal and not null, lengths are equal and the cosine is at least
    ``threshold``. Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing. Components are floats or doubles; other numbers are taken as doubles. Repeated rows, of
    one vec_id or several, are rows of their own and link like copies. A row without vec_id links too;
    a component of such rows only has a null component_id. An empty table gives an empty result; other
    columns are ignored.
    """
    rows = vectors.select("vec_id", "embedding", "label")
    if not isinstance(rows.schema["embedding"].dataType.elementType, (T.FloatType, T.DoubleType)):
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    sound = F.expr("label is not null and embedding is not null and size(embedding) > 0 "
                   "and not exists(embedding, x -> x is null or isnan(x) or abs(x) = float('inf')) "
                   "and exists(embedding, x -> x <> 0)")
    largest = rows.filter("label is not null").groupBy("label").count().agg(F.max("count")).head()[0] or 0
    bits, tables, cut = plan(largest, threshold, miss)
    # one row per distinct vector; rep is a number of the row's own, since vec_id may repeat or be null
    distinct = (rows.filter(F.coalesce(sound, F.lit(False))).groupBy("label", "embedding")
                .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
                .withColumn("rep", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema.fields)
    reps = stored(distinct.mapInArrow(_signs(bits, tables), f"{schema}, signs binary"), "vectors")
    label = reps.schema["label"].dataType.simpleString()
    spots = reps.select("rep", "label", "dim", "signs").mapInArrow(
        _spots(bits, tables), f"rep long, label {label}, dim int, spot long, sketch binary")
    close = _by_cell(_cells(spots, cell)).mapInArrow(
        _close(bits, tables, cut), f"label {label}, dim int, spot long, pair long, blk int, rep long")
    compared = close.join(reps.select("rep", "n", "embedding", "signs"), "rep")
    found = stored(_by_cell(compared).mapInArrow(_links(threshold, bits, tables), "rep long, met long, root long"), "links")
    met = found.groupBy("rep").agg(F.sum("met").alias("met"))
    nodes = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    slim = reps.select("rep", "n", "least", *_digest())
    rooted = slim.join(met, "rep", "left").join(nodes, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_vector = rooted.join(least, "root").select(
        "d1", "d2", (F.coalesce("met", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    joined = rows.select("vec_id", *_digest()).join(by_vector, ["d1", "d2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
