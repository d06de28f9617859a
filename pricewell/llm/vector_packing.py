"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

The unit is a group of equal texts, a vector of its bytes, tokens and rows. Each unit goes to the
shard where the dot product of its vector with the shard's residual capacity is highest, largest
units first. Only what is bounded is packed one by one: groups above ``HEAVY`` of a shard's share in
some dimension (at most 3 * shards / HEAVY of them; those above a whole shard are split by the hash
of doc_id and, among rows that repeat one, a number), and bundles that hold all other groups. A group's hash chooses its bundle; bundles come
in ``LEVELS`` sizes, each half the one before, so that the last ones level what the first leave.
Where a row goes is then a narrow step. Places within a shard come from counts per shard and hash
range, so no task sees a whole shard.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .mix_threshold import word_count
from .shared import numbered, row_number_of, stored

SHARDS = 24
HEAVY, LEVELS, BUNDLES = 1 / 64, 10, 512
RANGES = 1024
LAW = "bytes"


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each vector (rows: bytes, tokens, rows; in shares of one shard's capacity): largest
    first, to the highest dot product with the residual capacity; then levelled."""
    left = np.ones((shards, vectors.shape[1]))
    out = np.zeros(len(vectors), np.int64)
    for i in np.argsort(-vectors.sum(axis=1), kind="stable"):
        out[i] = int(np.argmax(left @ vectors[i]))
        left[out[i]] -= vectors[i]
    return level(vectors, out, left)


def level(vectors: np.ndarray, out: np.ndarray, left: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Swap or move single units between the shards with most and least bytes while the sum of
    squared residuals, bytes weighing most, falls; matters where units are few and coarse."""
    weight = np.array([16.0, 1.0, 1.0])
    for _ in range(rounds * len(left)):
        full, bare = int(left[:, 0].argmin()), int(left[:, 0].argmax())
        a, b = np.flatnonzero(out == full), np.flatnonzero(out == bare)
        other = np.vstack([vectors[b], np.zeros((1, vectors.shape[1]))])
        best = None
        for at in range(0, len(a), 512):
            d = vectors[a[at:at + 512], None, :] - other[None, :, :]
            gain = ((2 * d * (left[bare] - left[full] - d)) * weight).sum(axis=2)
            k = np.unravel_index(gain.argmax(), gain.shape)
            if best is None or gain[k] > best[0]:
                best = gain[k], a[at + k[0]], k[1], d[k]
        if best is None or best[0] <= 1e-12:
            break
        _, i, j, d = best
        out[i] = bare
        if j < len(b):
            out[b[j]] = full
        left[full] += d
        left[bare] -= d
    return out


def measures() -> list[Column]:
    """size (UTF-8 bytes of the text and 8), text_crc32, tokens (words), and the digest of the text."""
    raw = F.coalesce(F.col("text"), F.lit(""))
    return [(F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
            word_count().alias("tokens"), F.md5(raw).alias("digest")]


def bundle() -> Column:
    """Level by the leading bits of the digest (half of all groups in level 0, a quarter in 1, ...),
    and one of BUNDLES within."""
    h = F.conv(F.substring("digest", 1, 6), 16, 10).cast("int")
    level = sum((F.when(h < (1 << (24 - k)), 1).otherwise(0) for k in range(1, LEVELS)), F.lit(0))
    return level * BUNDLES + F.conv(F.substring("digest", 7, 6), 16, 10).cast("int") % BUNDLES


def piece(pieces: Column) -> Column:
    return F.pmod(F.xxhash64("doc_id", "nth"), pieces).cast("int")


def plan_shards(rows: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(heavy, bundles) of ``rows`` (doc_id, size, tokens, digest, nth): heavy has digest, pieces, at
    (shard of each piece); bundles has bundle and its shard. Both are bounded by the parameters,
    whatever the data."""
    spark = rows.sparkSession
    dims = [F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("r")]
    groups = stored(rows.groupBy("digest").agg(*dims), "groups")
    total = groups.agg(F.sum("b").alias("b"), F.sum("t").alias("t"), F.sum("r").alias("r")).head()
    cap = np.array([max(float(x or 0) / shards, 1e-9) for x in (total.b, total.t, total.r)])
    share = F.greatest(F.col("b") / float(cap[0]), F.col("t") / float(cap[1]), F.col("r") / float(cap[2]))
    heavy = groups.filter(share >= HEAVY).withColumn("pieces", F.greatest(F.lit(1), F.ceil(share * 2)).cast("int"))
    heavy = heavy.withColumn("pieces", F.when(share <= 1, 1).otherwise(F.col("pieces")))
    heavy_rows = heavy.collect()
    split = [r.digest for r in heavy_rows if r.pieces > 1]
    sums = {(r.digest, 0): (r.b, r.t, r.r) for r in heavy_rows if r.pieces == 1}
    if split:
        # at most 2 * shards pieces for each of fewer than 3 * shards groups
        big = F.broadcast(heavy.filter("pieces > 1").select("digest", "pieces"))
        for r in rows.join(big, "digest").groupBy("digest", piece(F.col("pieces")).alias("p")).agg(*dims).collect():
            sums[r.digest, r.p] = (r.b, r.t, r.r)
    light = groups.filter(share < HEAVY).groupBy(bundle().alias("bundle")).agg(
        F.sum("b").alias("b"), F.sum("t").alias("t"), F.sum("r").alias("r")).collect()
    keys = [*sorted(sums), *sorted(r.bundle for r in light)]
    by_bundle = {r.bundle: (r.b, r.t, r.r) for r in light}
    vectors = np.array([sums[k] if isinstance(k, tuple) else by_bundle[k] for k in keys], float).reshape(len(keys), 3) / cap
    shard = dict(zip(keys, place(vectors, shards).tolist()))
    heavy_at = [(r.digest, r.pieces, [shard.get((r.digest, p), 0) for p in range(r.pieces)]) for r in heavy_rows]
    return (spark.createDataFrame(heavy_at, "digest string, pieces int, at array<int>"),
            spark.createDataFrame([(b, shard[b]) for b in sorted(by_bundle)], "bundle int, b_shard int"))


def with_shard(rows: DataFrame, heavy: DataFrame, bundles: DataFrame) -> DataFrame:
    """Adds ``shard`` to rows with doc_id, digest and nth; both plans are bounded, so broadcast."""
    return (rows.join(F.broadcast(heavy), "digest", "left").withColumn("bundle", bundle()).join(F.broadcast(bundles), "bundle", "left")
            .withColumn("shard", F.when(F.col("pieces").isNotNull(), F.get("at", F.coalesce(piece(F.col("pieces")), F.lit(0)))).otherwise(F.col("b_shard")))
            .drop("pieces", "at", "bundle", "b_shard"))


def with_slot(rows: DataFrame) -> DataFrame:
    """Adds ``slot``, from 0 without gaps in each shard, to rows with doc_id, digest, nth and shard."""
    part = rows.withColumn("_range", F.pmod(F.xxhash64("doc_id", "digest", "nth"), F.lit(RANGES)).cast("int"))
    counts = stored(part.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("_n")), "ranges")
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # shards * RANGES rows at most
    offsets = counts.select("shard", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = F.row_number().over(Window.partitionBy("shard", "_range").orderBy("doc_id", "digest", "nth"))
    return (part.withColumn("_own", own).join(F.broadcast(offsets), ["shard", "_range"])
            .withColumn("slot", (F.col("_base") + F.col("_own") - 1).cast("long")).drop("_range", "_own", "_base"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, columns: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law (``bytes``), shard
    (0 to shards - 1), slot, grown_shard (null); with ``columns`` all columns of ``docs`` before
    them (those with these names are replaced).

    Shards have nearly equal bytes, tokens and rows. Equal texts share a shard unless they exceed
    what a shard holds. Null texts weigh 8 bytes and are equal to empty ones. Rows that repeat a
    doc_id and its text, or lack a doc_id, are numbered, so they are spread and placed like others;
    which of them gets which place is open. An empty table gives an empty result.
    """
    out = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    keep = [c for c in docs.columns if c not in out] if columns else ["doc_id"]
    # a copy of the rows: their numbers have to be the same in the plan and in the result
    copy = stored(docs.select(F.struct(*keep).alias("row"), "doc_id", *measures(), row_number_of()), "rows")
    rows = numbered(copy.drop("row"), ["doc_id", "digest"])
    heavy, bundles = plan_shards(rows, shards)
    placed = (with_slot(with_shard(rows, heavy, bundles))
              .withColumn("law", F.lit(LAW)).withColumn("grown_shard", F.lit(None).cast("int")))
    if not columns:
        return placed.select(*keep, *out)
    # texts take part in one exchange, by row number
    return (copy.select("row", "rid").join(placed.select("rid", *out), "rid")
            .select(*[F.col("row").getField(c).alias(c) for c in keep], *out))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write ``docs`` to ``path``, one folder per shard; each shard's files hold whole ranges of
    slots in order, written by many tasks."""
    placed = shard_documents(docs, shards, columns=True)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
