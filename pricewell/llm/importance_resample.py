"""Resampling of documents toward a target distribution, ranked by a distributed radix sort.

Words and pairs of neighbouring words are hashed to buckets. Two passes over the texts work on
arrays of a batch's bytes: the first counts buckets (each task sends its own sums), the second adds
up each document's gains, so a weight needs no join. The top documents by weight plus Gumbel noise
are a draw without replacement; they are found by an LSD radix sort over the digits of (score,
doc_id, n_features).

One radix pass is a stable counting sort: rows lie in blocks; every block counts its digits; prefix
sums over (digit, block) give where a block's rows with a digit go; a row's place among them is its
number in the block. Block and digit key the only shuffle of rows, so no group is larger than a
block, whatever the keys. Rows carry keys and counts, never texts, and each pass is a written table.
"""
from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import drop_stored, stored
from .words import slices, text_bytes, word_spans

BUCKETS = 10_000
MIN_WORDS, PERCENT, SEED = 20, 25, 7
DIGIT_BITS = 13
# Blocks of a pass for each shuffle partition: so many that hashed blocks fill partitions evenly.
BLOCKS = 8

# A-Z to a-z; what is no digit, letter or byte above 127 separates.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
for _a, _z, _to in ((b"0", b"9", b"0"), (b"a", b"z", b"a"), (b"A", b"Z", b"a")):
    _FOLD[_a[0]:_z[0] + 1] = np.arange(_to[0], _to[0] + _z[0] - _a[0] + 1)

# Words up to so many bytes are hashed in arrays, longer ones one by one.
_SHORT = 48


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """(step, after): the table of one byte, and for 0 to _SHORT zero bytes what they make of a
    checksum, by each of its four bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    now = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None])
    after = [now]
    for _ in range(_SHORT):
        now = step[now & 255] ^ (now >> 8)
        after.append(now)
    return step, np.stack(after)


_STEP, _AFTER = _crc_tables()
_SPACE = np.uint32(zlib.crc32(b" "))


def _shifted(crc: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """The part of a checksum in that of its text and ``n`` more bytes."""
    return (_AFTER[n, 0, crc & 255] ^ _AFTER[n, 1, (crc >> 8) & 255]
            ^ _AFTER[n, 2, (crc >> 16) & 255] ^ _AFTER[n, 3, crc >> 24])


def feature_buckets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, one, two): each text's first word with the end; the bucket of each word; of each
    word and the next one (meaningless for the last word of a text)."""
    data = _FOLD[data]
    starts, ends, first = word_spans(data, off)
    size = ends - starts
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    at = np.flatnonzero(size <= _SHORT)
    for j in range(_SHORT):
        at = at[size[at] > j]
        if not len(at):
            break
        c = crc[at]
        crc[at] = _STEP[(c ^ data[starts[at] + j]) & 255] ^ (c >> 8)
    crc ^= np.uint32(0xFFFFFFFF)
    long = np.flatnonzero(size > _SHORT)
    for i in long:
        crc[i] = zlib.crc32(data[starts[i]:ends[i]])
    pair = np.zeros(len(starts), np.uint32)
    if len(starts) > 1:
        head = _shifted(crc[:-1], 1) ^ _SPACE
        pair[:-1] = _shifted(head, np.minimum(size[1:], _SHORT)) ^ crc[1:]
        for i in long[long > 0]:
            pair[i - 1] = zlib.crc32(data[starts[i]:ends[i]], int(head[i - 1]))
    return first, (crc % BUCKETS).astype(np.int64), (pair % BUCKETS).astype(np.int64)


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n): the features of all texts by bucket; null texts have none."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for b in slices(batch, "text"):
                data, off = text_bytes(b.column("text"))
                first, one, two = feature_buckets(data, off)
                total += np.bincount(one, minlength=BUCKETS)
                two = np.delete(two, first[1:][first[1:] > first[:-1]] - 1)
                total += np.bincount(two, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})

    return (texts.select("text").mapInArrow(count, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """1000 times the log of each bucket's smoothed share in ``target`` over that in ``docs``,
    rounded down. The driver gets one number per bucket of either table."""
    def counts(df: DataFrame) -> list[int]:
        out = [0] * BUCKETS
        for r in bucket_counts(df).collect():
            out[r.bucket] = r.n
        return out

    raw, aim = counts(docs), counts(target)
    s_all, t_all = float(sum(raw) + BUCKETS), float(sum(aim) + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(raw, aim)], np.int64)


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """1000 times a Gumbel number, rounded down, from the hash of ``seed`` and doc_id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(docs: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row of ``docs``."""
    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                data, off = text_bytes(b.column("text"))
                first, one, two = feature_buckets(data, off)
                words = np.diff(first)
                some = words > 0
                sums = [np.concatenate([[0], np.cumsum(gains[x])]) for x in (one, two)]
                gained = (sums[0][first[1:]] - sums[0][first[:-1]]
                          + sums[1][np.maximum(first[1:] - 1, first[:-1])] - sums[1][first[:-1]])
                n = np.where(some, 2 * words - 1, 0)
                weight = np.where(some, gained // np.maximum(n, 1), 0)
                ids = b.column("doc_id")
                noise = np.array([gumbel(i, seed) for i in ids.to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(x, pa.int64()) for x in (words, n, weight, weight + noise))],
                    ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        weigh, "doc_id long, n_words long, n_features long, weight long, score long")


def _digit(keys: list[tuple[str, int]], low: int) -> Column:
    """Bits low to low + DIGIT_BITS of the composite key; ``keys`` are (column, bits), last first."""
    out, start = F.lit(0).cast("long"), 0
    for name, bits in keys:
        a, b = max(low, start), min(low + DIGIT_BITS, start + bits)
        if a < b:
            part = F.shiftrightunsigned(F.col(name), a - start).bitwiseAND((1 << (b - a)) - 1)
            out = out.bitwiseOR(F.shiftleft(part, a - low))
        start += bits
    return out.cast("int")


def _as_digits(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, list[tuple[str, int]], int]:
    """Adds each key as a number from 0 (``_k0`` ...); with the bits each takes, least key first,
    and the number of rows."""
    span = rows.agg(F.count(F.lit(1)).alias("n"), *[f(k).alias(f"{f.__name__}{i}") for i, k in enumerate(keys) for f in (F.min, F.max)]).head()
    out, bits = rows, []
    for i, k in enumerate(keys):
        lo, hi = span[f"min{i}"] or 0, span[f"max{i}"] or 0
        wide = hi - lo >= 1 << 63
        out = out.withColumn(f"_k{i}", F.col(k).bitwiseXOR(F.lit(-1 << 63)) if wide else F.col(k) - F.lit(lo))
        bits.append((f"_k{i}", 64 if wide else (hi - lo).bit_length()))
    return out, bits[::-1], span["n"]


def radix_positions(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (long, from 0): the place of each row in the order of ``keys`` (long
    columns without nulls, most significant first, ascending). Rows with equal keys lie in any order."""
    spark = rows.sparkSession
    # the first blocks are the tasks that wrote the rows; their numbers are fixed by being written
    now = stored(rows.withColumn("_at", F.monotonically_increasing_id()), "radix")
    names = rows.columns
    keyed, bits, n = _as_digits(now, keys)
    width = max(1, -(-n // (BLOCKS * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    block = F.shiftright("_at", 33)
    low = 0
    while low < max(1, sum(b for _, b in bits)):
        dealt = keyed.withColumn("_block", block).withColumn("_digit", _digit(bits, low))
        counts = dealt.groupBy("_block", "_digit").agg(F.count(F.lit(1)).alias("_n"))
        counts = stored(counts, "digits")
        # at most 2 ** DIGIT_BITS rows, whatever the input
        base = (counts.groupBy("_digit").agg(F.sum("_n").alias("_all"))
                .select("_digit", (F.sum("_all").over(Window.orderBy("_digit")) - F.col("_all")).alias("_base")))
        before = F.sum("_n").over(Window.partitionBy("_digit").orderBy("_block")) - F.col("_n")
        goes = stored(counts.withColumn("_before", before).join(F.broadcast(base), "_digit")
                      .select("_block", "_digit", (F.col("_base") + F.col("_before")).alias("_to")), "offsets")
        among = F.row_number().over(Window.partitionBy("_block", "_digit").orderBy("_at")) - 1
        moved = dealt.join(goes, ["_block", "_digit"]).withColumn("_at", F.col("_to") + among)
        done, now = now, stored(moved.select(*names, "_at", *[c for c, _ in bits]), "radix")
        for x in (done, counts, goes):
            drop_stored(x)
        keyed, block, low = now, F.floor(F.col("_at") / F.lit(width)).cast("long"), low + DIGIT_BITS
    return now.select(*names, F.col("_at").alias("pos"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_features, weight, score, rank (all long).

    weight is the mean gain of the document's features toward ``target`` (text), score adds noise
    that only ``seed`` and doc_id decide. Of the N rows with at least ``min_words`` words the
    floor(percent * N / 100) highest scores are drawn and ranked from 1; ties go to the smaller
    doc_id, null last, then to fewer features. Others have a null rank.

    A null or empty text has no feature and weight 0. A null doc_id counts as an empty string in the
    noise. Rows that repeat a doc_id are documents of their own with the same noise. Empty tables
    (either one) give the weights that the smoothed shares give. Other columns are ignored.
    """
    scored = stored(score(docs, bucket_gains(docs, target), seed), "scores")
    able = F.col("n_words") >= min_words
    small = F.min("doc_id")
    least = scored.agg(small.alias("m")).head().m or 0
    rows = scored.filter(able).select(
        "doc_id", "n_features", "weight", "score", (-F.col("score")).alias("_score"),
        F.col("doc_id").isNull().cast("long").alias("_none"), F.coalesce("doc_id", F.lit(least)).alias("_id"))
    drawn = rows.count() * percent // 100
    ranked = radix_positions(rows, ["_score", "_none", "_id", "n_features"])
    out = ["doc_id", "n_features", "weight", "score"]
    return (ranked.select(*out, F.when(F.col("pos") < drawn, F.col("pos") + 1).alias("rank"))
            .union(scored.filter(~able).select(*out, F.lit(None).cast("long"))))
