"""SimHash near-dedup by anchor-point covering.

Each 64-bit fingerprint is cut into two 32-bit halves: two fingerprints that differ in at most 3
bits have a half in which they differ in at most 1. In a half, the anchors are the words of a
covering code: the perfect Hamming code on 31 bits (covering radius 1) with both values of the last
bit, 2^27 anchors. A fingerprint is replicated to every anchor within covering radius plus
threshold: the code words within 2 bits of its 31 bits, and its nearest one with the last bit
flipped, about 17 a half. Of two fingerprints within 1 bit in a half, each therefore meets the other
at its nearest anchor, where all 64 bits are compared. No link is missed, whatever the data.

Groups are bounded: equal fingerprints are one row before the anchors, and an anchor's rows are
dealt to cells of bounded size in which any two meet once. A cell returns the links of a spanning
forest of what it found, not all pairs.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, forest, pair_cells, stored, whole_groups
from .words import slices, text_bytes, word_spans

SHINGLE, MAX_BITS, SEED = 3, 3, 42
CELL = 1024
FP, HASH = "_fp", "_text_hash"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in over half of the 64-bit ``hashes``; 0 for none."""
    if not len(hashes):
        return 0
    count, at = np.zeros(64, np.int64), 0
    while at < len(hashes):
        part = np.ascontiguousarray(hashes[at:at + 65536], dtype=">u8")
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        at += 65536
    return int(np.packbits(count * 2 > len(hashes)).view(">u8")[0])


def _fingerprints(size: int, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = text_bytes(part.column("text"))
                starts, ends, first = word_spans(data, off)
                # words lower-cased and joined by one space: shingles are slices of this
                length = ends - starts
                to = np.cumsum(length + 1)
                where = np.repeat(starts - (to - length - 1), length + 1)
                src = np.arange(len(where)) + where
                joined = _LOWER[data[np.minimum(src, max(len(data) - 1, 0))]] if len(data) else data
                joined[to - 1] = 32
                raw, begin, stop = joined.tobytes(), to - length - 1, to - 1
                out = []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                    k = min(size, b - a)
                    if not k:
                        out.append(0)
                        continue
                    h = np.fromiter((digest(raw[s:e], SEED) for s, e in
                                     zip(begin[a:b - k + 1].tolist(), stop[a + k - 1:b].tolist())), np.uint64, b - a - k + 1)
                    out.append(fingerprint(h))
                fp = pa.array(np.array(out, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), fp], [*keep, FP])
    return run


def with_simhash(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` of ``docs`` and fp long: SimHash over the word shingles of the whole text, A-Z lower-cased,
    repeats included, each hashed by XXH64 with seed 42. A text with fewer words than a shingle is
    one shingle; one without words, or null, has fingerprint 0."""
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(_fingerprints(shingle, keep), f"{schema}, {FP} long")


def hamming_moves() -> tuple[np.ndarray, np.ndarray]:
    """(flat, first): for each of the 32 syndromes of the Hamming code on 31 bits, the differences
    between a word of that syndrome and the code words within 2 bits of it, the nearest first.

    The syndrome is the xor of the numbers (1 to 31) of the bits set; the code words have 0. A word
    of syndrome s becomes one by flipping bit s, or two bits whose numbers have the xor s."""
    flat, first = [], [0]
    for s in range(32):
        flat.append(1 << s >> 1 if s else 0)
        flat += [1 << j - 1 | 1 << (j ^ s) - 1 for j in range(1, 32) if s and j < j ^ s]
        first.append(len(flat))
    return np.array(flat), np.array(first)


FLAT, FIRST = hamming_moves()
_SYNDROME = np.zeros((4, 256), np.int64)   # of each byte of a 31-bit word
for _b in range(31):
    _byte, _bit = divmod(_b, 8)
    _SYNDROME[_byte] ^= np.where(np.arange(256) >> _bit & 1, _b + 1, 0)


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of every replica of the fingerprints (uint64); anchors of the upper half have
    bit 32 set."""
    rows, out = [], []
    for half in (0, 1):
        part = ((fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        word, rest = part & 0x7FFFFFFF, part & 0x80000000 | half << 32
        s = _SYNDROME[0][word & 255] ^ _SYNDROME[1][word >> 8 & 255] ^ _SYNDROME[2][word >> 16 & 255] ^ _SYNDROME[3][word >> 24]
        n = FIRST[s + 1] - FIRST[s]
        row = np.repeat(np.arange(len(fp)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(FIRST[s], n)
        rows += [row, np.arange(len(fp))]
        out += [word[row] ^ FLAT[at] | rest[row], word ^ FLAT[FIRST[s]] | rest ^ 0x80000000]
    return np.concatenate(rows), np.concatenate(out)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        for at in range(0, len(fp), 8192):
            part = fp[at:at + 8192]
            row, anchor = anchors(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[row])], ["anchor", "fp"])


def near_pairs(fp: np.ndarray, blk: np.ndarray, group: np.ndarray, cross: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one group with at most ``bits`` differing bits: neighbours at distance 1, 2, ...
    of the sorted rows are compared for all groups at once, large groups in whole blocks."""
    n = np.bincount(group)
    a, b = [], []
    start = np.cumsum(n) - n
    small = n <= 48
    idx = np.flatnonzero(small[group])
    d = 1
    while len(idx):
        idx = idx[idx + d < len(fp)]
        idx = idx[group[idx + d] == group[idx]]
        hit = np.bitwise_count(fp[idx] ^ fp[idx + d]) <= bits
        hit &= ~cross[idx] | (blk[idx] != blk[idx + d])
        a.append(idx[hit])
        b.append(idx[hit] + d)
        d += 1
    for g in np.flatnonzero(~small):
        s, e = start[g], start[g] + n[g]
        for r in range(s, e, 256):
            q = slice(r, min(r + 256, e))
            hit = np.bitwise_count(fp[q, None] ^ fp[None, s:e]) <= bits
            hit &= np.arange(s, e)[None, :] > np.arange(q.start, q.stop)[:, None]
            if cross[s]:
                hit &= blk[q, None] != blk[None, s:e]
            i, j = np.nonzero(hit)
            a.append(i + r)
            b.append(j + s)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


def _compare(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, ["anchor", "lo", "hi"]):
            signed = t.column("fp").to_numpy()
            n = len(signed)
            group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            cross = (t.column("lo").to_numpy() != t.column("hi").to_numpy())
            a, b = near_pairs(signed.view(np.uint64), t.column("blk").to_numpy(), group, cross, bits)
            label = forest(n, a, b)
            at = np.flatnonzero(label != np.arange(n))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(signed[at]), pa.array(signed[label[at]])], ["a", "b"])
    return run


def link_fingerprints(fps: DataFrame, bits: int = MAX_BITS, cell: int = CELL) -> DataFrame:
    """(a, b): fingerprints linked, spanning every component of "differ in at most ``bits`` bits".

    ``fps`` has distinct ``fp``. The halves need ``bits <= 3`` (one half within 1 bit)."""
    if bits > 3:
        raise ValueError("two halves with one flipped bit each cover at most 3 differing bits")
    dealt = pair_cells(fps.select("fp").mapInArrow(_replicate, "anchor long, fp long"), ["anchor"], F.col("fp"), cell)
    return dealt.mapInArrow(_compare(bits), "a long, b long").distinct()


def grouped_fingerprints(docs: DataFrame, shingle: int, bits: int, keep: tuple[str, ...] = ("doc_id",)) -> tuple[DataFrame, DataFrame]:
    """(``keep`` and fp of each row; per distinct fp: n_same, root, component_id, and as least the
    smallest ``keep`` of the component's rows with a doc_id)."""
    prints = stored(with_simhash(docs, [*keep], shingle).withColumnRenamed(FP, "fp"), "fingerprints")
    named = F.when(F.col("doc_id").isNotNull(), F.struct(*keep))
    fps = stored(prints.groupBy("fp").agg(F.min(named).alias("first"), F.count(F.lit(1)).alias("n_same")), "distinct-fp")
    nodes = components(link_fingerprints(fps, bits)).withColumnRenamed("node", "fp")
    rooted = fps.join(nodes, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return prints, stored(rooted.join(least, "root").select("fp", "n_same", "root", F.col("least.doc_id").alias("component_id"), "least"), "groups")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fp long, component_id (smallest doc_id
    reachable over links of at most ``bits`` differing bits), n_same (rows with this fingerprint).

    Null and empty texts and texts without words have fingerprint 0 and link like any others.
    Repeated rows stay, in one component. A row without doc_id takes part; a component of such rows
    only has a null component_id. An empty table gives an empty result; other columns are ignored.
    """
    prints, groups = grouped_fingerprints(docs, shingle, bits)
    return prints.join(groups, "fp").select("doc_id", "fp", "component_id", "n_same")


def kept_documents(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, one per component: the row with the smallest doc_id (of rows
    that repeat it in the component, that whose text has the smallest hash), or any one where no row
    has a doc_id. Components whose smallest doc_id is the same keep a row each. The texts take part
    in one exchange, by doc_id and hash of the text."""
    hashed = docs.withColumn(HASH, F.xxhash64("text"))
    prints, groups = grouped_fingerprints(hashed, shingle, bits, ("doc_id", HASH))
    # equal texts have equal fingerprints, so doc_id and hash name one component
    keep = groups.filter("component_id is not null").select("least.doc_id", f"least.{HASH}").distinct()
    named = hashed.join(keep, ["doc_id", HASH], "left_semi").dropDuplicates(["doc_id", HASH]).select(*docs.columns)
    nameless = (with_simhash(docs.filter("doc_id is null"), docs.columns, shingle)
                .join(groups.filter("component_id is null").select(F.col("fp").alias(FP), F.col("root").alias("_root")), FP)
                .dropDuplicates(["_root"]).select(*docs.columns))
    return named.unionByName(nameless)
