"""Substring dedup by super-k-mer partitioning.

Consecutive windows of a text that share a minimiser travel as one packed string, the words they
cover, to the bucket of that minimiser. There all windows of the bucket's strings are cut out and
sorted; in each run of equal windows the smallest doc_id keeps the words, the others lose them.
A bucket with very many strings is split over cells, and what each cell's smallest document holds
is compared across the cells (``minimisers.repeated_windows``).
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .minimisers import CELL, MER, WINDOW, found_batch, joined_words, merge_windows, repeated_windows
from .shared import whole_groups
from .words import slices, text_bytes, word_spans

NOTHING = hashlib.sha256(b"").hexdigest()


def sorted_windows(window: int):
    """Cell task: sort the windows of each bucket and compare neighbours."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, groups in whole_groups(batches, ["h", "salt"]):
            doc, tk, start, many = (t.column(x).to_numpy() for x in ("doc_id", "tk", "start", "len"))
            split, ids = t.column("split").to_numpy(), doc.tolist()
            data, off = text_bytes(t.column("piece"))
            raw = data.tobytes()
            starts, ends, first = word_spans(data, off)
            starts, ends = starts.tolist(), ends.tolist()
            rows, at, src, open_row, open_at, shared = [], [], [], [], [], []
            for g0, g1 in zip(groups[:-1].tolist(), groups[1:].tolist()):
                cut = []
                for r in range(g0, g1):
                    w = int(first[r])
                    d = ids[r]
                    cut += [(raw[starts[w + i]:ends[w + i + window - 1]], d, r, i) for i in range(int(many[r]))]
                cut.sort()
                words, least = None, None
                for win, d, r, i in cut:
                    if win != words:
                        words, least = win, d
                    if d > least:
                        rows.append(r), at.append(i), src.append(least)
                    elif split[r]:
                        open_row.append(r), open_at.append(i), shared.append(win)
            row, a, b, s = merge_windows(np.array(rows, np.int64), np.array(at, np.int64), np.array(src, np.int64))
            yield found_batch(doc[row], tk[row], start[row] + a, start[row] + b, s, [None] * len(row))
            if shared:
                row, a = np.array(open_row), start[np.array(open_row)] + np.array(open_at)
                yield found_batch(doc[row], tk[row], a, a + 1, doc[row], shared)
    return run


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = text_bytes(part.column("text"))
                starts, ends, first = word_spans(data, off)
                spans = part.column("spans")
                each, v = np.diff(spans.offsets.to_numpy()), spans.flatten()
                base = np.repeat(first[:-1], each)
                covered = np.zeros(len(starts) + 1, np.int64)
                np.add.at(covered, base + v.field("a").to_numpy(), 1)
                np.add.at(covered, base + v.field("b").to_numpy() + window - 1, -1)
                keep = np.cumsum(covered[:-1]) == 0
                left = np.append(0, np.cumsum(keep))[first]
                raw, begin, stop = joined_words(data, starts[keep], ends[keep])
                kept = [raw[begin[a]:stop[b - 1]] if b > a else b"" for a, b in zip(left[:-1].tolist(), left[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tk"), pa.array(np.diff(first) - np.diff(left)), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc_id", "tk", "removed", "kept"])
    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW, mer: int = MER, cell: int = CELL, texts: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256, and with
    ``texts`` the kept words joined by one space as ``kept``.

    Removed is each word covered by a window of ``window`` words that also starts in a document with
    a smaller doc_id; windows are judged on the input. Null and empty texts have no words. A row
    without doc_id keeps its words and removes none elsewhere. Rows that repeat a doc_id do not
    remove words from each other. Texts below ``window`` words stay. An empty table gives an empty
    result; other columns are ignored.
    """
    found = repeated_windows(docs, sorted_windows, window, mer, cell)
    cut = (found.touched.join(found.spans, ["doc_id", "tk"])
           .mapInArrow(_remove(window), "doc_id long, tk long, removed long, kept string")
           .withColumn("cut_sha", F.sha2("kept", 256)))
    every = (found.scan.join(found.first, "sha", "left")
             .join(cut if texts else cut.drop("kept"), ["doc_id", "tk"], "left")
             .withColumn("copy", F.coalesce(F.expr(f"doc_id > rep and n_words >= {window}"), F.lit(False))))
    n_removed = F.expr("if(copy, n_words, coalesce(removed, 0L))")
    sha = F.when(F.col("copy"), NOTHING).otherwise(F.coalesce("cut_sha", "sha"))
    out = every.select("doc_id", "tk", "n_words", n_removed.alias("n_removed"), sha.alias("kept_sha256"), *(["copy", "kept"] if texts else []))
    if not texts:
        return out.drop("tk")
    whole = F.expr(r"array_join(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0), ' ')")
    rows = docs.select(F.col("doc_id").alias("_d"), F.col("text"), F.xxhash64("text").alias("_t"))
    out = out.dropDuplicates(["doc_id", "tk", "kept_sha256"])
    return (rows.join(out, (rows._d.eqNullSafe(out.doc_id)) & (rows._t == out.tk))
            .select("doc_id", "n_words", "n_removed", "kept_sha256",
                    F.when(F.col("copy"), "").otherwise(F.coalesce("kept", whole, F.lit(""))).alias("kept")))
