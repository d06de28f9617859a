"""Repeated passages by sparse suffix arrays.

Of all suffixes of a text only those are retained that start at the minimiser of some window of
``window`` words, about one in 22. The retained suffixes of a minimiser are sorted and neighbours
compared; the same is done with the words before them, read backwards. The lengths that neighbours
share to the right and to the left give, for every split of a window into words before and words
from the selected position, the classes of suffixes with equal words on both sides: a match that
extends to at least ``window`` words. Each class's smallest document keeps the passage.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .minimisers import CELL, MER, WINDOW, found_batch, merge_windows, repeated_windows
from .shared import stored, whole_groups
from .words import text_bytes, word_spans


def sorted_extensions(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows of word numbers (0: no word) within groups; returns the order and how many words
    each row shares with the one before it in that order (-1 where a group begins)."""
    key = np.ascontiguousarray(np.column_stack([group + 1, words]).astype(">u4"))
    order = np.argsort(key.view(f"S{key.shape[1] * 4}").ravel(), kind="stable")
    w, g = words[order], group[order]
    same = (w[1:] == w[:-1]) & (w[1:] != 0)
    shared = np.where(same.all(axis=1), words.shape[1], same.argmin(axis=1))
    return order, np.append(-1, np.where(g[1:] == g[:-1], shared, -1))


def via(tk: np.ndarray, rep: np.ndarray, rep_a: np.ndarray, again: bool) -> tuple[pa.Array, ...]:
    """src_tk, src_a and src_again of ``FOUND``; ``rep`` is -1 where there is none."""
    return pa.array(tk[rep], mask=rep < 0), pa.array(rep_a.astype(np.int32), mask=rep < 0), pa.array(np.full(len(rep), again))


def compared_suffixes(window: int):
    """Cell task: sparse suffix arrays of each minimiser's suffixes, extended to both sides."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, groups in whole_groups(batches, ["h", "salt"]):
            doc, tk, start, many, pos = (t.column(x).to_numpy() for x in ("doc_id", "tk", "start", "len", "pos"))
            split, n = t.column("split").to_numpy(), t.num_rows
            data, off = text_bytes(t.column("piece"))
            raw = data.tobytes()
            starts, ends, first = word_spans(data, off)
            number: dict[bytes, int] = {}
            ids = np.fromiter((number.setdefault(raw[s:e], len(number) + 1) for s, e in zip(starts.tolist(), ends.tolist())),
                              np.int64, len(starts))
            group = np.repeat(np.arange(len(groups) - 1), np.diff(groups))
            middle = first[:-1] + pos - start

            def side(step: int, size: int) -> np.ndarray:
                cell = middle[:, None] + step * np.arange(size)[None, :] - (step < 0)
                inside = (cell >= first[:-1, None]) & (cell < first[1:, None])
                return np.where(inside, ids[np.clip(cell, 0, len(ids) - 1)], 0)

            right, r_shared = sorted_extensions(side(1, window), group)
            left, l_shared = sorted_extensions(side(-1, window - 1), group)
            before = pos - start
            r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
            rows, wins, srcs, reps, rep_wins, runs, open_runs = [], [], [], [], [], [], []
            for o in range(int(before.max()) + 1):
                r_class[right] = np.cumsum(r_shared < window - o)
                l_class[left] = np.cumsum(l_shared < o)
                has = np.flatnonzero((before >= o) & (before - many < o))
                if not len(has):
                    continue
                key, at = r_class[has] * (n + 1) + l_class[has], pos[has] - o
                order = np.lexsort((at, tk[has], doc[has], key))
                row, key, at = has[order], key[order], at[order]
                new = np.append(True, key[1:] != key[:-1])
                # where a minimiser is split, the window's place in the cell's smallest document
                rep = np.flatnonzero(new)[np.cumsum(new) - 1]
                rep, rep_a, least = np.where(split[row], row[rep], -1), at[rep], doc[row[rep]]
                # equal windows of a text that touch or overlap are one row, however often words repeat
                new[1:] |= (doc[row[1:]] != doc[row[:-1]]) | (tk[row[1:]] != tk[row[:-1]]) | (at[1:] - at[:-1] > window)
                k = np.flatnonzero(new)
                row, a, b, rep, rep_a, least = row[k], at[k], at[np.append(k[1:], len(at)) - 1] + 1, rep[k], rep_a[k], least[k]
                late = doc[row] > least
                one, more, stay = late & (b - a == 1), late & (b - a > 1), ~late & split[row]
                rows.append(row[one]), wins.append(a[one]), srcs.append(least[one])
                reps.append(rep[one]), rep_wins.append(np.where(rep >= 0, rep_a, 0)[one])
                runs.append(np.array([row, a, b, least, rep, rep_a])[:, more])
                open_runs.append(np.array([row, a, b])[:, stay])
            row, a, b, src, rep, rep_a = merge_windows(*(np.concatenate(x) for x in (rows, wins, srcs, reps, rep_wins)))
            yield found_batch(doc[row], tk[row], a, b, src, [None] * len(row), via=via(tk, rep, rep_a, False))
            row, a, b, src, rep, rep_a = np.concatenate(runs, axis=1)
            yield found_batch(doc[row], tk[row], a, b, src, [None] * len(row), via=via(tk, rep, rep_a, True))
            row, a, b = np.concatenate(open_runs, axis=1)
            if len(row):
                w = first[row] + a - start[row]
                yield found_batch(doc[row], tk[row], a, b, doc[row],
                                  [raw[s:e] for s, e in zip(starts[w].tolist(), ends[w + window - 1].tolist())])
    return run


def repeated_passages(docs: DataFrame, window: int = WINDOW, mer: int = MER, cell: int = CELL) -> DataFrame:
    """The passages of at least ``window`` words of ``docs`` (doc_id, text) that a document with a
    smaller doc_id has too: doc_id, first_word, end_word (words first_word to end_word - 1),
    n_words, kept_in (the smallest doc_id that holds a window of the passage). A text that is a whole
    copy is one passage.

    Passages of a document that touch or overlap are one row. Documents without such a passage have
    no row, nor have null or empty texts, texts below ``window`` words, rows without doc_id, and the
    smallest document of each passage. Rows that repeat a doc_id count as one document each, and do
    not repeat each other. An empty table gives an empty result; other columns are ignored.
    """
    found = repeated_windows(docs, compared_suffixes, window, mer, cell, sources=True)
    # consecutive or overlapping windows of a document become one passage
    one = F.aggregate(
        "spans", F.expr("cast(array() as array<struct<a: int, b: int, src: bigint>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["b"] + (window - 1) >= x["a"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(
                F.get(done, F.size(done) - 1)["a"].alias("a"),
                F.greatest(F.get(done, F.size(done) - 1)["b"], x["b"]).alias("b"),
                F.least(F.get(done, F.size(done) - 1)["src"], x["src"]).alias("src")))),
        ).otherwise(F.concat(done, F.array(x))))
    spans = stored(found.spans, "spans")
    passages = (spans.select("doc_id", F.inline(one))
                .select("doc_id", F.col("a").cast("long").alias("first_word"),
                        (F.col("b") + (window - 1)).cast("long").alias("end_word"), F.col("src").alias("kept_in")))
    # a copy has the windows of its first document, so also what that document's windows are kept in;
    # written, so that the join with the copies can split a text that very many rows repeat
    lower = (spans.select("doc_id", "tk", F.array_min(F.transform("spans", lambda x: x["src"])).alias("src"))
             .join(found.scan.select("doc_id", "tk", "sha").distinct(), ["doc_id", "tk"])
             .groupBy("sha", F.col("doc_id").alias("rep")).agg(F.min("src").alias("src")))
    source = stored(found.first.join(lower, ["sha", "rep"], "left").select("sha", "rep", F.least("rep", "src").alias("src")), "source")
    copies = (found.scan.filter(F.col("n_words") >= window).join(source, "sha").filter("doc_id > rep")
              .select("doc_id", F.lit(0).cast("long").alias("first_word"), F.col("n_words").alias("end_word"), F.col("src").alias("kept_in")))
    return (passages.unionByName(copies)
            .select("doc_id", "first_word", "end_word", (F.col("end_word") - F.col("first_word")).alias("n_words"), "kept_in").distinct())
