"""Windows of a fixed number of words and the minimiser positions they select.

Both passage operators look for windows of ``window`` consecutive words that also occur in another
document. Every window selects one position: the first smallest hash among its runs of ``mer``
words. Equal windows select the same place, so two documents that share a window share the hash at
it; only those selections are gathered whose hash occurs in two documents with different texts,
which is known from hashes alone, before any text is moved. The hash brings together; the words
themselves decide.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored
from .words import mix, rolling, slices, sliding_argmin, text_bytes, word_hashes, word_spans

WINDOW, MER = 50, 8
# Rows of one minimiser that are handled together.
CELL = 1024

# A run of windows: the hash at the selected position, and in one number the first window, the number
# of windows and how far the position lies behind the first window.
SCAN = "doc_id long, tk long, sha string, n_words long, runs array<struct<h: long, at: long>>"
_LOW = 12
FOUND = "doc_id long, tk long, a int, b int, src long, shared binary, src_tk long, src_a int, src_again boolean"
# Windows of a text whose sources are looked up together.
_BLOCK = 1024


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words joined by one space, and where each begins and ends in that."""
    length = ends - starts
    to = np.cumsum(length + 1)
    src = np.repeat(starts - (to - length - 1), length + 1)
    src += np.arange(len(src))
    np.minimum(src, max(len(data) - 1, 0), out=src)
    out = data[src] if len(src) else np.zeros(0, np.uint8)
    out[to - 1] = 32
    return out.tobytes(), to - length - 1, to - 1


def selections(words: np.ndarray, first: np.ndarray, window: int, mer: int) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows that select the same position: (text, hash, first window, windows,
    position), word numbers counted over all texts. ``words`` are word hashes, ``first`` each text's
    first word, with the end."""
    none = np.zeros(0, np.int64)
    if len(words) < window:
        return none, none.astype(np.uint64), none, none, none
    mers = rolling(words, mer)
    chosen = sliding_argmin(mers, window - mer + 1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(chosen))
    at = at[at + window <= first[text[at] + 1]]
    if not len(at):
        return none, none.astype(np.uint64), none, none, none
    chosen = chosen[at]
    new = np.flatnonzero(np.append(True, (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)))
    pos = chosen[new]
    return text[at[new]], mers[pos], at[new], np.diff(np.append(new, len(at))), pos


def _scan(window: int, mer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = text_bytes(part.column("text"))
                starts, ends, first = word_spans(data, off)
                raw, begin, stop = joined_words(data, starts, ends)
                n = np.diff(first)
                sha = [hashlib.sha256(raw[begin[a]:stop[b - 1]] if b > a else b"").hexdigest()
                       for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                text, h, at, many, pos = selections(word_hashes(data, starts, ends), first, window, mer)
                place = (at - first[text]) << 2 * _LOW | many << _LOW | (pos - at)
                runs = pa.StructArray.from_arrays([pa.array(h.view(np.int64)), pa.array(place)], ["h", "at"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(n) + 1)).astype(np.int32)), runs)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tk"), pa.array(sha), pa.array(n.astype(np.int64)), lists],
                    ["doc_id", "tk", "sha", "n_words", "runs"])
    return run


def _pieces(window: int, cell: int, aligned: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = text_bytes(part.column("text"))
                starts, ends, first = word_spans(data, off)
                raw, begin, stop = joined_words(data, starts, ends)
                runs = part.column("runs")
                each, v = np.diff(runs.offsets.to_numpy()), runs.flatten()
                row = np.repeat(np.arange(part.num_rows), each)
                h, total, place = (v.field(x).to_numpy() for x in ("h", "n", "at"))
                start, many = place >> 2 * _LOW, place >> _LOW & (1 << _LOW) - 1
                pos = start + (place & (1 << _LOW) - 1)
                start, many, pos = (x.astype(np.int32) for x in (start, many, pos))
                a = first[row] + start
                b = a + many + window - 2
                doc = part.column("doc_id").to_numpy()[row]
                cells = -(-total // cell)
                unit = doc.view(np.uint64) ^ h.view(np.uint64)
                if aligned:  # documents that share several minimisers share the cells of all of them
                    unit, cells = doc.view(np.uint64), 1 << np.ceil(np.log2(cells)).astype(np.int64)
                salt = (mix(unit) % cells.astype(np.uint64)).astype(np.int32)
                text = [raw[s:e] for s, e in zip(begin[a].tolist(), stop[b].tolist())] if len(a) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(salt), pa.array(cells > 1), pa.array(doc), pa.array(part.column("tk").to_numpy()[row]),
                     pa.array(start), pa.array(many), pa.array(pos), pa.array(text, pa.binary())],
                    ["h", "salt", "split", "doc_id", "tk", "start", "len", "pos", "piece"])
    return run


@dataclass
class Repeats:
    """What ``repeated_windows`` found."""
    scan: DataFrame       # every row with a key, its words' digest and number: doc_id, tk, sha, n_words
    first: DataFrame      # sha, rep: the smallest doc_id with that sequence of words
    touched: DataFrame    # texts with selections that another text has: doc_id, tk, text
    spans: DataFrame      # doc_id, tk, spans array<struct<a, b, src>>: windows a to b - 1 occur in src < doc_id


def repeated_windows(docs: DataFrame, cell_task: Callable, window: int = WINDOW, mer: int = MER, cell: int = CELL,
                     sources: bool = False) -> Repeats:
    """Find all windows of ``docs`` (doc_id, text) that also start in a document with a smaller id.

    ``cell_task(window)`` makes the ``mapInArrow`` function over cells: rows sorted by (h, salt) with
    doc_id, tk, start, len, pos, piece (the words the windows cover). It returns ``FOUND`` rows:
    windows a to b - 1 of a text that occur in the smaller ``src``, and, when a minimiser's rows
    are split over cells, each window of the cell's smallest document with its words in ``shared``;
    those are compared across cells in a second step, by at most one row a cell and window. With
    ``sources``, ``src`` is the smallest document of all cells: rows of split minimisers name the
    text and window of the cell's smallest document (src_tk, src_a), through which they get what the
    second step found for it. Equal windows of a text that touch or overlap may then be one row, a the
    first and b - 1 the last, so that words that repeat in a text do not multiply its rows: with
    ``shared``, or with src_again, where src_a is the source's first such window. Without, ``src`` may
    be the cell's smallest.

    Texts with the same words are one text, represented by the smallest doc_id. Rows without doc_id
    or text have no windows. tk, a hash of the text, tells rows apart that repeat a doc_id.
    """
    if window >= 1 << _LOW:
        raise ValueError("windows of 4096 words and more do not fit the packed runs")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tk"))
    scan = stored(rows.mapInArrow(_scan(window, mer), SCAN), "scan")
    first = stored(scan.filter("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("rep")), "first")
    alone = first.select("sha", F.col("rep").alias("doc_id"))
    slim = (scan.filter(F.size("runs") > 0).join(alone, ["doc_id", "sha"], "left_semi")
            .select("doc_id", "tk", F.inline("runs")))
    # written first, so that the join below can split the rows of a hash that very many texts have
    twice = stored(slim.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("up"), F.count(F.lit(1)).alias("n"))
                   .filter("lo < up").select("h", "n"), "twice")
    runs = (slim.join(twice, "h").groupBy("doc_id", "tk")
            .agg(F.sort_array(F.collect_list(F.struct("at", "h", "n"))).alias("runs")))
    touched = stored(rows.join(runs, ["doc_id", "tk"]).dropDuplicates(["doc_id", "tk"]), "touched")
    pieces = touched.mapInArrow(
        _pieces(window, cell, sources),
        "h long, salt int, split boolean, doc_id long, tk long, start int, len int, pos int, piece binary")
    found = stored(pieces.repartition("h", "salt").sortWithinPartitions("h", "salt")
                   .mapInArrow(cell_task(window), FOUND), "found")
    open_ = found.filter("shared is not null")
    least = stored(open_.groupBy("shared").agg(F.min("doc_id").alias("least")), "least")
    late = open_.join(least, "shared").filter("doc_id > least")
    span = ["doc_id", "tk", "a", "b", "src"]
    inside = found.filter("shared is null")
    if sources:
        late = stored(late.select("doc_id", "tk", "a", "b", F.col("least").alias("src")), "late")
        moved = inside.filter("src_tk is not null")
        inside = inside.filter("src_tk is null").select(*span).unionByName(
            carried_sources(moved.filter("not src_again"), late, moved.filter("src_again")))
    else:
        late = late.withColumn("src", F.col("least"))
    spans = (inside.select(*span).unionByName(late.select(*span))
             .groupBy("doc_id", "tk").agg(F.sort_array(F.collect_set(F.struct("a", "b", "src"))).alias("spans")))
    return Repeats(scan.drop("runs"), first, touched.drop("runs"), spans)


def carried_sources(inside: DataFrame, late: DataFrame, again: DataFrame | None = None) -> DataFrame:
    """``inside`` (doc_id, tk, a, b, src, src_tk, src_a) as longer spans doc_id, tk, a, b, src, whose
    ``src`` is the least that ``late`` (doc_id, tk, a, src) has for the windows of the source.

    Spans that follow one another here and in the source become one before the join. The windows of
    a source are looked up in blocks, so that no array grows with a text. ``again``: such rows whose
    windows all have the words of the source's one window."""
    same = ["doc_id", "tk", "src", "src_tk", "off"]
    order = Window.partitionBy(*same).orderBy("a", "b")
    far = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    joined = (inside.withColumn("off", F.col("src_a") - F.col("a"))
              .withColumn("new", F.coalesce(F.col("a") > far, F.lit(True)).cast("int"))
              .withColumn("nth", F.sum("new").over(order))
              .groupBy(*same, "nth").agg(F.min("a").alias("a"), F.max("b").alias("b")))
    block = F.floor(F.col("a") / F.lit(_BLOCK)).cast("int")
    cut = (joined.withColumn("block", F.explode(F.expr(f"sequence(int((a + off) div {_BLOCK}), int((b + off - 1) div {_BLOCK}))")))
           .withColumn("a", F.greatest("a", F.col("block") * _BLOCK - F.col("off")))
           .withColumn("b", F.least("b", (F.col("block") + 1) * _BLOCK - F.col("off")))
           .select("doc_id", "tk", "a", "b", "src", "src_tk", "block", F.expr("a + off as lo"), F.expr("b + off as hi")))
    if again is not None:
        cut = cut.unionByName(again.select("doc_id", "tk", "a", "b", "src", "src_tk", F.expr(f"int(src_a div {_BLOCK}) as block"),
                                           F.col("src_a").alias("lo"), F.expr("src_a + 1 as hi")))
    lower = stored(late.groupBy(F.col("doc_id").alias("src"), F.col("tk").alias("src_tk"), block.alias("block"))
                   .agg(F.collect_set(F.struct("a", "src")).alias("lower")), "lower")
    least = F.expr("least(src, array_min(transform(filter(lower, x -> x.a >= lo and x.a < hi), x -> x.src)))")
    return cut.join(lower, ["src", "src_tk", "block"], "left").select("doc_id", "tk", "a", "b", least.alias("src"))


def found_batch(doc: np.ndarray, tk: np.ndarray, a: np.ndarray, b: np.ndarray, src: np.ndarray, shared: list,
                via: tuple[pa.Array, ...] | None = None) -> pa.RecordBatch:
    """``FOUND`` rows; ``via`` src_tk, src_a and src_again."""
    n = len(doc)
    via = via or (pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.bool_()))
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(tk), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(src), pa.array(shared, pa.binary()),
         *via], ["doc_id", "tk", "a", "b", "src", "shared", "src_tk", "src_a", "src_again"])


def merge_windows(row: np.ndarray, at: np.ndarray, src: np.ndarray, rep: np.ndarray | None = None,
                  rep_at: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Windows (row, start, source) as spans (row, a, b, source) of consecutive starts. With ``rep``
    and ``rep_at``, the row and start of the same window in the source, also these of a span's
    first window; they are consecutive in a span too."""
    order = np.lexsort((at, row))
    row, at, src = row[order], at[order], src[order]
    new = np.append(True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1) | (src[1:] != src[:-1])) if len(row) else np.zeros(0, bool)
    if rep is not None and len(row):
        rep, rep_at = rep[order], rep_at[order]
        new[1:] |= (rep[1:] != rep[:-1]) | (rep_at[1:] - rep_at[:-1] != (rep[1:] >= 0))
    k = np.flatnonzero(new)
    spans = row[k], at[k], at[np.append(k[1:], len(row)) - 1] + 1 if len(k) else at[k], src[k]
    return spans if rep is None else (*spans, rep[k], rep_at[k])
