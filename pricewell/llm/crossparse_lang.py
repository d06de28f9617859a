"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text is built per language. A text is parsed from left to right into
phrases, each the longest match with the automaton's text; a language with familiar text needs few
phrases. Its cost is phrases * log2(size of the largest sample) / bytes of the text, the bits a byte
takes when phrases are sent as places in a sample, and the cheapest language wins. A phrase costs the
same in every language, so a tiny sample isn't cheap; a byte that the language's sample lacks and
another one has costs 8 bits besides, the byte itself.

The labelled sample is bounded: of the ``LANGUAGES`` languages with most training rows,
``SAMPLE_DOCS`` documents each, those with the smallest hash of doc_id. Their texts are cut into blocks
of ``BLOCK`` characters, and blocks from hash-chosen places over the whole texts, in turn of the
documents, are learned until a language has ``SAMPLE_BYTES`` bytes. Every text to be
labelled is parsed whole, in segments of ``SEGMENT`` bytes that run side by side through the
automaton's transition table.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored
from .words import slices, text_bytes

SAMPLE_DOCS, SAMPLE_BYTES, SEGMENT = 64, 32_768, 512
LANGUAGES, BLOCK = 256, 128
LITERAL = 8
UNKNOWN = "und"

# Byte classes: A-Z as a-z, every other ASCII byte that is no letter as a space.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def fold(data: np.ndarray) -> np.ndarray:
    """Lower-case letters of ASCII and of the two-byte range from U+00C0 to U+00DE; no other bytes
    are changed but non-letters of ASCII, which become spaces."""
    out = _FOLD[data]
    if len(data) > 1:
        upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][upper] += 32
    return out


def automaton(text: bytes, classes: np.ndarray, size: int) -> np.ndarray:
    """Transition table of the suffix automaton of ``text`` for greedy parsing.

    Entry [state * size + class]: the next state, times ``size``; where the automaton has none, the
    state after restarting at the root with this byte, inverted (negative): a phrase ends before
    it. A byte that the sample lacks is a phrase of its own, in a last state without ways out.
    Class 0 is padding and stays. ``classes`` maps bytes to 1 .. size - 1.
    """
    link, length, step = [-1], [0], [{}]
    last = 0
    for c in classes[np.frombuffer(text, np.uint8)].tolist():
        cur = len(link)
        link.append(0), length.append(length[last] + 1), step.append({})
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(link)
                link.append(link[q]), length.append(length[p] + 1), step.append(dict(step[q]))
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    table = np.empty((len(link) + 1, size), np.int32)
    restart = np.full(size, len(link) * size, np.int64)
    for c, s in step[0].items():
        restart[c] = s * size
    table[:] = ~restart
    table[0] = restart
    table[:, 0] = np.arange(len(link) + 1) * size
    for s, out in enumerate(step):
        for c, to in out.items():
            table[s, c] = to * size
    return table.ravel()


def phrases(table: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Phrases of each segment; ``columns`` has the classes, one row a place, one column a segment."""
    state = np.zeros(columns.shape[1], np.int32)
    count = np.zeros(columns.shape[1], np.int32)
    for row in columns:
        v = table[state + row]
        sign = v >> 31
        count -= sign
        state = v ^ sign
    return count + (state != 0)


_MODELS: dict[str, tuple] = {}


def _model(samples: dict[str, bytes]) -> tuple:
    """(languages, byte classes, tables, bits a phrase, per language the classes of bytes it lacks),
    built once a process."""
    key = hashlib.sha256(repr(sorted(samples.items())).encode()).hexdigest()
    if key not in _MODELS:
        used = np.unique(np.frombuffer(b"".join(samples.values()), np.uint8))
        classes = np.full(256, len(used) + 1, np.uint8)
        classes[used] = np.arange(1, len(used) + 1)
        size = len(used) + 2
        names = sorted(samples, key=lambda x: x.encode())
        _MODELS.clear()
        lacks = np.ones((len(names), size), bool)
        lacks[:, [0, size - 1]] = False   # padding; bytes that no sample has cost every language the same
        for k, x in enumerate(names):
            lacks[k, classes[np.frombuffer(samples[x], np.uint8)]] = False
        _MODELS[key] = (names, classes, [automaton(samples[x], classes, size) for x in names],
                        np.log2(max(2, *map(len, samples.values()))), lacks)
    return _MODELS[key]


def costs(samples: dict[str, bytes], data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bits a byte of each text (rows) in each language (columns)."""
    _, classes, tables, bits, lacks = _model(samples)
    folded = classes[fold(data)]
    size = np.diff(off)
    each = -(-size // SEGMENT)
    row = np.repeat(np.arange(len(size)), each)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    begin = off[row] + nth * SEGMENT
    out = np.zeros((len(size), len(tables)))
    for s in range(0, len(row), 8192):
        b = begin[s:s + 8192]
        stop = off[row[s:s + 8192] + 1]
        at = b[:, None] + np.arange(SEGMENT)
        cells = np.where(at < stop[:, None], folded[np.minimum(at, len(folded) - 1)], 0)
        columns = np.ascontiguousarray(cells.T).astype(np.int32)
        for k, table in enumerate(tables):
            out[:, k] += np.bincount(row[s:s + 8192], phrases(table, columns), len(size)) * bits
    for k in np.flatnonzero(lacks.any(axis=1)):
        lacking = np.append(0, np.cumsum(lacks[k][folded]))
        out[:, k] += LITERAL * (lacking[off[1:]] - lacking[off[:-1]])
    return out / np.maximum(size, 1)[:, None]


def _predict(samples: dict[str, bytes]):
    names = sorted(samples, key=lambda x: x.encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                cost = costs(samples, *text_bytes(part.column("text")))
                best = cost.argmin(axis=1)
                low = np.sort(cost, axis=1)
                second = low[:, 1] if len(names) > 1 else np.full(len(low), np.inf)
                score = np.clip(1 - low[:, 0] / np.maximum(second, 1e-12), 0, 1)
                known = np.array(part.column("_letter").to_pylist(), bool)
                pred = [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
                cols = [part.column(i) for i, f in enumerate(part.schema) if f.name != "_letter"]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(pred, pa.string()), pa.array(np.where(known, score, 0.0))],
                                                 [*(f.name for f in part.schema if f.name != "_letter"), "lang_pred", "score"])
    return run


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of doc_id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES,
          languages: int = LANGUAGES) -> dict[str, bytes]:
    """The bounded sample: folded text by language, from documents with text, lang and doc_id that
    are not held out; rows that repeat a doc_id and lang count as one, with the text of the smallest
    hash. The driver gets at most ``sample_docs`` rows for each of ``languages`` languages and about
    twice ``sample_bytes`` characters a language."""
    rows = docs.filter("doc_id is not null and lang is not null and length(text) > 0").filter(~held_out(F.col("doc_id")))
    slim = stored(rows.select("doc_id", "lang"), "labelled")
    names = [r.lang for r in slim.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()]
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (slim.filter(F.col("lang").isin(names)).distinct().withColumn("_r", F.row_number().over(order))
              .filter(F.col("_r") <= sample_docs))
    each = F.ceil(F.lit(2.0 * sample_bytes / BLOCK) / F.max("_r").over(Window.partitionBy("lang"))).cast("int")
    # at most sample_docs rows for each of the languages
    chosen = chosen.withColumn("_each", each).drop("_r")
    picked = (rows.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
              .groupBy("doc_id", "lang", "_each").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")))
    places = F.transform(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / BLOCK).cast("int")),
                         lambda b: F.struct(F.xxhash64("doc_id", b).alias("h"), b.alias("b")))
    taken = F.transform(F.slice(F.array_sort(places), F.lit(1), F.col("_each")),
                        lambda x: F.substring("text", x["b"] * BLOCK + 1, F.lit(BLOCK)))
    found: dict[str, list[list[str]]] = {}
    for r in sorted(picked.select("doc_id", "lang", taken.alias("blocks")).collect(), key=lambda r: r.doc_id):
        found.setdefault(r.lang, []).append(r.blocks)
    out = {}
    for lang, texts in found.items():
        turns = [t[k] for k in range(max(map(len, texts))) for t in texts if k < len(t)]
        folded, size = [], 0
        for block in turns:
            folded.append(fold(np.frombuffer(block.encode(), np.uint8)).tobytes())
            size += len(folded[-1]) + 1
            if size > sample_bytes:
                break
        out[lang] = b" ".join(folded)[:sample_bytes]
    return out


def predict(docs: DataFrame, samples: dict[str, bytes]) -> DataFrame:
    """``docs`` with lang_pred and score (columns of these names are replaced); only ``text`` decides.

    lang_pred is ``und`` and score 0 where the text is null or has no letter, or where nothing was
    learned. score is 1 - cost of the best / cost of the second language (1 with one language).
    Ties go to the language that sorts first. No shuffle: rows pass through.
    """
    docs = docs.drop("lang_pred", "score")
    if not samples:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    ready = docs.withColumn("_letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", lang_pred string, score double"
    return ready.mapInArrow(_predict(samples), schema)


def identify(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Repeated rows stay. A row without doc_id is labelled but never learned from. An empty table
    gives an empty result; other columns are ignored.
    """
    samples = learn(docs, sample_docs, sample_bytes)
    found = predict(docs.select("doc_id", "text"), samples)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
