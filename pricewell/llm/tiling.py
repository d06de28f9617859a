"""Benchmark decontamination by greedy string tiling.

Documents are joined with benchmark items on shared seeds, runs of ``MATCH`` words. A pair whose
seeds could cover enough of the item is tiled: running Karp-Rabin hashes find the longest matches
of words not yet marked, these are marked, and shorter ones follow down to ``MATCH`` words. The
share of the item's words that the tiles cover decides, so passages that were cut and reordered
count in full. Words are runs of letters, digits and bytes above 127, lower-cased.

Texts and items meet by joins of seed hashes. Of an item only as many of its rarest seeds are
joined as a text that holds it can't all lack; a filter of bounded size, made of all seeds, keeps
the other words of the documents out of the shuffle. Each pair found is tiled, whatever their number.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .crossparse_lang import fold
from .shared import row_number_of, stored
from .words import mix, rolling, slices, text_bytes, word_hashes

MATCH, COVERAGE = 5, 0.8
# Items of one text are tiled in groups of about this many bytes (an item counts 1,024 more).
GROUP_BYTES = 256 << 10
# The largest filter, 16 MB; a smaller one has 16 bits or more for each value.
FILTER_BITS = 1 << 27
# Two hashes of a text tell texts apart.
KEY = ["_tk", "_tk2"]

_WORD = np.zeros(256, bool)
_WORD[128:] = True
_WORD[48:58] = _WORD[97:123] = _WORD[65:91] = True


def plain_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts, ends, first word of each text with the end)."""
    inside = _WORD[data]
    low = np.where(data < 128, np.where((data >= 48) & (data < 58), data, fold(data)), fold(data))
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begin)
    return low, starts, np.flatnonzero(end) + 1, np.searchsorted(starts, off)


def tiles(item: list, text: list, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of ``item`` by ``text``: (place in item, place in text, words), longest
    first, no word of either side in two tiles, none shorter than ``least``."""
    number: dict = {}
    a = np.array([number.setdefault(w, len(number)) for w in item], np.uint64)
    b = np.array([number.setdefault(w, len(number)) for w in text], np.uint64)
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    out = []
    for size in range(min(len(a), len(b)), max(least, 1) - 1, -1):
        def places(free: np.ndarray) -> np.ndarray:
            run = np.append(0, np.cumsum(free))
            return np.flatnonzero(run[size:] - run[:-size] == size)

        at_a, at_b = places(free_a), places(free_b)
        if not len(at_a) or not len(at_b):
            continue
        hash_a, hash_b = rolling(a + np.uint64(1), size), rolling(b + np.uint64(1), size)
        at_b = at_b[np.isin(hash_b[at_b], hash_a[at_a])]
        where: dict[int, list[int]] = {}
        for j in at_b.tolist():
            where.setdefault(int(hash_b[j]), []).append(j)
        for i in at_a.tolist():
            for j in where.get(int(hash_a[i]), ()):
                if not free_a[i:i + size].all():
                    break
                if free_b[j:j + size].all() and np.array_equal(a[i:i + size], b[j:j + size]):
                    free_a[i:i + size] = free_b[j:j + size] = False
                    out.append((i, j, size))
    return out


class Seeds:
    """The seeds of a group of items: for each seed size, hash -> (item, place) and item -> seeds."""

    def __init__(self, items: list[tuple[int, str]], match: int, coverage: float):
        self.match, self.coverage, self.ids = match, coverage, [i for i, _ in items]
        data, off = text_bytes(pa.array([t or "" for _, t in items], pa.string()))
        low, starts, ends, first = plain_words(data, off)
        raw = low.tobytes()
        self.words = [[raw[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())] for a, b in zip(first[:-1], first[1:])]
        self.size = np.diff(first)
        h = word_hashes(low, starts, ends) if len(low) else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(items)), self.size)
        self.tables = {}
        for k in sorted({int(min(match, n)) for n in self.size if n}):
            mers = rolling(h, k)
            at = np.arange(len(mers))
            at = at[(at + k <= first[item[at] + 1]) & (np.minimum(self.size[item[at]], match) == k)]
            order = np.argsort(mers[at], kind="stable")
            at = at[order]
            keys, begin = np.unique(mers[at], return_index=True)
            begin = np.append(begin, len(at))
            by_item = np.argsort(item[at], kind="stable")
            seed = np.repeat(np.arange(len(keys)), np.diff(begin))[by_item]
            own = np.searchsorted(item[at][by_item], np.arange(len(items) + 1))
            self.tables[k] = (keys, begin, item[at], at - first[item[at]], [seed[a:b] for a, b in zip(own[:-1], own[1:])])

    def matches(self, part: pa.RecordBatch) -> Iterator[tuple[int, int, int, int, float]]:
        """(row, item, words covered, tiles, coverage) of each text that holds an item."""
        low, starts, ends, first = plain_words(*text_bytes(part.column("text")))
        if not len(starts):
            return
        h, text = word_hashes(low, starts, ends), np.repeat(np.arange(len(first) - 1), np.diff(first))
        for k, (keys, begin, item, place, seeds_of) in self.tables.items():
            mers = rolling(h, k)
            at = np.arange(len(mers))
            seed = np.minimum(np.searchsorted(keys, mers), len(keys) - 1)
            ok = (keys[seed] == mers) & (at + k <= first[text[at] + 1])
            at, seed = at[ok], seed[ok]
            if not len(at):
                continue
            # each text's distinct seeds, with the item places they have
            one = np.unique(text[at] * np.int64(len(keys)) + seed)
            row, sd = one // len(keys), one % len(keys)
            n = begin[sd + 1] - begin[sd]
            flat = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[sd], n)
            row, it, pl = np.repeat(row, n), item[flat], place[flat]
            order = np.lexsort((pl, it, row))
            row, it, pl = row[order], it[order], pl[order]
            new = np.append(True, (row[1:] != row[:-1]) | (it[1:] != it[:-1]))
            # words that the seeds cover: each place adds what reaches beyond the place before
            gain = np.where(new, k, np.minimum(k, pl - np.append(0, pl[:-1])))
            group = np.cumsum(new) - 1
            most = np.bincount(group, gain)
            head = np.flatnonzero(new)
            for g in np.flatnonzero(most >= self.coverage * self.size[it[head]] - 1e-9):
                r, i = int(row[head[g]]), int(it[head[g]])
                # only words in a seed of this item can be in a tile
                own = slice(*np.searchsorted(at, first[r:r + 2]))
                mark = np.zeros(first[r + 1] - first[r], bool)
                for p in (at[own][np.isin(seed[own], seeds_of[i])] - first[r]).tolist():
                    mark[p:p + k] = True
                words, gap = [], 0
                for p in np.flatnonzero(mark).tolist():
                    if p and not mark[p - 1]:
                        gap += 1
                        words.append(gap)  # a number is equal to no word
                    w = first[r] + p
                    words.append(low[starts[w]:ends[w]].tobytes())
                found = tiles(self.words[i], words, k)
                covered = sum(x[2] for x in found)
                if covered >= self.coverage * len(self.words[i]) - 1e-9:
                    yield r, i, covered, len(found), covered / len(self.words[i])


def _item_seeds(match: int):
    """Each item's distinct seeds: the item's words, the seed's size, its hash and its places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                low, starts, ends, first = plain_words(*text_bytes(part.column("text")))
                size = np.diff(first)
                h = word_hashes(low, starts, ends) if len(low) else np.zeros(0, np.uint64)
                text = np.repeat(np.arange(len(size)), size)
                rows, keys, many = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for k in np.unique(np.minimum(size[size > 0], match)).tolist():
                    mers = seed_keys(h, k)
                    at = np.arange(len(mers))
                    at = at[(at + k <= first[text[at] + 1]) & (np.minimum(size[text[at]], match) == k)]
                    order = at[np.lexsort((mers[at], text[at]))]
                    new = np.flatnonzero(np.append(True, (mers[order][1:] != mers[order][:-1]) | (text[order][1:] != text[order][:-1])))
                    rows.append(text[order][new]), keys.append(mers[order][new]), many.append(np.diff(np.append(new, len(order))))
                row = np.concatenate(rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rid").take(pa.array(row)), pa.array(size[row].astype(np.int64)), pa.array(np.minimum(size[row], match).astype(np.int32)),
                     pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(many).astype(np.int64))],
                    ["rid", "n", "k", "h", "many"])
    return run


def seed_keys(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, different for each ``k``."""
    return mix(rolling(h, k) + np.uint64(k)) if len(h) >= k else np.zeros(0, np.uint64)


def _text_seeds(sizes: list[int], bits: np.ndarray):
    """Each text's distinct seeds that pass the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                low, starts, ends, first = plain_words(*text_bytes(part.column("text")))
                h = word_hashes(low, starts, ends) if len(starts) else np.zeros(0, np.uint64)
                text = np.repeat(np.arange(len(first) - 1), np.diff(first))
                rows, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                for k in sizes:
                    mers = seed_keys(h, k)
                    at = np.flatnonzero(passes(bits, mers.view(np.int64)))
                    at = at[at + k <= first[text[at] + 1]]
                    rows.append(text[at]), keys.append(mers[at])
                row, key = np.concatenate(rows), np.concatenate(keys)
                order = np.lexsort((key, row))
                row, key = row[order], key[order]
                one = np.append(True, (row[1:] != row[:-1]) | (key[1:] != key[:-1]))[:len(row)]
                at = pa.array(row[one])
                yield pa.RecordBatch.from_arrays([*(part.column(x).take(at) for x in KEY), pa.array(key[one].view(np.int64))], [*KEY, "h"])
    return run


def _tiled(match: int, coverage: float):
    """The items of each row's group that its text holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                part = batch.slice(at, 1)
                seeds = Seeds([(x["item_id"], x["text"]) for x in part.column("items")[0].as_py()], match, coverage)
                rows = list(seeds.matches(part))
                key = pa.array([0] * len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x).take(key) for x in KEY), pa.array([seeds.ids[x[1]] for x in rows], pa.int64()),
                     pa.array([len(seeds.words[x[1]]) for x in rows], pa.int64()), pa.array([x[2] for x in rows], pa.int64()),
                     pa.array([x[3] for x in rows], pa.int64()), pa.array([x[4] for x in rows], pa.float64())],
                    [*KEY, "item_id", "item_words", "covered", "n_tiles", "coverage"])
    return run


def hash_filter(values: DataFrame, column: str) -> np.ndarray:
    """A bit for the low bits of each hash in ``column``, as bytes: at most ``FILTER_BITS`` bits,
    whatever the number of values. A value without its bit is not among them."""
    count = values.count()
    size = min(FILTER_BITS, 1 << max(15, (16 * count).bit_length()))
    place = F.col(column).bitwiseAND(F.lit(size - 1)) + 1
    parts = (values.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect())
    bits = np.zeros(size // 8, np.uint8)
    for r in parts:
        at = (r.bucket - 1) * 4096
        bits[at:at + 4096] = np.frombuffer(bytes(r.bits), np.uint8)
    return bits


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & (8 * len(bits) - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _passing(column: str, bits: np.ndarray, wanted: bool = True):
    """The rows whose hash passes the filter, or those whose hash does not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(column).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(passes(bits, h) == wanted))
    return run


def with_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn(KEY[0], F.xxhash64("text")).withColumn(KEY[1], F.xxhash64(F.lit(1), "text"))


def held_items(docs: DataFrame, benchmark: DataFrame, match: int, coverage: float) -> DataFrame:
    """The items that each different text holds, by the text's key; a stored table."""
    items = stored(benchmark.filter("item_id is not null and text is not null").select("item_id", "text").distinct()
                   .select(row_number_of(), "item_id", "text"), "items")
    seeds = stored(items.mapInArrow(_item_seeds(match), "rid long, n long, k int, h long, many long"), "seeds")
    sizes = sorted(r.k for r in seeds.select("k").distinct().collect())
    texts = with_key(docs.filter("text is not null").select("text"))
    mine = stored(texts.mapInArrow(_text_seeds(sizes, hash_filter(seeds, "h")), "_tk long, _tk2 long, h long").distinct(), "text-seeds")
    # a text that holds an item has at least ``need`` of its places in tiles: a tile of t words has
    # t - k + 1 places, not less than t / k. So ``need`` - 1 places, those most texts have, are left out
    rank = Window.partitionBy("rid").orderBy(F.desc("texts"), "h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    need = F.greatest(F.ceil((F.col("n") * F.lit(coverage) - F.lit(1e-9)) / F.col("k")), F.lit(1))
    rare = stored(seeds.join(mine.groupBy("h").agg(F.count(F.lit(1)).alias("texts")), "h", "left")
                  .withColumn("places", F.sum("many").over(rank))
                  .filter(F.col("texts").isNotNull() & (F.col("places") >= need)).select("rid", "h"), "rare-seeds")
    pairs = stored(mine.join(rare, "h").select(*KEY, "rid").distinct(), "pairs")
    # a text's items in groups of bounded size
    sized = pairs.join(items.select("rid", (F.octet_length("text") + 1024).alias("size")), "rid")
    cuts = stored(sized.groupBy(*KEY).agg(F.ceil(F.sum("size") / F.lit(GROUP_BYTES)).alias("cuts")), "cuts")
    groups = (pairs.join(cuts, KEY).withColumn("cut", F.pmod(F.xxhash64("rid"), F.col("cuts"))).join(items, "rid")
              .groupBy(*KEY, "cut").agg(F.collect_list(F.struct("item_id", "text")).alias("items")))
    # texts without a pair are left out before the shuffle
    found = (texts.mapInArrow(_passing(KEY[0], hash_filter(cuts, KEY[0])), texts.schema)
             .join(cuts.select(*KEY), KEY, "left_semi").dropDuplicates(KEY))
    return stored(groups.join(found, KEY).select(*KEY, "text", "items").mapInArrow(
        _tiled(match, coverage), "_tk long, _tk2 long, item_id long, item_words long, covered long, n_tiles long, coverage double"), "held")


def leaks(docs: DataFrame, benchmark: DataFrame, match: int = MATCH, coverage: float = COVERAGE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) and item of ``benchmark`` (item_id, text) it holds:
    doc_id, item_id, item_words, covered, n_tiles, coverage (covered / item_words >= ``coverage``).

    An item below ``match`` words has to occur whole. Items without words, null or empty texts hold
    and are held by nothing. Equal items each give a row, rows of ``benchmark`` that repeat one do
    not. Repeated rows of ``docs`` each give theirs. Empty tables give an empty result; other columns
    are ignored.
    """
    held = held_items(docs, benchmark, match, coverage)
    return (with_key(docs.select("doc_id", "text")).drop("text").join(held, KEY)
            .select("doc_id", "item_id", "item_words", "covered", "n_tiles", "coverage"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, match: int = MATCH, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the rows that hold an item of ``benchmark`` (see ``leaks``). Only rows that
    pass a filter made of the texts to remove are joined with these."""
    gone = stored(held_items(docs, benchmark, match, coverage).select(*KEY).distinct(), "gone")
    bits = hash_filter(gone, KEY[0])
    # other columns may have any name
    keyed = with_key(docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]))
    clear = keyed.mapInArrow(_passing(KEY[0], bits, False), keyed.schema)
    rest = keyed.mapInArrow(_passing(KEY[0], bits), keyed.schema).join(gone, KEY, "left_anti")
    return clear.unionByName(rest).drop(*KEY).toDF(*docs.columns)
