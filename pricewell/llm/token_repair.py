"""Token-ID output with Re-Pair grammar compression.

Texts are encoded in ascending doc_id order and written in shards. A shard's ids are compressed by
a grammar: frequent pairs of neighbouring symbols are replaced by new symbols, round after round,
and a shard stores the rules, the number of ids each rule expands to, and where each document
begins, so one document is decoded without the others. No rule crosses documents.

A shard is one row of a Parquet table, written and read by Spark: ``part`` and ``seq`` (order of
shards), ``doc_ids``, ``n_ids`` and ``shard``, the binary file:

    magic RPT1 | vocabulary, documents, rules, symbols (uint32 each) | ids (uint64)
    first symbol of each document, and the end   uint32 * (documents + 1)
    expansion length of each rule                uint32 * rules
    left and right symbol of each rule           uint16 * 2 * rules
    symbols                                      uint16 * symbols

Symbols below the vocabulary size are ids; symbol ``vocabulary + k`` is rule k.
"""
from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import scratch_path
from .words import slices, text_bytes, word_hashes

END_ID = 2
SHARD_IDS = 1 << 21        # ids after which a shard is closed, with the document that reaches them
MIN_COUNT, ROUND_RULES, LEAST_GAIN = 24, 3072, 0.03
CACHE_PIECES = 1 << 20
MAGIC = b"RPT1"
SYMBOLS = 1 << 16
HEAD = struct.Struct("<4sIIIIQ")

# White space of ASCII (fixed values); the encoder takes texts with other white space whole.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLAIN = np.zeros(256, bool)      # letters and digits of ASCII
_PLAIN[48:58] = _PLAIN[65:91] = _PLAIN[97:123] = True
_LETTER = _PLAIN.copy()
_LETTER[48:58] = False
_SIGN = ~_PLAIN & ~_SPACE         # other printing characters of ASCII
_SIGN[:33] = _SIGN[127:] = False
# the set of first bytes lets a search pass over the others quickly
_OTHER_SPACE = re.compile(
    b"[\xc2\xe1\xe2\xe3](?:(?<=\xc2)[\x85\xa0]|(?<=\xe1)\x9a\x80|(?<=\xe2)\x80[\x80-\x8a\xa8\xa9\xaf]|(?<=\xe2)\x81\x9f|(?<=\xe3)\x80\x80)")


def piece_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first piece of each text, with the end) of pieces whose ends are token
    boundaries in byte-level BPE, whatever stands around them: a word with the single space before
    it; of the white space before a word, all but its last character, and that character if it is
    not a space; white space that ends a text."""
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before, after = np.append(False, space[:-1]), np.append(space[1:], False)
    new = edge[:-1] | (space & ~before) | (space & ~after & ~edge[1:]) | (~space & before & (np.append(0, data[:-1]) != 32))
    sign = np.flatnonzero(_SIGN[data])
    sign = sign[sign > 0]
    last, lead = data[sign - 1], data[sign - 2]     # of a text's first bytes, edges decide
    new[sign[_PLAIN[last] | ((lead == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7))]] = True
    starts = np.flatnonzero(new)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, off)


def is_word(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each piece is a single word of letters of ASCII and U+00C0 to U+00FF, with or without
    one space before it: a pre-token by itself."""
    letter = _LETTER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] >= 0x80) & (data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    letter[lead] = letter[lead + 1] = True
    others = np.append(0, np.cumsum(~letter))
    first = starts + (data[starts] == 32)
    return (first < ends) & (others[ends] == others[first])


_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def _byte_characters() -> np.ndarray:
    """The character that stands for each byte in a byte-level vocabulary: printing characters of
    Latin-1 for themselves, the other bytes in order from U+0100."""
    printing = np.zeros(256, bool)
    printing[33:127] = printing[161:173] = printing[174:256] = True
    out = np.arange(256)
    out[~printing] = 256 + np.arange((~printing).sum())
    return out.astype("<u2")


_CHARACTER = _byte_characters()


def heads(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first eight bytes of each piece with its length, in one number."""
    view = np.ndarray((len(raw) + 1,), "<u8", raw + bytes(8), strides=(1,))
    size = ends - starts
    return (view[starts] & _KEEP[np.minimum(size, 8)]) ^ size.astype(np.uint64) << np.uint64(56)


class Encoder:
    """Encodes whole texts with the tokenizers library.

    Pieces recur, so each is encoded once and its ids are kept under a 64-bit hash; a piece that
    differs from the kept one in length or first bytes, a text with the string of an added token,
    and one with white space beyond ASCII make the library encode the whole text instead. A piece
    that is one word goes to the library's model alone, since there is nothing to split in it.
    A vocabulary of more than 65,536 ids does not fit the shards and raises a ValueError.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        if self.vocabulary > SYMBOLS:
            raise ValueError(f"shards hold 16-bit symbols; the tokenizer has {self.vocabulary} ids")
        parts = json.loads(self.tokenizer.to_str())
        split = parts.get("pre_tokenizer") or {}
        self.direct = (parts.get("normalizer") is None and parts["model"].get("type") == "BPE" and split.get("type") == "ByteLevel"
                       and split.get("use_regex", True) and not split.get("add_prefix_space", True))
        added = [re.escape(t.content.encode()) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = [re.compile(b"|".join(added)), _OTHER_SPACE] if added else [_OTHER_SPACE]
        self.forget()

    def forget(self) -> None:
        self.number: dict[int, int] = {}
        self.hash, self.head = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.ids, self.length, self.begin = np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def _make_room(self) -> None:
        """Keep the pieces that came up again since they were learned; memory stays bounded."""
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > CACHE_PIECES // 2:
            return self.forget()
        self.ids = self._ids_of(keep)
        self.hash, self.head, self.length = self.hash[keep], self.head[keep], self.length[keep]
        self.begin, self.uses = np.cumsum(self.length) - self.length, np.ones(len(keep), np.int64)
        self.number = dict(zip(self.hash.tolist(), range(len(keep))))

    def _ids_of(self, known: np.ndarray) -> np.ndarray:
        n = self.length[known]
        return self.ids[np.arange(n.sum()) + np.repeat(self.begin[known] - np.cumsum(n) + n, n)]

    def _encode_pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
        size = ends - starts
        ends = np.cumsum(size)
        data = data[np.arange(ends[-1]) + np.repeat(starts - ends + size, size)]
        starts, raw = ends - size, data.tobytes()
        word = is_word(data, starts, ends) & self.direct
        found: list[list[int]] = [[]] * len(starts)
        if word.any():
            said, tokenize = _CHARACTER[data].tobytes().decode("utf-16-le"), self.tokenizer.model.tokenize
            for i, a, b in zip(np.flatnonzero(word).tolist(), starts[word].tolist(), ends[word].tolist()):
                found[i] = [t.id for t in tokenize(said[a:b])]
        rest = np.flatnonzero(~word).tolist()
        pieces = [raw[starts[i]:ends[i]].decode("utf-8", "surrogatepass") for i in rest]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)):
            found[i] = e.ids
        return found

    def _learn(self, found: list[list[int]], hashes: np.ndarray, head: np.ndarray) -> None:
        length = np.fromiter(map(len, found), np.int64, len(found))
        self.number.update(zip(hashes.tolist(), range(len(self.hash), len(self.hash) + len(found))))
        self.begin = np.append(self.begin, len(self.ids) + np.cumsum(length) - length)
        self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(found), np.uint16, int(length.sum())))
        self.length, self.uses = np.append(self.length, length), np.append(self.uses, np.zeros(len(length), np.int64))
        self.hash, self.head = np.append(self.hash, hashes), np.append(self.head, head)

    def encode_bytes(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each) of concatenated UTF-8 texts."""
        raw = data.tobytes()
        starts, ends, first = piece_spans(data, off)
        head = heads(raw, starts, ends)
        code, hashes = pd.factorize(word_hashes(data, starts, ends))
        sample = np.empty(len(hashes), np.int64)
        sample[code[::-1]] = np.arange(len(code))[::-1]
        if len(self.number) + len(hashes) > CACHE_PIECES:
            self._make_room()
        known = np.fromiter(map(self.number.get, hashes.tolist(), repeat(-1)), np.int64, len(hashes))
        new = np.flatnonzero(known < 0)
        if len(new):
            known[new] = np.arange(len(self.number), len(self.number) + len(new))
            at = sample[new]
            self._learn(self._encode_pieces(data, starts[at], ends[at]), hashes[new], head[at])
        self.uses[known] += 1
        known = known[code]
        ids, n = self._ids_of(known), self.length[known]
        sums = np.append(0, np.cumsum(n))[first]
        text_of = lambda places: np.searchsorted(off, places, "right") - 1
        odd = np.union1d(text_of(starts[self.head[known] != head]), text_of([m.start() for x in self.special for m in x.finditer(raw)]))
        if not len(odd):
            return ids, np.diff(sums)
        parts, at = [], 0
        sizes = np.diff(sums)
        for k in odd.astype(int).tolist():
            own = self.tokenizer.encode(raw[off[k]:off[k + 1]].decode("utf-8", "surrogatepass"), add_special_tokens=False).ids
            parts += [ids[at:sums[k]], np.array(own, np.uint16)]
            at, sizes[k] = sums[k + 1], len(own)
        return np.concatenate([*parts, ids[at:]]), sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.encode_bytes(*text_bytes(pa.array(texts, pa.string())))


def grammar(ids: np.ndarray, last: np.ndarray, vocabulary: int, min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules, last) of ids (uint16); ``last`` marks the last symbol of each document.

    Each round counts all pairs of neighbours, makes rules of the most frequent and replaces them
    from left to right. Rounds end when symbols or frequent pairs run out, or gain little.
    """
    seq, last, rules = ids.astype(np.uint16), last.copy(), []
    room = SYMBOLS - vocabulary
    while len(seq) > 1 and room > 0:
        pair = seq[:-1].astype(np.uint32) << np.uint32(16) | seq[1:]
        ordered = np.sort(pair[~last[:-1]])
        if not len(ordered):
            break
        new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        count = np.diff(np.append(new, len(ordered)))
        often = np.flatnonzero(count >= min_count)
        if not len(often):
            break
        take = min(ROUND_RULES, room)
        if len(often) > take:
            often = often[np.argpartition(-count[often], take - 1)[:take]]
        key = ordered[new[often]]
        key = key[np.lexsort((key, -count[often]))]

        def slot(x: np.ndarray) -> np.ndarray:
            return (x * np.uint32(2654435761)) >> np.uint32(13)

        where = np.full(1 << 19, -1, np.int32)
        where[slot(key)[::-1]] = np.arange(len(key), dtype=np.int32)[::-1]
        key = key[where[slot(key)] == np.arange(len(key))]   # pairs that share a slot wait for a later round
        where.fill(-1)
        where[slot(key)] = np.arange(len(key), dtype=np.int32)
        rule = where[slot(pair)]
        at = np.flatnonzero(rule >= 0)
        at = at[(key[rule[at]] == pair[at]) & ~last[at]]
        # of overlapping pairs the first, third, ... are replaced
        run = np.maximum.accumulate(np.where(np.append(True, at[1:] != at[:-1] + 1), at, 0)) if len(at) else at
        at = at[(at - run) % 2 == 0]
        seq[at] = (vocabulary + len(rules) + rule[at]).astype(np.uint16)
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last = seq[keep], last[keep]
        rules += zip((key >> np.uint32(16)).tolist(), (key & np.uint32(0xFFFF)).tolist())
        room -= len(key)
        if len(at) < LEAST_GAIN * len(keep):
            break
    return seq, np.array(rules, np.uint16).reshape(-1, 2), last


def pack(ids: np.ndarray, sizes: np.ndarray, vocabulary: int, min_count: int = MIN_COUNT) -> bytes:
    """A shard of documents with ``sizes`` ids each (at least one)."""
    last = np.zeros(len(ids), bool)
    last[np.cumsum(sizes) - 1] = True
    seq, rules, last = grammar(ids, last, vocabulary, min_count)
    first = np.append(0, np.flatnonzero(last) + 1).astype("<u4")
    length = [1] * vocabulary
    for a, b in rules.tolist():
        length.append(length[a] + length[b])
    return b"".join([HEAD.pack(MAGIC, vocabulary, len(sizes), len(rules), len(seq), len(ids)), first.tobytes(),
                     np.array(length[vocabulary:], "<u4").tobytes(), rules.astype("<u2").tobytes(), seq.astype("<u2").tobytes()])


class Shard:
    """Reads a packed shard: all documents, or one."""

    def __init__(self, blob: bytes):
        magic, self.vocabulary, self.documents, n_rules, n_symbols, self.n_ids = HEAD.unpack_from(blob)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEAD.size
        self.first = np.frombuffer(blob, "<u4", self.documents + 1, at)
        at += self.first.nbytes
        length = np.frombuffer(blob, "<u4", n_rules, at)
        at += length.nbytes
        self.rules = np.frombuffer(blob, "<u2", 2 * n_rules, at).reshape(-1, 2)
        at += self.rules.nbytes
        self.symbols = np.frombuffer(blob, "<u2", n_symbols, at)
        self.length = np.append(np.ones(self.vocabulary, np.int64), length)
        self._expanded = None

    def sizes(self) -> np.ndarray:
        """Number of ids of each document, from expansion lengths alone."""
        total = np.append(0, np.cumsum(self.length[self.symbols]))
        return np.diff(total[self.first])

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        if self._expanded is None:
            each = [b""] * len(self.rules)
            v = self.vocabulary
            single = np.arange(v, dtype="<u2").tobytes()
            for k, (a, b) in enumerate(self.rules.tolist()):
                each[k] = (single[2 * a:2 * a + 2] if a < v else each[a - v]) + (single[2 * b:2 * b + 2] if b < v else each[b - v])
            flat = np.frombuffer(single + b"".join(each), "<u2")
            self._expanded = flat, np.cumsum(self.length) - self.length
        flat, first = self._expanded
        n = self.length[symbols]
        return flat[np.arange(n.sum()) + np.repeat(first[symbols] - np.cumsum(n) + n, n)]

    def ids(self) -> np.ndarray:
        return self._expand(self.symbols)

    def document(self, k: int) -> np.ndarray:
        """The ids of document ``k``, from its symbols alone."""
        return self._expand(self.symbols[self.first[k]:self.first[k + 1]])


_ENCODERS: dict[str, Encoder] = {}


def _write(path: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        encoder, part = _ENCODERS[path], TaskContext.get().partitionId()
        ids, sizes, docs, held, seq = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            blob = pack(np.concatenate(ids), np.concatenate(sizes), encoder.vocabulary)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([[d for x in docs for d in x]], pa.list_(pa.int64())),
                 pa.array([held], pa.int64()), pa.array([blob], pa.binary())], ["part", "seq", "doc_ids", "n_ids", "shard"])

        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                own, n = encoder.encode_bytes(*text_bytes(piece.column("text")))
                end = np.cumsum(n)
                ids.append(np.insert(own, end, end_id))
                sizes.append(n + 1)
                docs.append(piece.column("doc_id").to_pylist())
                held += len(ids[-1])
                if held >= shard_ids:
                    yield close()
                    ids, sizes, docs, held, seq = [], [], [], 0, seq + 1
        if held:
            yield close()
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encode every text of ``docs`` (doc_id, text) and write shards in ascending doc_id order.

    Null and empty texts have the end id alone. Rows without doc_id come first; rows that repeat a
    doc_id follow one another by the hash of their text. ``tokenizer`` is a file that all executors
    have. An empty table writes no shard; other columns are ignored.
    """
    order = ["doc_id", "_t"]
    rows = (docs.select("doc_id", "text", F.xxhash64("text").alias("_t"))
            .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"))
    rows.mapInArrow(_write(tokenizer, end_id, shard_ids), "part int, seq int, doc_ids array<long>, n_ids long, shard binary").write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            shard = Shard(batch.column("shard")[row].as_py())
            ids, sizes = shard.ids().astype("<u4"), shard.sizes()
            end = np.cumsum(sizes)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((end - sizes).tolist(), end.tolist())]
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, batch.column("part")[row].as_py(), np.int32)), pa.array(np.full(n, batch.column("seq")[row].as_py(), np.int32)),
                 batch.column("doc_ids")[row].values, pa.array(end - sizes), pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64())],
                ["part", "seq", "doc_id", "within", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the shards below ``path``: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 (of the decoded ids as little-endian unsigned 32-bit integers)."""
    shards = spark.read.parquet(path)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row per writing task
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    own = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = (shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(own), F.lit(0)).alias("_in")).join(parts, "part")
              .select("part", "seq", (F.col("base") + F.col("_in")).alias("_start")))
    rows = shards.mapInArrow(_read, "part int, seq int, doc_id long, within long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["part", "seq"]).select("doc_id", (F.col("_start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the shards to the shared folder and read the documents back from them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, end_id, shard_ids)
    return read_tokens(spark, path)
