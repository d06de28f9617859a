import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pricewell.llm import token_repair as op

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


ODD = ["", " ", "\n", "a", " a", "a ", "a  b", "a\n b", "a \n\nb", "\t\tx", "don't we'll  I'm", "x y z　", "\x1c\x1d a\x85b", "​q", "1 2  33 4a",
       "<|endoftext|>", "a <|endoftext|> b", "日本 語", "é é", "!!! ??  ...", "\r\n\r\n", "👩‍👩‍👧 x", "\x00\x01", "a'", "'s", " 's", "it's.'some", "9.5's", "é's,x", "a…'s", "×.÷!", "(a)b)'ll", "﻿bom", "  lead", "trail  \n "]


def test_encoding_equals_the_library(tokenizer):
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice(ODD + ["the ", "thing", " and", "ß"]) for _ in range(rnd.randint(1, 30))) for _ in range(300)]
    enc = op.Encoder(PATH)
    ids, sizes = enc.encode(texts)
    at = 0
    for t, n in zip(texts, sizes):
        assert ids[at:at + n].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t
        at += n


def test_a_full_cache_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(op, "CACHE_PIECES", 60)
    rnd = random.Random(2)
    enc = op.Encoder(PATH)
    for _ in range(30):
        texts = [" ".join(rnd.choice(["the", "a", f"w{rnd.randrange(500)}", "x, y.", "(it's)"]) for _ in range(12)) for _ in range(3)]
        ids, _ = enc.encode(texts)
        assert ids.tolist() == [i for t in texts for i in tokenizer.encode(t, add_special_tokens=False).ids]
        assert len(enc.number) == len(enc.hash) <= 60 + 40


@pytest.mark.parametrize("alphabet", [1, 2, 5, 300])
def test_shards_round_trip(alphabet):
    rng = np.random.default_rng(alphabet)
    sizes = rng.integers(1, 400, 60)
    ids = rng.integers(0, alphabet, sizes.sum()).astype(np.uint16)
    shard = op.Shard(op.pack(ids, sizes, 50257, 2))
    assert np.array_equal(shard.ids(), ids) and np.array_equal(shard.sizes(), sizes)
    end = np.cumsum(sizes)
    for k in (0, 7, 59):
        assert np.array_equal(shard.document(k), ids[end[k] - sizes[k]:end[k]])
    if alphabet < 300:
        assert len(shard.symbols) < 0.7 * len(ids)
    assert all(shard.length[a] + shard.length[b] == shard.length[50257 + k] for k, (a, b) in enumerate(shard.rules.tolist()))


def test_documents_round_trip(spark, tokenizer):
    rows = [(i * 3 % 41, t) for i, t in enumerate(ODD)] + [(500, None), (501, "word " * 100_000), (502, "same text"), (503, "same text"), (502, "other text")]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, part int, seq string").repartition(4)
    got = op.round_trip(df, PATH, shard_ids=50).orderBy("start").collect()
    want = {}
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [r.doc_id for r in got] == sorted(i for i, _ in rows)
    assert got[0].start == 0 and all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a"), (3, "b"), (None, None)], "doc_id long, text string")
    assert [r.doc_id for r in op.round_trip(df, PATH).orderBy("start").collect()] == [None, None, 3]
    assert op.round_trip(df.limit(0), PATH).count() == 0
