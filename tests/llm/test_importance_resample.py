import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewell.llm import importance_resample as ir
from pricewell.llm.words import text_bytes

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def buckets(text):
    return [zlib.crc32(f.encode()) % 10000 for f in features(text)[1]]


def brute(docs, target):
    """[(doc_id, n_features, weight, score, rank)] by the contract's words."""
    s, t = [0] * 10000, [0] * 10000
    for many, out in ((docs, s), (target, t)):
        for row in many:
            for b in buckets(row[-1]):
                out[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000)))) for b in range(10000)]
    rows = []
    for doc_id, text in docs:
        own = buckets(text)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(own), weight, score, None, len(features(text)[0]) >= 20])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[:len(able) * 25 // 100]):
        r[4] = i + 1
    return sorted(map(str, (tuple(r[:5]) for r in rows)))


def result(df):
    return sorted(map(str, (tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())))


def test_buckets_are_checksums():
    import pyarrow as pa
    texts = ["", None, "a", "Ünï a-b_c 12 x" + "y" * 300 + " z", "word " * 3, "\x00\x7fA", "é" * 40 + " " + "q" * 48 + " " + "r" * 49 + " end"]
    data, off = text_bytes(pa.array(texts))
    first, one, two = ir.feature_buckets(data, off)
    for i, t in enumerate(texts):
        n = first[i + 1] - first[i]
        got = list(one[first[i]:first[i + 1]]) + list(two[first[i]:first[i + 1]][:max(0, n - 1)])
        assert got == buckets(t)


def test_odd_rows(spark):
    random.seed(3)
    docs = [(i, " ".join(random.choices(["alpha", "Beta", "ça", "12", "x" * 60], k=random.randint(0, 60)))) for i in range(200)]
    docs += [(None, docs[3][1]), (None, None), (5, docs[5][1]), (5, docs[5][1]), (5, docs[6][1] + " beta more"), (-4, ""),
             (2 ** 62, docs[7][1]), (-2 ** 62, docs[8][1]), (7, "long " * 30000)]
    target = [("beta ça 12 beta",), (None,), ("",)]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in docs], "doc_id long, text string, rank int, _at int")
    tf = spark.createDataFrame(target, "text string")
    assert result(ir.resample(df, tf)) == brute(docs, target)
    assert result(ir.resample(df, tf.limit(0))) == brute(docs, [])
    assert ir.resample(df.limit(0), tf).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_radix_order(spark, seed):
    """Any keys, one of them held by a third of all rows, over many blocks."""
    rng = np.random.default_rng(seed)
    n = 3000
    a = np.where(rng.random(n) < 0.34, -7, rng.integers(-2 ** 40, 2 ** 40, n))
    b = rng.integers(-50, 50, n)
    rows = [(int(x), int(y), i) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a long, b long, i long").repartition(7)
    got = ir.radix_positions(df, ["a", "b"]).collect()
    assert sorted(r.pos for r in got) == list(range(n))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.pos)] == sorted((x, y) for x, y, _ in rows)
    assert sorted(r.i for r in got) == list(range(n))


def test_whole_range_of_longs(spark):
    rows = [(x,) for x in (-2 ** 63, 2 ** 63 - 1, 0, -1, 5, 5)]
    got = ir.radix_positions(spark.createDataFrame(rows, "a long"), ["a"]).orderBy("pos").collect()
    assert [r.a for r in got] == sorted(x for x, in rows)


def test_reruns_agree(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.lit("w")] * 15, *[(F.col("id") % k).cast("string") for k in range(2, 12)]).alias("text"))
    target = spark.createDataFrame([("w 1 1 1",)], "text string")
    assert result(ir.resample(df.repartition(5), target)) == result(ir.resample(df.repartition(3, "text"), target))


def test_query_against_brute_force(spark):
    from pricewell.llm import queries
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bench = [(r.text,) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert result(queries.QUERIES["op11_importance_resample"](spark, sf)) == brute(docs, bench)
