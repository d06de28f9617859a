import itertools
import random
import re

import numpy as np
import xxhash

from pricewell.llm import simhash_anchor as op


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_print(text):
    w = words(text)
    k = min(3, len(w))
    if not k:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(items, linked):
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(items)), 2):
        if linked(items[i], items[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(items))]


def test_hamming_code_covers_within_one_bit():
    words = np.random.default_rng(2).integers(0, 1 << 64, 2000, dtype=np.uint64)
    row, anchor = op.anchors(words)
    for half in (0, 1):
        for r in range(0, 2000, 97):
            own = [int(a) for a in anchor[(row == r) & (anchor >> 32 == half)]]
            word = int(words[r]) >> 32 * half & 0xFFFFFFFF
            far = sorted(bin((a & 0xFFFFFFFF) ^ word).count("1") for a in own)
            assert far[0] <= 1 and far[-1] <= 2 and len(own) == len(set(own))
    assert 31 < len(row) / 2000 < 34


def test_any_two_within_three_bits_share_an_anchor():
    rng = np.random.default_rng(1)
    for _ in range(300):
        x = int(rng.integers(0, 1 << 63))
        y = x
        for b in rng.choice(64, int(rng.integers(0, 4)), replace=False):
            y ^= 1 << int(b)
        row, anchor = op.anchors(np.array([x, y], np.uint64))
        assert set(anchor[row == 0]) & set(anchor[row == 1])


def corpus():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["É", "ΣX", "ÀB"]
    texts = [None, "", " \t\n", "One", "one", "one two", "a b c", "A  B\nC", "x\x1cy z", "\x85", " a b c"]
    for _ in range(25):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(30, 300))]
        texts.append(" ".join(base))
        for _ in range(3):
            copy = list(base)
            for _ in range(rnd.randint(0, 2)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            texts.append(rnd.choice(["\n", "  ", " "]).join(copy))
    texts.append(" ".join(rnd.choice(vocab) for _ in range(200_000)))
    return texts


def test_near_dedup_equals_brute_force(spark):
    texts = corpus()
    rows = [(100 + 3 * i, t, "clash", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, anchor int")
    got = {r.doc_id: r for r in op.near_dedup(df).collect()}
    prints = [brute_print(t) for t in texts]
    root = brute_components(prints, lambda x, y: bin(x ^ y).count("1") <= 3)
    assert len(got) == len(rows)
    for (i, *_), p, r in zip(rows, prints, root):
        assert got[i].fp & (1 << 64) - 1 == p
        assert got[i].component_id == rows[r][0]


def test_small_cells_link_as_large_ones(spark):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 62))
    fps = {centre}
    while len(fps) < 300:
        x = centre
        for b in rng.choice(64, int(rng.integers(1, 4)), replace=False):
            x ^= 1 << int(b)
        fps.add(x - (1 << 64) if x >> 63 else x)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for cell in (7, 1024):
        nodes = op.components(op.link_fingerprints(df, 3, cell)).collect()
        assert len(nodes) == 299 and len({n.root for n in nodes}) == 1


def test_repeats_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (9, None), (None, "q r s t")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in op.near_dedup(df).collect()), key=str)
    assert got == sorted([(None, 7), (7, 7), (7, 7), (9, 9), (None, None)], key=str)
    kept = op.kept_documents(df.selectExpr("1 as _fp1", "doc_id", "text", "'x' as root"))
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [("7", "a b c d"), ("9", "None"), ("None", "q r s t")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert op.near_dedup(empty).count() == 0 and op.kept_documents(empty).count() == 0


def test_one_row_of_each_group_stays_where_a_doc_id_repeats(spark):
    rnd = random.Random(8)
    texts = [" ".join(f"{c}{rnd.randrange(10**6)}" for _ in range(60)) for c in "abcd"]
    prints = [brute_print(t) for t in texts]
    assert all(bin(x ^ y).count("1") > 3 for x, y in itertools.combinations(prints, 2))
    a, b, c, d = texts
    rows = [(5, a), (5, b), (5, b), (3, b), (9, c), (9, d), (9, a), (None, d)]
    kept = op.kept_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(5, a), (3, b), (9, c), (9, d)])
    again = op.kept_documents(spark.createDataFrame([(5, t) for t in texts], "doc_id long, text string")).collect()
    assert sorted(r.text for r in again) == sorted(texts)
