import random
import re

import numpy as np

from pricewell.llm import tiling as op


def words(text):
    return [w.lower() for w in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text or "")]


def brute_tiles(a, b, least):
    """Greedy string tiling by definition: repeat with the longest free match."""
    fa, fb, out = [True] * len(a), [True] * len(b), []
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and fa[i + n] and fb[j + n]:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (i, j, n)
        if best is None:
            return out
        i, j, n = best
        fa[i:i + n] = [False] * n
        fb[j:j + n] = [False] * n
        out.append(best)


def test_tiles_equal_definition():
    rnd = random.Random(3)
    for _ in range(60):
        a = [rnd.choice("abcdef") for _ in range(rnd.randint(0, 25))]
        b = [rnd.choice("abcdef") for _ in range(rnd.randint(0, 40))]
        for least in (1, 2, 4):
            assert sorted(x[2] for x in op.tiles(a, b, least)) == sorted(x[2] for x in brute_tiles(a, b, least))


def corpus():
    rnd = random.Random(4)
    vocab = [f"t{i}" for i in range(90)] + ["été", "日本", "of"]
    new = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(new(n))) for i, n in enumerate([15, 20, 33, 59, 40, 3, 1, 25, 25])]
    items += [(20, items[2][1]), (21, ""), (22, None), (None, "a b c d e f"), (20, items[2][1])]
    docs = [None, "", "  ", "one", " ".join(new(3000)), "x " * 300_000]
    for _ in range(40):
        body = new(rnd.randint(0, 200))
        it = words(rnd.choice(items[:6])[1])
        kind = rnd.randrange(5)
        if kind == 1:
            body[10:10] = [w.upper() if w.isascii() else w for w in it]
        elif kind == 2 and len(it) > 12:      # reordered
            h = len(it) // 2
            body = it[h:] + body + it[:h]
        elif kind == 3 and len(it) > 12:      # partly there
            body[5:5] = it[:int(len(it) * rnd.choice([0.7, 0.79, 0.81, 0.9]))]
        elif kind == 4:
            it = list(it)
            it[len(it) // 2] = "edited"
            body[5:5] = it
        docs.append(rnd.choice([" ", ", ", "\n"]).join(body))
    return [(i * 2, t) for i, t in enumerate(docs)], items


def test_leaks_equal_brute_force(spark, monkeypatch):
    docs, items = corpus()
    docs += [docs[10], (None, docs[11][1])]
    d = spark.createDataFrame([(*r, 7, 0.1) for r in docs], "doc_id long, text string, _tk int, coverage double")
    b = spark.createDataFrame([(*r, "clash") for r in items], "item_id long, text string, doc_id string")
    want = []
    for i, t in docs:
        for k, s in sorted({x for x in items if x[0] is not None and x[1]}):
            w, v = words(s), words(t)
            if w and len(v) < 5000:
                n = sum(x[2] for x in brute_tiles(w, v, min(5, len(w))))
                if n / len(w) >= 0.8 - 1e-12:
                    want.append((i, k, len(w), n))
    for group, most in ((op.GROUP_BYTES, op.FILTER_BITS), (2000, 1 << 15)):
        monkeypatch.setattr(op, "GROUP_BYTES", group)
        monkeypatch.setattr(op, "FILTER_BITS", most)
        got = [(r.doc_id, r.item_id, r.item_words, r.covered) for r in op.leaks(d, b).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want))
        kept = op.clean_documents(d, b)
        assert kept.columns == d.columns
        bad = {str(x[0]) for x in want}
        assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if str(i) not in bad)
    assert any(x[3] == x[2] for x in want) and len(want) > 10


def test_hash_filter_has_every_value(spark):
    rnd = np.random.default_rng(2)
    own = rnd.integers(-2 ** 63, 2 ** 63 - 1, 5000)
    bits = op.hash_filter(spark.createDataFrame([(int(x),) for x in own], "h long"), "h")
    assert op.passes(bits, own).all()
    assert op.passes(bits, rnd.integers(-2 ** 63, 2 ** 63 - 1, 20000)).mean() < 0.1


def test_rarest_seeds_find_spread_tiles(spark):
    """Items held at just the coverage, in tiles of exactly five words, with seeds that very many
    texts share: leaving out the most frequent seeds must lose none."""
    rnd = random.Random(9)
    stock = ["to be or not to be that is the question whether", "it was the best of times it was the worst of times"]
    items = [(i, " ".join([stock[i % 2], *(f"w{i}x{j}" for j in range(24 - len(stock[i % 2].split())))])) for i in range(12)]
    docs = [(j, f"{rnd.choice(stock)} filler{j}") for j in range(300)]
    for i, t in items:
        w = t.split()
        pieces = [w[a:a + 5] for a in range(0, 20, 5)]
        rnd.shuffle(pieces)
        docs.append((1000 + i, " ".join(f"{' '.join(p)} z{i}" for p in pieces)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.covered) for r in op.leaks(d, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for i, t in docs:
        for k, s in items:
            n = sum(x[2] for x in brute_tiles(words(s), words(t), 5))
            if n >= 0.8 * len(words(s)):
                want.add((i, k, n))
    assert got == want and len(want) == 12


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert op.leaks(d, b).count() == 0 and op.clean_documents(d, b).count() == 1
    full = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    assert op.leaks(d.limit(0), full).count() == 0 and op.leaks(d, full).count() == 1
