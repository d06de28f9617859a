import hashlib
import re

import pytest

from pricewell.llm import mix_threshold as op


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left = {s: 0.0 for s in names}, float(sum(sizes.values()))
    open_ = set(names)
    while open_ and left > 1e-9:
        w = sum(weight[s] for s in open_)
        give = {s: left * weight[s] / w for s in open_}
        left = 0.0
        for s, g in give.items():
            target[s] += g
        for s in list(open_):
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3 * sizes[s]
                open_.discard(s)
    return target


def check(docs, got):
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + words(t)
    target = brute_targets(sizes)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    taken = {s: 0 for s in sizes}
    assert len(got) == len(docs)
    for i, t, s in docs:
        r = by_id[i][0]
        if i is not None:
            assert r.size == words(t) and r.source_size == sizes[s]
            assert r.target == pytest.approx(target[s], rel=1e-9, abs=1e-6)
        assert r.taken in [k * r.size for k in range(4)]
    for r in got:
        taken_of = next(s for s in sizes if sizes[s] == r.source_size and abs(target[s] - r.target) < 1e-6)
        taken[taken_of] += r.taken
    most = max(words(t) for _, t, _ in docs)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= most
        own = sorted(words(t) for _, t, x in docs if x == s)
        assert abs(taken[s] - target[s]) <= max(own)


def test_mix_meets_targets(spark):
    docs = []
    for s, n in (("b", 300), ("a", 5), ("é", 40), (None, 30), ("Z", 500), ("", 3)):
        for k in range(n):
            docs.append((len(docs) * 7, "w " * (1 + (k * 37) % 90), s))
    docs += [(100_000, None, "b"), (100_001, "", "a"), (100_002, " \n", "é"), (100_003, "x\x1cy " * 3, "Z")]
    df = spark.createDataFrame([(*d, 1, "clash") for d in docs], "doc_id long, text string, source string, size int, target string")
    got = op.mix(df).collect()
    check(docs, got)
    assert sorted(map(str, got)) == sorted(map(str, op.mix(df.repartition(3)).collect()))
    mixed = op.mixed_documents(df)
    assert mixed.columns == df.columns
    times = {}
    for r in mixed.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert all(times.get(r.doc_id, 0) * r.size == r.taken for r in got)


def test_threshold_takes_the_smallest_hashes(spark):
    docs = [(i, "w " * (1 + i % 13), "ab"[i % 5 == 0]) for i in range(400)]
    got = op.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    u = lambda i: int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16)
    for target in {r.target for r in got}:
        own = sorted((r for r in got if r.target == target), key=lambda r: u(r.doc_id))
        times = [r.taken // r.size for r in own]
        assert times == sorted(times, reverse=True)


def test_repeats_nulls_and_empty_tables(spark):
    docs = [(5, "a b c", "x")] * 4 + [(None, f"t{i} b", "x") for i in range(6)] + [(7, None, None), (8, None, "y")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = op.mix(df).collect()
    assert len(got) == len(docs) and len({r.taken for r in got if r.doc_id == 5}) == 1
    assert all(r.taken == 0 for r in got if r.doc_id in (7, 8))
    assert op.mix(df.limit(0)).count() == 0 and op.mixed_documents(df.limit(0)).count() == 0
    none = df.filter("text is null")
    assert {r.target for r in op.mix(none).collect()} == {0.0}


def test_targets_are_met_where_doc_ids_repeat(spark):
    """A source of 1,000 rows with one doc_id, equal or different texts, is cut row by row."""
    for text in ("same words in every row here", "row {} has its own five"):
        rows = [(3, text.format(i), "a") for i in range(1000)] + [(i + 10, "w " * (1 + i % 40), "b") for i in range(400)]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
        got = op.mix(df).collect()
        for size in {r.source_size for r in got}:
            own = [r for r in got if r.source_size == size]
            assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        assert sorted(map(str, got)) == sorted(map(str, op.mix(df.repartition(3, "source")).collect()))
        assert op.mixed_documents(df).count() == sum(r.taken // r.size for r in got)
