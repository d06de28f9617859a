import math

import numpy as np
import pytest

from pricewell.llm import embedding_dedup as op

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, table int"


def brute(rows, threshold=0.93):
    n = len(rows)
    v = []
    for _, e, lab in rows:
        ok = lab is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)
        v.append(np.array(e, np.float32).astype(float) if ok else None)
    links = [[] for _ in rows]
    for i in range(n):
        for j in range(n):
            if i != j and v[i] is not None and v[j] is not None and rows[i][2] == rows[j][2] and len(v[i]) == len(v[j]):
                if v[i] @ v[j] / np.sqrt((v[i] @ v[i]) * (v[j] @ v[j])) >= threshold:
                    links[i].append(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((rows[i][0], len(links[i]), min(rows[j][0] for j in seen)))
    return sorted(out)


def corpus():
    rng = np.random.default_rng(2)
    rows = []
    for label in range(3):
        for _ in range(12):
            c = rng.standard_normal(16)
            for k in range(rng.integers(1, 12)):
                rows.append((c + rng.standard_normal(16) * rng.choice([0.05, 0.25, 0.4])).tolist() + [label])
    rows = [([float(x) for x in r[:-1]], r[-1]) for r in rows]
    rows += [rows[3], rows[3], ([4 * x for x in rows[3][0]], rows[3][1]), (rows[3][0], 99), (rows[3][0], None), (rows[3][0][:8], rows[3][1])]
    rows += [(None, 1), ([], 1), ([0.0] * 16, 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([None] + [1.0] * 15, 1), ([float("inf")] + [1.0] * 15, 1), ([-0.0] * 16, 1)]
    ids = rng.permutation(len(rows)) * 3
    return [(int(i), e, lab) for i, (e, lab) in zip(ids, rows)]


@pytest.mark.parametrize("cell", [512, 4])
def test_links_and_components_equal_brute_force(spark, cell):
    rows = corpus()
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], SCHEMA)
    got = op.near_dedup(df, miss=1e-9, cell=cell).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_plan_follows_rows_and_threshold():
    differ = np.arccos(0.93) / np.pi
    for rows, want in ((10, 4), (5681, 7), (50_000 * 64, 16), (10**9, 24)):
        bits, tables, cut = op.plan(rows)
        far = sum(math.comb(op.SKETCH, k) * differ ** k * (1 - differ) ** (op.SKETCH - k) for k in range(cut + 1, op.SKETCH + 1))
        assert bits == want and (1 - (1 - differ) ** bits) ** tables + far <= 1e-4


def planted(rng, pairs, noise, dim=32):
    """Unrelated vectors and ``pairs`` planted ones at cosine 0.93 and a little above."""
    base = rng.standard_normal((pairs, dim))
    base /= np.sqrt((base * base).sum(axis=1, keepdims=True))
    side = rng.standard_normal((pairs, dim))
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.sqrt((side * side).sum(axis=1, keepdims=True))
    cos = rng.uniform(0.9302, 0.95, (pairs, 1))
    return np.vstack([base, cos * base + np.sqrt(1 - cos * cos) * side, rng.standard_normal((noise, dim))]).astype(np.float32)


@pytest.mark.parametrize("bucket", [64, 1])
def test_recall_of_pairs_at_the_threshold(spark, monkeypatch, bucket):
    """4,000 vectors in pairs just above 0.93 among others; with bucket 1 the tables have 13 bits."""
    monkeypatch.setattr(op, "BUCKET", bucket)
    v = planted(np.random.default_rng(8), 2000, 2000)
    unit = v.astype(float)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    df = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r.n_links for r in op.near_dedup(df).collect()}
    assert want.sum() >= 4000 and op.plan(len(v))[0] == {64: 7, 1: 13}[bucket]
    lost = sum(int(want[i]) - got[i] for i in range(len(v)))
    assert all(got[i] <= want[i] for i in range(len(v))) and lost <= 0.001 * want.sum()


@pytest.mark.parametrize("kind", ["double", "int"])
def test_other_component_types(spark, kind):
    rows = [(1, [1, 0, 3], 1), (2, [10, 1, 30], 1), (3, [0, 5, 0], 1), (4, [1, None, 3], 1)]
    cast = [(i, [x if x is None or kind == "int" else float(x) for x in e], k) for i, e, k in rows]
    df = spark.createDataFrame(cast, f"vec_id long, embedding array<{kind}>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in op.near_dedup(df).collect())
    assert got == [(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4)]


def test_many_close_vectors_in_one_label(spark):
    """A third of all rows are near copies of one vector: their bucket is dealt to cells."""
    rng = np.random.default_rng(9)
    c = rng.standard_normal(24)
    rows = [(int(i), (c + 0.08 * rng.standard_normal(24) if i % 3 == 0 else rng.standard_normal(24)).tolist(), 1) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in op.near_dedup(df, miss=1e-9, cell=20).collect())
    assert got == brute(rows)


def test_repeats_nulls_and_empty_tables(spark):
    rows = [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (5, None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in op.near_dedup(df).collect())
    assert got == [("4", 2, "4"), ("4", 2, "4"), ("5", 0, "5"), ("None", 0, "None"), ("None", 2, "4")]
    assert op.near_dedup(df.limit(0)).count() == 0


def test_zeros_of_both_signs_are_equal(spark):
    df = spark.createDataFrame([(7, [0.0, 2.0], 1), (8, [-0.0, 2.0], 1), (9, [2.0, -0.0], 1)], "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in op.near_dedup(df).collect())
    assert got == [(7, 1, 7), (8, 1, 7), (9, 0, 9)]
