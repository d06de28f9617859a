import hashlib
import random
import re

import pytest

from pricewell.llm import minimisers, sparse_suffix, superkmer_dedup

W = 50


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, window=W):
    """{row number: (n_words, removed flags, {flag: smallest source})} by definition."""
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            if d is not None:
                k = " ".join(w[i:i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone, src = [False] * len(w), {}
        for i in range(len(w) - window + 1):
            s = first.get(" ".join(w[i:i + window]))
            if d is not None and s < d:
                for j in range(i, i + window):
                    gone[j] = True
                    src[j] = min(src.get(j, s), s)
        out.append((w, gone, src))
    return out


def corpus(seed=1, hot=30):
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(400)] + ["é", "\x85", "\x1c", "日本"]
    new = lambda n: [rnd.choice(vocab) for _ in range(n)]
    passages = [new(n) for n in (49, 50, 51, 60, 120, 300)]
    texts = [None, "", "  \n", "one two", " ".join(new(49)), " ".join(["a"] * 130), " ".join(["a"] * 70), " ".join(["a", "b"] * 60)]
    for k in range(hot):
        body = new(rnd.randint(0, 150))
        for p in rnd.sample(passages, rnd.randint(0, 3)):
            cut = rnd.randint(0, len(body))
            body[cut:cut] = p
        texts.append("\t".join(body) if k % 3 else " \n".join(body))
    texts += [texts[9], "  " + (texts[9] or "").replace("\t", "  "), texts[12], " ".join(new(30_000) + passages[2])]
    near = words(texts[-1])
    near[15_000] = "edit"
    texts.append(" ".join(near))
    ids = list(range(0, 5 * len(texts), 5))
    rnd.shuffle(ids)
    return list(zip(ids, texts))


ROWS = corpus() + [(None, corpus()[12][1]), (7777, corpus()[12][1]), (7777, corpus()[12][1]), (7777, corpus()[20][1])]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(d, t, "clash", 1, []) for d, t in ROWS], "doc_id long, text string, sha string, h int, runs array<int>")


@pytest.mark.parametrize("cell", [1024, 3])
def test_superkmers_equal_brute_force(frame, cell):
    got = sorted(map(str, ((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in superkmer_dedup.dedup_substrings(frame, cell=cell).collect())))
    want = []
    for (d, _), (w, gone, _) in zip(ROWS, brute(ROWS)):
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want.append(str((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())))
    assert got == sorted(want)


def test_kept_texts(frame):
    got = superkmer_dedup.dedup_substrings(frame, texts=True).collect()
    assert len(got) == len(ROWS)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("cell", [1024, 3])
def test_sparse_suffixes_equal_brute_force(frame, cell):
    got = {}
    for r in sparse_suffix.repeated_passages(frame, cell=cell).collect():
        assert r.n_words == r.end_word - r.first_word >= W
        got.setdefault(r.doc_id, set()).add((r.first_word, r.end_word, r.kept_in))
    want = {}
    for (d, _), (w, gone, src) in zip(ROWS, brute(ROWS)):
        i = 0
        while i < len(w):
            if gone[i]:
                j = i
                while j < len(w) and gone[j]:
                    j += 1
                want.setdefault(d, set()).add((i, j, min(src[x] for x in range(i, j))))
                i = j
            i += 1
    assert got == want


def test_copies_name_the_smallest_document_of_their_passages(spark):
    """5 and 6 are copies of 4, a part of which is in 1; 9 is a copy of one text of doc_id 2, all of it in 1."""
    p, q, r = (" ".join(f"{c}{i}" for i in range(60)) for c in "pqr")
    rows = [(1, f"start {p} end"), (2, q), (3, f" {q}"), (4, f"{r} {p}"), (5, f"{r} {p}"), (6, f"{r}\t{p}"), (7, r), (8, r), (2, p), (9, p)]
    got = sorted(tuple(x) for x in sparse_suffix.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(2, 0, 60, 60, 1), (3, 0, 60, 60, 2), (4, 60, 120, 60, 1), (5, 0, 120, 120, 1), (6, 0, 120, 120, 1),
                   (7, 0, 60, 60, 4), (8, 0, 60, 60, 4), (9, 0, 60, 60, 1)]


@pytest.mark.parametrize("cell", [3, 7])
def test_split_minimisers_name_the_smallest_document(spark, cell):
    rnd = random.Random(4)
    new = lambda n: [f"x{rnd.randrange(10**6)}" for _ in range(n)]
    passages = [new(n) for n in (50, 90, 200)]
    rows = []
    for k in range(60):
        body = new(20)
        for p in rnd.sample(passages, rnd.randint(1, 3)):
            body += p[rnd.choice([0, 0, 10]):] + new(3)
        rows.append((1000 - 7 * k, " ".join(body)))
    rows.append((1000, rows[5][1] + " other"))
    got = {(r.doc_id, r.first_word, r.end_word, r.kept_in)
           for r in sparse_suffix.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), cell=cell).collect()}
    want = set()
    for (d, _), (w, gone, src) in zip(rows, brute(rows)):
        edge = [i for i in range(len(w) + 1) if (i < len(w) and gone[i]) != (i > 0 and gone[i - 1])]
        want |= {(d, i, j, min(src[x] for x in range(i, j))) for i, j in zip(edge[::2], edge[1::2])}
    assert got == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert superkmer_dedup.dedup_substrings(empty).count() == 0
    assert sparse_suffix.repeated_passages(empty).count() == 0


def test_carried_sources_equal_brute_force(spark, monkeypatch):
    """Spans that touch, overlap or cross the blocks get the least source of any of their windows."""
    monkeypatch.setattr(minimisers, "_BLOCK", 7)
    rnd = random.Random(5)
    inside, at = [], 0
    for _ in range(60):
        at += rnd.choice([0, 3, 5])
        n = rnd.randint(1, 5)
        inside.append((50, 500, at, at + n, 40, 400, at + 11))
        at += n
    late = [(40, 400, w, w + 1, rnd.randint(1, 39)) for w in range(0, at + 20) if rnd.random() < 0.3]
    late.append((40, 401, 12, 13, 0))  # another text with that doc_id
    got = minimisers.carried_sources(
        spark.createDataFrame(inside, "doc_id long, tk long, a int, b int, src long, src_tk long, src_a int"),
        spark.createDataFrame(late, "doc_id long, tk long, a int, b int, src long")).collect()
    windows = {w for x in inside for w in range(x[2], x[3])}
    assert sorted(w for r in got for w in range(r.a, r.b)) == sorted(windows)
    for r in got:
        assert r.src == min([40, *(x[4] for x in late if x[1] == 400 and r.a + 11 <= x[2] < r.b + 11)])
        assert (r.a + 11) // 7 == (r.b + 10) // 7


@pytest.mark.parametrize("cell", [3, 7, 1024])
def test_repeated_words_do_not_multiply_rows(spark, monkeypatch, cell):
    """Texts of one, two or three repeating words: whole, interrupted, and beside a plain passage."""
    kept = {}
    real = minimisers.stored
    monkeypatch.setattr(minimisers, "stored", lambda df, name: kept.setdefault(name, real(df, name)))
    rnd = random.Random(6)
    new = lambda n: [f"y{rnd.randrange(10**6)}" for _ in range(n)]
    plain, rows = new(70), []
    for k in range(48):
        unit = [["u"], ["u", "v"], ["u", "v", "w"]][k % 3]
        body = new(rnd.randint(0, 4)) + unit * rnd.randint(60, 90)
        if k % 4 == 0:
            body += new(rnd.choice([1, 49, 60])) + unit * rnd.randint(60, 90)
        if k % 5 == 0:
            body += plain[rnd.choice([0, 15]):]
        rows.append((1000 - 7 * k, " ".join(body)))
    rows += [(1000 - 7 * 30, " ".join(["u"] * 77 + new(3))), (1, rows[8][1])]
    got = {(r.doc_id, r.first_word, r.end_word, r.kept_in)
           for r in sparse_suffix.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), cell=cell).collect()}
    want = set()
    for (d, t), (w, gone, src) in zip(rows, brute(rows)):
        edge = [i for i in range(len(w) + 1) if (i < len(w) and gone[i]) != (i > 0 and gone[i - 1])]
        want |= {(d, i, j, min(src[x] for x in range(i, j))) for i, j in zip(edge[::2], edge[1::2])}
    assert got == want
    windows = sum(len(words(t)) - W + 1 for _, t in rows)
    assert kept["late"].count() < windows / 10
