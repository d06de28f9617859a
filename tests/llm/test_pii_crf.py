import hashlib
import random
import re
import time

from pricewell.llm import pii_crf as pc

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        twice = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in twice) % 10 == 0
    return 8 <= len(digits) <= 15 if kind == "phone" else True


def brute(text):
    return [(kind, *m.span()) for kind, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(kind, m.group())]


def check(rows, got):
    """Base counts and hash of every row; all spans hold the base spans, and lie inside the text."""
    want = sorted((str(d), *[sum(k == kind for k, _, _ in brute(t)) for kind in PATTERNS],
                   hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in brute(t)).encode()).hexdigest()) for d, t in rows)
    assert want == sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got)
    base = {}
    for d, t in rows:
        base.setdefault(d, []).append({f"{k}:{a}:{b}" for k, a, b in brute(t)})
    for r in got:
        assert any(b <= set(r.spans.split(",")) or not b for b in base[r.doc_id])


def test_base_spans_are_the_patterns():
    rng = random.Random(1)
    parts = ["a", "b.c", "@", "@x", ".", "..", "-", "+", "1", "12", "255", "256", "4785380592391139", " ", " ", "(", ")", "é", "\n", "٣", "%", "_", "com", "+1 (743) 555-3824", "0000001"]
    for _ in range(20000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        got = [(pc.KINDS[k], a, b) for k, a, b in pc.base_spans(text)]
        assert got == brute(text), text


def test_long_runs_take_linear_time():
    began = time.time()
    for text in ("a" * 400000, "1" * 400000, "1." * 200000, "a@" * 200000, "1 " * 200000, "+1" * 200000, "+1" + " " * 400000, "(1" * 200000, "1" + " " * 400000, "x@" + "-" * 400000):
        pc.nodes(text)
    assert time.time() - began < 20


def people(n):
    rng = random.Random(4)
    out = []
    for i in range(n):
        phone = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        mail = f"{rng.choice(['thwhhe', 'hein', 'enbest', 'one'])}.{rng.randint(10, 99)}@mail{rng.randint(1, 9)}.example.com"
        ip = ".".join(str(rng.randint(10, 250)) for _ in range(4))
        out.append((i, f"some words here {phone} and then {mail} or from {ip} the rest of it"))
    return out


def spans(spark, rows):
    return {r.doc_id: r for r in pc.digest(pc.personal_data(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}


def test_distant_mentions_share_their_label(spark):
    rows = people(150)
    far = " lorem ipsum dolor" * 200
    tests = {
        1000: ("write to jane.doe7@mail3.example.com today" + far + " ask jane.doe7@mail3 again", ["jane.doe7@mail3"], "email"),
        1001: ("call +1 (743) 555-3824 now" + far + " or 743-555-3824 later", ["743-555-3824"], "phone"),
        1002: ("+1 (743) 555-3824" + far + " 17435553824" + far + " 743.555.3824", ["17435553824", "743.555.3824"], "phone"),
        1003: ("from 152.143.123.131 and" + far + " 152.143.123 too", ["152.143.123"], "ip"),
        1004: ("pay with 4785 3805 9239 1139 now" + far + " 478538059239113 gone", ["478538059239113"], "card"),
    }
    alone = {
        2000: "ask jane.doe7@mail3 again", 2001: "or 743-555-3824 later", 2002: "17435553824", 2003: "152.143.123 too",
        2004: "version 2.0.1 of 20240101 and 3.", 2005: "the hash 24be64439e3e49cf46b2d7c90f3602a3d0b907ff"}
    got = spans(spark, rows + [(k, v[0]) for k, v in tests.items()] + list(alone.items()))
    for k, (text, mentions, kind) in tests.items():
        want = {f"{kind}:{m.start()}:{m.end()}" for s in mentions for m in re.finditer(r"(?<!\S)" + re.escape(s) + r"(?!\S)", text)}
        base = {f"{a}:{b}:{c}" for a, b, c in brute(text)}
        assert set(got[k].spans.split(",")) == want | base, k
    for k, text in alone.items():
        assert got[k].spans == ",".join(f"{a}:{b}:{c}" for a, b, c in brute(text)) == ""
    for k, text in rows:
        assert got[k].spans == ",".join(f"{a}:{b}:{c}" for a, b, c in brute(text))


def test_messages_reach_over_several_links():
    """A candidate that only resembles another candidate is labelled through it, unlike without edges."""
    model = pc.Model()
    model.unary[0, pc.NONE] = 1.0
    model.pair[pc.SAME] = 4 * pc.np.eye(pc.LABELS)
    label = pc.np.array([3, pc.NONE, pc.NONE, pc.NONE])
    x = pc.np.zeros((4, pc.FEATURES))
    x[:, 0] = 1
    e = pc.np.array([(0, 1, pc.SAME), (1, 2, pc.SAME)])
    best = model.beliefs(x, label, e).argmax(axis=1)
    assert list(best) == [3, 3, 3, pc.NONE]


def test_beliefs_are_exact_on_a_tree():
    import itertools
    np = pc.np
    rng = np.random.default_rng(2)
    model = pc.Model()
    model.unary = rng.normal(size=model.unary.shape)
    model.pair = rng.normal(size=model.pair.shape)
    x = rng.normal(size=(4, pc.FEATURES)) * 0.3
    label = np.full(4, pc.NONE)
    e = np.array([(0, 1, 0), (1, 2, 1), (1, 3, 2)])
    p = np.zeros((4, pc.LABELS))
    for ys in itertools.product(range(pc.LABELS), repeat=4):
        w = np.exp(sum(x[i] @ model.unary[:, y] for i, y in enumerate(ys)) + sum(model.pair[k, ys[i], ys[j]] for i, j, k in e))
        for i, y in enumerate(ys):
            p[i, y] += w
    got = model.beliefs(x, label, e)
    assert np.abs(got - p / p.sum(axis=1, keepdims=True)).max() < 2e-3


def test_many_equal_nodes_have_few_edges():
    n = 5000
    e = pc.edges([3] + [pc.NONE] * n, list(range(0, 100 * (n + 1), 100)), list(range(10, 100 * (n + 1), 100)), ["5553824555"] * (n + 1))
    assert len(e) <= 2 * (n + 1)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "x a.b@c.de 1.2.3.4"), (3, "é+49 30 1234567 é"), (3, "é+49 30 1234567 é"), (3, "nothing"),
            (4, "w " * 50000 + "a@b.c " * 2000), (5, "1" * 5000), (6, "\u0085a@b.c "), (7, "4785380592391139 " * 40)]
    df = spark.createDataFrame([(a, b, "z", 1) for a, b in rows], "doc_id long, text string, spans string, label int")
    check(rows, pc.digest(pc.personal_data(df)).collect())
    assert pc.digest(pc.personal_data(df.limit(0))).count() == 0
    plain = spark.createDataFrame([(1, "no data"), (2, "5551234567")], "doc_id long, text string")
    assert {r.spans for r in pc.digest(pc.personal_data(plain)).collect()} == {""}


def test_query_against_brute_force(spark):
    from pricewell.llm import queries
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(rows, queries.QUERIES["op13_pii_crf"](spark, sf).collect())
