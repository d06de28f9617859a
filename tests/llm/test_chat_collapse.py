import random

import duckdb
import pandas as pd

from pricewell.llm import chat_collapse as op


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t, r, x))
    low = lambda v: (v is not None, v if v is not None else 0)
    low_s = lambda v: (v is not None, v or "")
    seqs = {c: tuple((r, x) for _, r, x in sorted(v, key=lambda y: (low(y[0]), low_s(y[1]), low_s(y[2])))) for c, v in convs.items()}
    out = []
    for c, s in seqs.items():
        if any(len(o) > len(s) and o[:len(s)] == s for o in seqs.values()):
            continue
        same = [k for k, o in seqs.items() if o == s]
        if c == min(same):
            snaps = sum(len(o) < len(s) and s[:len(o)] == o for o in seqs.values())
            chat = "".join(f"<|im_start|>{'unknown' if r is None else r}\n{x or ''}<|im_end|>\n" for r, x in s)
            out.append((c, len(s), len(same), snaps, chat))
    return sorted(out)


def corpus():
    rnd = random.Random(6)
    rows, c = [], 0
    for _ in range(40):
        said = [("user" if i % 2 == 0 else "assistant", rnd.choice(["hi", "hello", None, "", "long " * 50])) for i in range(rnd.randint(1, 7))]
        for n in {len(said), *rnd.sample(range(1, len(said) + 1), rnd.randint(0, len(said)))}:
            for _ in range(rnd.choice([1, 1, 2])):
                rows += [(c, i, *t) for i, t in enumerate(said[:n])]
                c += 1
    rows += [(c, 0, None, "a"), (c + 1, 0, "a", None), (c + 2, None, "user", "x"), (c + 2, 0, "user", "y"), (c + 2, 0, "assistant", "y"),
             (c + 3, 5, "user", "late"), (c + 3, 5, "user", "late"), (None, 0, "user", "hi"), (c + 4, 0, "user", "w " * 100_000)]
    rnd.shuffle(rows)
    return rows


def test_collapse_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, chat string, n int")
    got = sorted(tuple(r) for r in op.format_chats(df).select("conv_id", "n_turns", "n_copies", "n_snapshots", "chat").collect())
    assert got == brute(rows)
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).convert_dtypes())
    assert sorted(con.execute(op.ORACLE).fetchall()) == got


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert op.format_chats(empty).count() == 0
