import hashlib
import random
import re
import zlib

import pytest

from pricewell.llm import conversation_repair as cr

SEP = " \t\n\x0b\x0c\r"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def cheapest(rows):
    """(cost, audit, lines) of rows (role, text, must_go, adds) by exhaustive dynamic programming over
    the last role initial; independent of the search: best prefixes as (cost, audit, lines)."""
    def grow(best):
        for _ in range(4):  # inserts
            for last, (c, a, ls) in list(best.items()):
                to, role = ("a", "assistant") if last == "u" else ("u", "user")
                new = (c + 3, a + "I", ls + [f"{role}:"])
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        return best

    best = grow({"": (0, "", [])})
    for role, text, must_go, adds in rows:
        nxt = {}

        def offer(last, new):
            if last not in nxt or new[:2] < nxt[last][:2]:
                nxt[last] = new
        for last, (c, a, ls) in best.items():
            offer(last, (c + 4, a + "D", ls))
            if must_go:
                continue
            for to in ("user", "assistant"):
                if (last, to[0]) in (("", "u"), ("s", "u"), ("a", "u"), ("u", "a")):
                    offer(to[0], (c + 3 + adds, a + "R", ls + [f"{to}:{text}"]))
            if (last, role[:1]) in (("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")):
                offer(role[:1], (c + adds, a + "K", ls + [f"{role}:{text}"]))
        best = grow(nxt)
    return min(best[k] for k in ("", "a") if k in best)


def damaged(rows):
    """Rows (conv_id, turn, role, text) after damage, grouped; every conv_id is there."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if d == 1:
            text = ""
        if d == 2:
            text = re.sub("[.!?]", "", text)
        if d == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return out


def brute(rows, damage=damaged):
    result = []
    for conv, own in damage(rows).items():
        own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {r[0] for r in own if r[0] is not None}
        count, seen, seq = dict.fromkeys(("blank", "duplicate", "truncated"), 0), set(), []
        for _, role, text in own:
            core = text.rstrip(SEP)
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                count[fault] += 1
            seq.append((role, text, fault in ("blank", "duplicate"), 3 if fault == "truncated" else 0))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(seq, seq[1:]))
        cost, audit, lines = cheapest(seq)
        result.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *count.values(), illegal, cost, audit,
                       hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(map(str, result))


def result(df):
    return sorted(map(str, (tuple(r) for r in df.select(*COLUMNS).collect())))


def noise(n, rng, roles="ssuuuaaaat"):
    names = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    return [(names[rng.choice(roles)], rng.choice(["Yes.", "no", "", "Right!", f"{rng.random()}.", f"{rng.random()}.", f"{rng.random()}"])) for _ in range(n)]


@pytest.mark.parametrize("n,times", [(3, 300), (12, 200), (40, 60), (200, 6)])
def test_search_is_the_cheapest(n, times):
    rng = random.Random(n)
    for _ in range(times):
        rows = [(r, t, rng.random() < 0.2, rng.choice([0, 0, 3])) for r, t in noise(rng.randint(0, n), rng, rng.choice(["suat", "uuua", "ua", "t", "sss", "a", "ssuuuaaaat"]))]
        codes = [cr.Row(r[:1], gone, adds) for r, _, gone, adds in rows]
        assert cr.search(codes, {cr.START: (0, "")}, cr.ENDS)[:2] == cheapest(rows)[:2]


def test_bounds_never_exceed_the_cost():
    rng = random.Random(9)
    for _ in range(50):
        rows = [(r, t, rng.random() < 0.2, rng.choice([0, 3])) for r, t in noise(40, rng)]
        codes = [cr.Row(r[:1], gone, adds) for r, _, gone, adds in rows]
        assert cr.suffix_bounds(codes, cr.ENDS)[0][cr.START] <= cheapest(rows)[0]


def test_bound_leaves_work_to_the_search():
    """Behind a block the state is free, so the bound of a long conversation may be below its cost."""
    codes = [cr.Row("u", False, 0)] * 17 + [cr.Row("a", False, 0)] * 40
    cost = cr.search(codes, {cr.START: (0, "")}, cr.ENDS)[0]
    assert cr.suffix_bounds(codes, cr.ENDS)[0][cr.START] < cost


@pytest.mark.parametrize("chunk", [1, 2, 5, 256])
def test_chunks_do_not_change_the_result(monkeypatch, chunk):
    monkeypatch.setattr(cr, "CHUNK", chunk)
    rng = random.Random(chunk)
    for roles in ("ssuuuaaaat", "t", "s", "ua", "stttt", "a"):
        for _ in range(15):
            own = noise(rng.randint(1, 30), rng, roles)
            r, seen, seq = cr.Repair(), set(), []
            for i, (role, text) in enumerate(own):
                core = text.rstrip(SEP)
                fault = cr.BLANK if not core else cr.DUPLICATE if (role, text) in seen else cr.TRUNCATED if core[-1] not in ".!?" else 0
                seen.add((role, text))
                seq.append((role, text, fault in (1, 2), 3 if fault == 3 else 0))
                r.add(i, role, text, fault)
            got, (cost, audit, lines) = r.finish(), cheapest(seq)
            assert (got["cost"], got["audit"]) == (cost, audit)
            assert got["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def odd_rows():
    rng = random.Random(5)
    rows = [(c, t, role, text) for c in range(60) for t, (role, text) in enumerate(noise(rng.randint(1, 9), rng))]
    rows += [(100, t, role, text) for t, (role, text) in enumerate(noise(700, rng))]  # longer than a chunk
    rows += [(101, None, "user", "Hi."), (101, None, None, None), (101, 4, "assistant", None), (101, 4, "assistant", "Yes. \n")]
    rows += [(102, None, "user", "x"), (102, None, "user", "x"), (103, 9, "user", "y" * 100000 + "."), (103, 2, "", "z!")]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (None, None, None, " \t\x0b")]
    rows += [(104, 0, "user", "a. "), (104, 1, "assistant", "b. "), (104, 7, "user", "c?  \r\n")]
    rows += [(105, 3, "user", "A."), (105, 3, "user", "A."), (105, 3, "assistant", "B."), (105, 1 << 40, "tool", "B.")]
    return rows


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "conv_id long, turn long, role string, text string, fault string, gone int")
    assert result(cr.repair(cr.damage(df))) == brute(rows)
    assert result(cr.repair(cr.damage(df.repartition(5)))) == brute(rows)
    assert cr.repair(cr.damage(df.limit(0))).count() == 0


def test_conversation_that_is_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(1, turn, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert result(cr.repair(cr.damage(df))) == [str((1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))]


def test_repaired_turns_are_in_order_and_make_the_hash(spark):
    df = spark.createDataFrame(odd_rows(), "conv_id long, turn long, role string, text string")
    turns = cr.damage(df).cache()
    reports = cr.repair(turns)
    lines = {}
    for r in cr.repaired_turns(turns, reports).orderBy("conv_id", "pos").collect():
        lines.setdefault(r.conv_id, []).append((r.role, r.text))
    for r in reports.collect():
        own = lines.get(r.conv_id, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in own))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in own).encode()).hexdigest() == r.repaired_sha256
        assert len(own) == len(r.audit) - r.audit.count("D")


def test_query_against_brute_force(spark):
    from pricewell.llm import queries
    sf = "/root/testdata/sf0.001"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert result(queries.QUERIES["op12_conversation_repair"](spark, sf)) == brute(rows)
