import random
import zlib

from pricewell.llm import vector_packing as op


def check(rows, shards, tolerance):
    by, size, count = {}, {}, {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
        size[r.shard] = size.get(r.shard, 0) + r.size
    for s, slots in by.items():
        assert sorted(slots) == list(range(len(slots)))
        assert 0 <= s < shards
    mean = sum(size.values()) / shards
    assert max(abs(size.get(s, 0) - mean) for s in range(shards)) <= tolerance * mean
    return by


def corpus(n=6000, seed=1):
    rnd = random.Random(seed)
    texts = [" ".join("v" * rnd.randint(1, 9) for _ in range(int(rnd.lognormvariate(3, 1)) + 1)) for _ in range(n)]
    texts += [texts[0]] * 40 + ["a hot group of equal texts " * 5] * (n // 2) + [None, "", "é" * 50]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    return list(zip(ids, texts))


def test_shards_are_balanced(spark):
    docs = corpus()
    df = spark.createDataFrame([(*d, 3, "clash") for d in docs], "doc_id long, text string, shard int, digest string")
    rows = op.shard_documents(df).collect()
    assert len(rows) == len(docs)
    by = check(rows, 24, 0.01)
    assert max(map(len, by.values())) <= 1.25 * min(map(len, by.values()))
    text = dict(docs)
    homes = {}
    for r in rows:
        t = text[r.doc_id] or ""
        assert r.size == len(t.encode()) + 8 and r.text_crc32 == zlib.crc32(t.encode()) and r.law == "bytes" and r.grown_shard is None
        homes.setdefault(t, set()).add(r.shard)
    assert [len(h) > 1 for t, h in homes.items()] == [t.startswith("a hot") for t in homes]


def test_all_columns_and_reruns(spark):
    docs = corpus(500, 2)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    a = {r.doc_id: (r.shard, r.slot) for r in op.shard_documents(df).collect()}
    full = op.shard_documents(df.repartition(5), columns=True)
    assert full.columns == ["doc_id", "text", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert a == {r.doc_id: (r.shard, r.slot) for r in full.collect()}


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame(corpus(300, 3), "doc_id long, text string")
    op.write_shards(df, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == df.count() and back.select("shard").distinct().count() == 4


def test_repeats_nulls_and_empty_tables(spark):
    rows = [(None, "a"), (1, "a"), (1, "a"), (2, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = op.shard_documents(df).collect()
    assert len(got) == 5
    check(got, 24, 100)
    assert op.shard_documents(df.limit(0)).count() == 0


def test_bytes_are_balanced_where_doc_ids_repeat(spark):
    """2,000 different texts and 1,000 rows of one text, which have no doc_id or all the same one."""
    rnd = random.Random(6)
    for same in (None, 17):
        rows = [(i, " ".join("x" * rnd.randint(1, 9) for _ in range(rnd.randint(20, 60)))) for i in range(2000)]
        rows += [(same, "one text that a third of the rows repeat, word by word, again and again " * 2)] * 1000
        got = op.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
        assert len(got) == 3000
        check(got, 24, 0.02)


def test_a_third_of_all_rows_have_one_doc_id(spark):
    rows = [(5, f"text {i} " * (1 + i % 7)) for i in range(1000)] + [(i, f"other {i} " * 9) for i in range(2000)]
    got = op.shard_documents(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, row string, rid int, nth int"), columns=True)
    assert got.columns == ["doc_id", "text", "row", "rid", "nth", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = got.collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(rows)
    check(got, 24, 0.03)
