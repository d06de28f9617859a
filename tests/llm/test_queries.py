"""The registered queries and the pipeline over the whole tables of the smallest scale, against
brute force or, where SQL can express them, DuckDB."""
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from pricewell.llm import mix_threshold, queries, tiling
from pricewell.llm.crossparse_lang import SAMPLE_BYTES, SAMPLE_DOCS, learn, predict

from . import test_mix_threshold, test_passages, test_simhash_anchor, test_tiling

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id)


def run(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))


def test_op1(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    v = np.array([r[1] for r in rows])
    v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
    label = np.array([r[2] for r in rows])
    link = (v @ v.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    got = {r.vec_id: r for r in run(spark, "op1_embedding_dedup")}
    assert {r[0]: int(n) for r, n in zip(rows, link.sum(axis=1))} == {k: r.n_links for k, r in got.items()}
    small = [(rows[i][0], link[i]) for i in range(len(rows))]
    for i, (vec, row) in enumerate(small):
        seen, todo = {i}, [i]
        while todo:
            for j in np.flatnonzero(link[todo.pop()]):
                if j not in seen:
                    seen.add(int(j))
                    todo.append(int(j))
        least = min(rows[j][0] for j in seen)
        assert got[vec].component_id == least and got[vec].kept == (vec == least)


def test_op2(spark, docs):
    t = Tokenizer.from_file(queries.tokenizer_path())
    start = 0
    got = {r.doc_id: r for r in run(spark, "op2_token_repair")}
    for d in docs:
        ids = t.encode(d.text or "", add_special_tokens=False).ids + [2]
        r = got.pop(d.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cur = con.execute(queries.ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(str, cur.fetchall())) == sorted(str(tuple(r)) for r in df.select(*cols).collect())


def test_op4(spark, docs):
    rows = run(spark, "op4_vector_packing")
    size = {d.doc_id: len((d.text or "").encode()) + 8 for d in docs}
    assert {r.doc_id: r.size for r in rows} == size
    check_shards(rows)


def check_shards(rows):
    total = {}
    for s in range(24):
        own = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        total[s] = sum(r.size for r in own)
    assert max(total.values()) - min(total.values()) <= 2 * max(r.size for r in rows)


def test_op5(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op5_simhash_anchor")}
    prints = [test_simhash_anchor.brute_print(d.text) for d in docs]
    root = test_simhash_anchor.brute_components(prints, lambda a, b: bin(a ^ b).count("1") <= 3)
    for d, p, r in zip(docs, prints, root):
        assert (got[d.doc_id].fingerprint, got[d.doc_id].component_id) == (f"{p:016x}", docs[r].doc_id)


def test_op6_and_op7(spark, docs):
    want = test_passages.brute([(d.doc_id, d.text) for d in docs])
    gone6 = {}
    for r in run(spark, "op6_sparse_suffix"):
        gone6.setdefault(r.doc_id, set()).update(range(r.first_word, r.end_word))
    got7 = {r.doc_id: r for r in run(spark, "op7_superkmer_dedup")}
    for d, (w, gone, _) in zip(docs, want):
        assert gone6.get(d.doc_id, set()) == {i for i, g in enumerate(gone) if g}
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        r = got7[d.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())


def test_op9(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op9_crossparse_lang")}
    for d in docs:
        r = got[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2)
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in d.text or ""))
    known = [d for d in docs if got[d.doc_id].held_out and got[d.doc_id].lang_pred != "und"]
    assert sum(got[d.doc_id].lang_pred == d.lang for d in known) >= 0.95 * len(known)


def brute_leaks(docs, items):
    """Pairs by full tiling of every pair that shares five words in a row (or a short item)."""
    out = set()
    grams = [(i, w, {tuple(w[k:k + min(5, len(w))]) for k in range(len(w) - min(5, len(w)) + 1)})
             for i, w in ((i, test_tiling.words(t)) for i, t in items) if w]
    for d, t in docs:
        v = test_tiling.words(t)
        own = {tuple(v[k:k + 5]) for k in range(len(v))}
        for i, w, g in grams:
            if g & own and sum(x[2] for x in tiling.tiles(w, v, 5)) >= 0.8 * len(w):
                out.add((d, i))
    return out


def test_op10(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in run(spark, "op10_string_tiling")}
    assert got == brute_leaks([(d.doc_id, d.text) for d in docs], items)


def test_pipeline(spark, docs):
    """Each stage against brute force on what the stage before kept."""
    at = spark.read.parquet(f"{SF}/documents.parquet")
    columns = at.columns
    out = []
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, SF).checkpoint()
        out.append(sorted(at.collect(), key=lambda r: r.doc_id))
        if name != "sharding":
            assert at.columns == columns
    lang, near, clean, mixed, shards = out
    samples = learn(spark.read.parquet(f"{SF}/documents.parquet"))
    assert all(len(s) <= SAMPLE_BYTES for s in samples.values()) and SAMPLE_DOCS == 64
    assert [r.doc_id for r in lang] == [d.doc_id for d in docs if any(c.isalpha() for c in d.text or "")]
    prints = [test_simhash_anchor.brute_print(d.text) for d in lang]
    root = test_simhash_anchor.brute_components(prints, lambda a, b: bin(a ^ b).count("1") <= 3)
    assert [r.doc_id for r in near] == [d.doc_id for i, d in enumerate(lang) if root[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, _ in brute_leaks([(d.doc_id, d.text) for d in near], items)}
    assert [r.doc_id for r in clean] == [d.doc_id for d in near if d.doc_id not in bad]
    taken = {r.doc_id: r for r in mix_threshold.mix(spark.createDataFrame(clean)).collect()}
    test_mix_threshold.check([(r.doc_id, r.text, r.source) for r in clean], list(taken.values()))
    times = {}
    for r in mixed:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert times == {k: r.taken // r.size for k, r in taken.items() if r.taken}
    assert [(r.doc_id, r.text) for r in shards] == [(r.doc_id, r.text) for r in mixed]
    check_shards(shards)
    assert len({(r.shard, r.slot) for r in shards}) == len(shards)
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, at.collect()))


def test_samples_and_predictions_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = predict(docs, learn(docs)).select("doc_id", "lang_pred").collect()
    b = predict(docs, learn(docs.repartition(3))).select("doc_id", "lang_pred").collect()
    assert sorted(a) == sorted(b)


