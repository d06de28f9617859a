import random
import zlib

import numpy as np
import pytest

from pricewell.llm import crossparse_lang as op


def brute_phrases(sample: bytes, text: bytes) -> int:
    """Greedy parse: each phrase is the longest prefix of the rest that occurs in the sample."""
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i:j + 1] in sample and text[i:j] in sample:
            j += 1
        i, n = j, n + 1
    return n


def test_automaton_parses_as_brute_force():
    rnd = random.Random(1)
    sample = bytes(rnd.choice(b"abcd ") for _ in range(400))
    for _ in range(200):
        text = bytes(rnd.choice(b"abcd xyz") for _ in range(rnd.randint(1, 60)))
        if rnd.random() < 0.3:
            at = rnd.randrange(300)
            text = text[:5] + sample[at:at + 40] + text[5:]
        data = np.frombuffer(text, np.uint8)
        got = op.costs({"x": sample}, data, np.array([0, len(text)]))[0, 0] * len(text) / np.log2(len(sample))
        parts = [op.fold(data)[i:i + op.SEGMENT].tobytes() for i in range(0, len(text), op.SEGMENT)]
        assert round(got) == sum(brute_phrases(sample, p) for p in parts)


def test_long_texts_are_parsed_whole():
    sample = b"the cat sat on the mat " * 20
    text = (b"the cat sat " * 5000) + (b"qq" * 5000)
    whole = op.costs({"x": sample}, np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0, 0]
    head = op.costs({"x": sample}, np.frombuffer(text[:60000], np.uint8), np.array([0, 60000]))[0, 0]
    assert whole > 2 * head


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in op.identify(docs).collect()}
    rows = [r for r in docs.collect() if r.lang is not None]
    assert len(got) == docs.count()
    for r in rows:
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= got[r.doc_id].score <= 1
    out = [r for r in rows if got[r.doc_id].held_out]
    right = sum(got[r.doc_id].lang_pred == r.lang for r in out)
    assert right >= 0.97 * len(out)


def test_predictions_ignore_labels_and_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    samples = op.learn(docs)
    a = {r.doc_id: (r.lang_pred, r.score) for r in op.predict(docs, samples).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in op.predict(docs.selectExpr("doc_id", "text", "'zz' as lang"), samples).collect()}
    assert a == b
    held = docs.filter(op.held_out(docs.doc_id))
    assert op.learn(held) == {}


def test_odd_rows(spark):
    rows = [(1, "hello there the cat", "en"), (3, "bonjour le chat été", "fr"), (8, None, "en"), (9, "", "fr"), (10, "12 -- 34 !", None),
            (None, "the cat", "en"), (1, "hello there the cat", "en"), (11, "É", None), (12, "the " * 200_000, None), (13, "猫", None)]
    df = spark.createDataFrame([(*r, "clash", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    got = op.identify(df).collect()
    assert len(got) == len(rows)
    pred = {r.doc_id: r.lang_pred for r in got}
    assert pred[8] == pred[9] == pred[10] == "und"
    assert {pred[k] for k in (1, 3, 11, 12, 13, None)} <= {"en", "fr"}
    assert pred[12] == "en" and pred[3] == "fr"
    assert op.identify(df.limit(0)).count() == 0
    assert {r.lang_pred for r in op.identify(df.withColumn("lang", df.lang.substr(1, 0))).collect()} <= {"", "und"}
    none = df.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in op.identify(none).collect()} == {"und"}


@pytest.mark.parametrize("stray", ["ok", "ok then", "a", "the cat sat ok"])
def test_a_language_of_one_short_row_wins_no_other_texts(spark, stray):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    samples = op.learn(docs)
    before = {r.doc_id: r.lang_pred for r in op.predict(docs, samples).collect()}
    more = op.predict(docs, {**samples, "zz": stray.encode()}).collect()
    assert {r.doc_id: r.lang_pred for r in more} == before


def test_a_header_that_all_documents_share_changes_little(spark):
    """Places over whole texts are learned, so what all texts begin with teaches no language alone."""
    from pyspark.sql import functions as F
    header = " ".join(f"License {i} notice of the shared archive, all rights in this file reserved." for i in range(10))[:738]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("text", F.concat(F.lit(header), "text"))
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in op.identify(docs).collect() if r.held_out and lang[r.doc_id] is not None]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_the_sample_is_bounded(spark):
    rows = [(i % 3, f"the cat {i} sat on the mat " * 40, "en") for i in range(600)]
    rows += [(100 + i, f"word {i} of a language", f"l{i:03d}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = op.learn(df, sample_docs=8, sample_bytes=1000, languages=5)
    assert len(got) == 5 and "en" in got and all(len(x) <= 1000 for x in got.values())
    assert got == op.learn(df.repartition(2, "text"), sample_docs=8, sample_bytes=1000, languages=5)
