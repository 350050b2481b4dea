import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import language_id

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language_id.fit(docs)
    found = language_id.identify(docs, model).join(docs, "doc_id").withColumn("out", language_id.held_out())
    held = found.filter("out").agg(F.count(F.lit(1)), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert held[0] > 200 and held[1] / held[0] > 0.98
    assert found.filter("rejected").count() == 0
    assert found.filter("score < 0 OR score > 1").count() == 0
    again = language_id.fit(docs.repartition(7))
    assert np.array_equal(model.embedding, again.embedding)  # no order of rows matters


def test_held_out_rows_are_not_learned_from(spark):
    rows = [(i, "aaa bbb", "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else "yy", None) for i in range(60)]
    model = language_id.fit(spark.createDataFrame(rows, SCHEMA))
    assert model.languages == ["yy"]


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog", "en", None) for i in range(30)]
    rows += [(i, "der hund und die katze", "de", None) for i in range(30, 60)]
    rows += [(100, None, "en", "s"), (101, "", None, "s"), (102, "12 !?", "en", "s"), (None, "der und", None, "s"),
             (104, "the dog " * 50_000, None, "s"), (104, "the dog", None, "s")]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language_id.fit(docs)
    got = language_id.identify(docs, model).filter("doc_id > 99 OR doc_id IS NULL").collect()
    found = sorted(((r["doc_id"] or 0), r["lang_pred"], r["rejected"]) for r in got)
    assert found == [(0, "de", False), (100, "und", True), (101, "und", True), (102, "und", True),
                     (104, "en", False), (104, "en", False)]
    kept = language_id.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == 63
    nothing = docs.limit(0)
    assert language_id.identify(nothing, language_id.fit(nothing)).count() == 0
    unlabelled = language_id.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language_id.identify(docs, unlabelled).collect()} == {"und"}


FOREIGN = [
    "Мой дядя самых честных правил, когда не в шутку занемог, он уважать себя заставил",
    "道可道，非常道。名可名，非常名。无名天地之始；有名万物之母。",
    "Άνδρα μοι έννεπε, Μούσα, πολύτροπον, ος μάλα πολλά πλάγχθη",
    "Korkma, sönmez bu şafaklarda yüzen al sancak; sönmeden yurdumun üstünde tüten en son ocak",
    "Litwo, ojczyzno moja, ty jesteś jak zdrowie; ile cię trzeba cenić, ten tylko się dowie",
    "xqzv wkjp zzxq vbgk qwpl mxnz kqjx hgfd zxcv pqwm jjkq vvxz",
    "Привет, мир",
]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("languages", [("de", "en", "es", "fr"), ("de", "en"), ("es", "fr")])
def test_texts_in_no_learned_language_are_rejected(spark, languages):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter(F.col("lang").isin(*languages))
    model = language_id.fit(docs)
    found = language_id.identify(docs, model)
    assert found.count() == docs.count() and found.filter("rejected").count() == 0
    texts = [r["text"] for r in docs.filter("length(text) > 300").orderBy("doc_id").limit(200).collect()]
    salad = [language_id.shuffled(t) for t in texts]
    halves = [a[: len(a) // 2] + " " + b[len(b) // 2 :] for a, b in zip(texts, texts[1:])]
    assert model.judge(FOREIGN + salad)[2].all()
    assert not model.judge(halves)[2].any()
    rows = [(i, t, None, None) for i, t in enumerate(FOREIGN + salad + halves)]
    kept = language_id.keep_identified(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(len(FOREIGN + salad), len(rows)))


def test_threshold_has_a_ceiling():
    draw = np.random.default_rng(1)
    rows = [(np.unique(draw.integers(0, 400, 30)) + 400 * (i % 2),) for i in range(200)]
    rows = [(r[0], np.ones(len(r[0]))) for r in rows]
    model = language_id.train(["a", "b"] * 100, rows, np.arange(200) % 5 == 0)
    assert model.threshold <= language_id.MOST
