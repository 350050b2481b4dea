"""The registered queries and the pipeline on the smallest tables."""

import hashlib
import os

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from opinara.llm import language_id, mixing
from opinara.llm.queries import QUERIES
from opinara.llm.sql import ORACLE

from . import test_conversations, test_importance
from .test_near_dedup import brute_force

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    1: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    2: "doc_id n_tokens ids_sha256 decoded_sha256",
    3: "doc_id held_out lang_pred score",
    4: "page_id payload_bytes payload_digest record_type refers_to",
    5: "page_id host path rule verdict",
    6: "doc_id size source_size target taken",
    7: "doc_id start n_tokens ids_crc32",
    8: "doc_id n_bytes n_tokens over_limit",
    9: "doc_id keep_id group_size kept text_sha256",
    10: "doc_id class_id kept",
    11: "doc_id held_out score predicted",
    12: "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    13: "doc_id n_features weight score rank",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_columns_and_rows(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    number = int(name[2:].split("_")[0])
    assert set(COLUMNS[number].split()) <= set(frame.columns)
    table = {"page_id": "pages", "conv_id": "conversations"}.get(frame.columns[0], "documents")
    rows = frame.collect()
    given = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    given = given.select("conv_id").distinct() if table == "conversations" else given
    assert len(rows) == given.count()
    if name in ORACLE:
        connection = duckdb.connect()
        connection.execute(f"CREATE VIEW {table} AS FROM read_parquet('{FOLDER}/{table}.parquet')")
        columns = ", ".join(frame.columns)
        want = connection.execute(f"SELECT {columns} FROM ({ORACLE[name]})").fetchall()
        assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_token_queries_agree_with_the_library(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coded = {r["doc_id"]: r for r in QUERIES["op2_bpe_codec"](spark, FOLDER).collect()}
    counted = {r["doc_id"]: r for r in QUERIES["op8_token_counter"](spark, FOLDER).collect()}

    def mark(text):
        return hashlib.sha256(text.encode()).hexdigest()

    for row in docs.collect():
        ids = library.encode(row["text"], add_special_tokens=False).ids
        got = coded[row["doc_id"]]
        assert (got["n_tokens"], got["ids_sha256"]) == (len(ids), mark(" ".join(map(str, ids))))
        assert got["decoded_sha256"] == mark(library.decode(ids, skip_special_tokens=False))
        assert tuple(counted[row["doc_id"]])[1:] == (len(row["text"].encode()), len(ids), len(ids) > 2048)


def test_near_duplicate_query_equals_brute_force(spark, docs):
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op10_near_dedup"](spark, FOLDER).collect()}
    assert got == brute_force([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_repair_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows]
    got = QUERIES["op12_conversation_repair"](spark, FOLDER).select(COLUMNS[12].split())
    want = test_conversations.brute_force(test_conversations.after_damage(rows))
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_importance_query_equals_brute_force(spark, docs):
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = test_importance.brute_force([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert test_importance.got(QUERIES["op13_importance"](spark, FOLDER)) == want


def plain_triples(rows):
    """Triples of the texts and the row of each, text by text."""
    found = [language_id.grams([r["text"] or ""])[0] for r in rows]
    return np.concatenate(found), np.repeat(np.arange(len(rows)), [len(f) for f in found])


def test_pipeline_equals_its_stages_done_plainly(spark, docs):
    model = language_id.fit(docs)
    rows = docs.collect()
    names, scores, rejected = model.judge([r["text"] or "" for r in rows])
    novel = model.novelty(*plain_triples(rows), len(rows)) > model.most_novel
    plainly = (np.array(names) == "und") | (scores < model.threshold) | novel
    assert plainly.tolist() == rejected.tolist()
    rows = [r for r, out in zip(rows, plainly) if not out]
    last = {}
    for r in rows:
        last[r["text"]] = max(last.get(r["text"], r["doc_id"]), r["doc_id"])
    rows = [r for r in rows if last[r["text"]] == r["doc_id"]]
    classes = brute_force([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if classes[r["doc_id"]] == r["doc_id"]]
    kept = docs.filter(F.col("doc_id").isin([r["doc_id"] for r in rows]))
    passes = {r["doc_id"]: r["passes"] for r in mixing.mix(kept, F.array("source")).collect()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in rows:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want += [(r["doc_id"], ids, decoded)] * passes[r["doc_id"]]
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "ids", "decoded"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_stages_keep_the_columns(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns, name
    nothing = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, FOLDER).count() == 0, name
