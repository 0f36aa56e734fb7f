"""The corpus pipeline against a plain version of its stages."""

from __future__ import annotations

import hashlib
import os
import random
import re

import pytest

import corpus_pipeline
from orderlens.llm import decontaminate, langid, secret_scan, simhash
from orderlens.llm.queries import ORACLE, QUERIES
from registry.compare import connect, difference

SAMPLE = os.environ.get("ORDERLENS_SAMPLE", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SAMPLE), reason="needs the sample tables")


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_its_sql(spark, name):
    problem, rows = difference(connect(SAMPLE), name, QUERIES[name](spark, SAMPLE))
    assert not problem and rows


def test_there_is_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def test_the_stages_keep_clean_documents_and_take_effect(spark):
    """Of the sample: every document has letters, so none is rejected by language; one of each group of
    near-duplicates stays, unless a passage stands in it; secrets are replaced; the ids decode."""
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()
    items = [decontaminate.level(r.text) for r in spark.read.parquet(f"{SAMPLE}/benchmark.parquet").collect()]
    prints = {r.doc_id: simhash.fingerprint(r.text) for r in docs}
    root = dict.fromkeys(prints)
    for a in sorted(prints):
        if root[a] is None:
            reached, open_ = {a}, [a]
            while open_:
                x = open_.pop()
                near = {b for b in prints if b not in reached and (prints[x] ^ prints[b]).bit_count() <= 3}
                reached |= near
                open_ += near
            root.update(dict.fromkeys(reached, a))
    leaked = {r.doc_id for r in docs if any(item in decontaminate.level(r.text) for item in items)}
    expected = {i for i in prints if root[i] == i and i not in leaked}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SAMPLE).collect()}
    assert set(got) == expected
    secret = re.compile(r"[0-9a-f]{16,}|AKIA[A-Z0-9]{14,}")
    for r in docs:
        if r.doc_id in expected:
            whole = hashlib.sha256(r.text.encode()).hexdigest() == got[r.doc_id].decoded_sha256
            assert whole != bool(secret.search(r.text))


def test_the_language_stage_rejects_what_its_model_does_not_tell_apart(spark):
    """The sample's documents stay; mixtures of languages that the model is unsure of go, as do texts
    without a letter."""
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    texts = {r.lang: r.text.split() for r in docs.where("length(text) > 900").orderBy("doc_id").collect()}
    model = langid.learn(docs)
    rng = random.Random(21)
    words = [word for lang in ("de", "en", "es", "fr") for word in texts[lang][:80]]
    mixed = [" ".join(rng.choices(words, k=rng.randint(4, 40))) for _ in range(300)]
    unsure = [text for text in mixed if model.predict(text)[1] < langid.LEAST_SCORE]
    assert unsure
    added = [*mixed, "12 .. 40", "", None]
    rows = [(-1 - i, text, None, None, None) for i, text in enumerate(added)]
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    kept = [r.doc_id for r in stage(spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), SAMPLE).collect()]
    sure = [i for i, text, *_ in rows if text in mixed and text not in unsure]
    assert sorted(kept) == sorted(sure + [r.doc_id for r in docs.select("doc_id").collect()])


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SAMPLE).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SAMPLE).count() == 0, name


def test_the_secrets_network_takes_part_in_op9_and_the_pipeline(spark, tmp_path):
    """The sample with thirty tokens, thirty addresses, and one secret that no pattern knows."""
    rng = random.Random(12)
    rows = [r.asDict() for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").orderBy("doc_id").collect()]
    kept = {r.doc_id for r in corpus_pipeline.run(spark, SAMPLE).collect()}
    chosen = [r for r in rows if r["doc_id"] in kept and len(r["text"]) > 600][:61]
    for i, r in enumerate(chosen[:60]):
        address = ".".join(str(rng.randint(100, 255)) for _ in range(4))
        r["text"] += f" {address} de" if i % 2 else " token = %040x" % rng.getrandbits(160)
    hidden = "%013x_%013x_%013x" % tuple(rng.getrandbits(52) for _ in range(3))
    chosen[60]["text"] += f" {hidden} de"
    schema = spark.read.parquet(f"{SAMPLE}/documents.parquet").schema
    spark.createDataFrame([tuple(r.values()) for r in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SAMPLE}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    doc_id, text = chosen[60]["doc_id"], chosen[60]["text"]
    spans = {r.doc_id: r.spans for r in QUERIES["op9_secret_scans"](spark, str(tmp_path)).collect()}
    start = text.index(hidden)
    assert f"cnn:{start}:{start + len(hidden)}" in spans[doc_id].split(",")
    digests = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    net = secret_scan.learn(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    clean = secret_scan.redact(text, secret_scan.find(text, net))
    assert hidden not in clean and digests[doc_id] == hashlib.sha256(clean.encode()).hexdigest()
