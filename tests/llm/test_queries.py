"""Registered queries against their SQL twins and plain versions, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from moodlens.llm import catalog, quality_rules, simhash
from moodlens.llm.common import table
from tests.compare import connect, rows_of
from tests.llm import brute

PATH = public_tokenizers.path(catalog.TOKENIZER)


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_twin(spark, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    found = connect(sf_dir).execute(catalog.ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, found.fetchall())


def test_bpe_query(spark, sf_dir, texts):
    tokenizer = Tokenizer.from_file(PATH)
    for r in catalog.QUERIES["op2_bpe"](spark, sf_dir).collect():
        ids = tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_token_file_query(spark, sf_dir, texts):
    tokenizer, start = Tokenizer.from_file(PATH), 0
    for r in catalog.QUERIES["op4_token_files"](spark, sf_dir).orderBy("doc_id").collect():
        ids = [*tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 1]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_shard_query(spark, sf_dir, texts):
    sizes = Counter()
    for r in catalog.QUERIES["op6_shards"](spark, sf_dir).collect():
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["law"] == "bytes"
        sizes[r["shard"]] += r["size"]
    assert sorted(sizes) == list(range(16))


def test_classifier_query(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect()}
    found = [r for r in catalog.QUERIES["op7_byte_cnn"](spark, sf_dir).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in found]) > 0.8


def test_quality_query(spark, sf_dir, texts):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for r in catalog.QUERIES["op8_quality_rules"](spark, sf_dir).collect():
        assert tuple(r[n] for n in names) == brute.counts(texts[r["doc_id"]])


@pytest.mark.parametrize(("size", "least"), [("sf0.001", 0.7), ("sf0.01", 0.8)])
def test_quality_keeps_unlabelled_documents(spark, size, least):
    folder = f"/root/testdata/{size}"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    known = {r["doc_id"] for r in labels.collect()}
    clean = [r for r in catalog.QUERIES["op8_quality_rules"](spark, folder).collect() if r["doc_id"] not in known and not r["base_failed"]]
    assert np.mean([r["kept"] for r in clean]) > least
    none = quality_rules.log_ratios(docs, quality_rules.trusted_ids(labels.where("false")))
    assert all(r["score"] == 0 and r["kept"] != r["base_failed"] for r in quality_rules.judge(docs, none).select("score", "kept", "base_failed").collect())


def test_quality_few_labels_reject_no_good_document(spark):
    folder = "/root/testdata/sf0.01"
    docs, good = table(spark, folder, "documents"), table(spark, folder, "labels").where("quality = 1")
    ratios = quality_rules.log_ratios(docs, quality_rules.trusted_ids(good.where("doc_id % 10 = 0")))
    known = {r["doc_id"] for r in good.collect()}
    judged = [r for r in quality_rules.judge(docs, ratios).select("doc_id", "kept", "base_failed").collect() if r["doc_id"] in known and not r["base_failed"]]
    assert np.mean([r["kept"] for r in judged]) > 0.95


def test_simhash_query(spark, sf_dir, texts):
    ids = sorted(texts)
    prints = [brute.fingerprint(texts[k]) for k in ids]
    want = {k: (f"{p:016x}", ids[g]) for k, p, g in zip(ids, prints, brute.groups(prints), strict=True)}
    assert {r[0]: (r[1], r[2]) for r in catalog.QUERIES["op10_simhash"](spark, sf_dir).collect()} == want


def test_pipeline(spark, sf_dir, benchmark):
    """Every stage on its own input, against the plain versions."""
    docs = table(spark, sf_dir, "documents")
    kept = [[tuple(r) for r in docs.collect()]]
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, spark.createDataFrame(kept[-1], docs.schema), sf_dir)
        assert docs.columns == corpus_pipeline.COLUMNS
        kept.append(sorted(tuple(r) for r in docs.collect()))
    raw, good, single, cut, clean = kept
    ratios = quality_rules.log_ratios(table(spark, sf_dir, "documents"), quality_rules.trusted_ids(table(spark, sf_dir, "labels")))
    verdict = {r["doc_id"]: r["kept"] for r in quality_rules.judge(table(spark, sf_dir, "documents"), ratios).collect()}
    assert good == sorted(r for r in raw if verdict[r[0]])
    prints = [brute.fingerprint(r[1]) for r in good]
    assert single == [r for k, (r, g) in enumerate(zip(good, brute.groups(prints), strict=True)) if g == k]
    left = {d: (n, t) for d, _, n, t in brute.removed([r[:2] for r in single])}
    assert cut == [(r[0], left[r[0]][1], r[2], r[3], len(left[r[0]][1])) if left[r[0]][0] else r for r in single]
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    hit = {r[0]: r[4] for r in brute.contaminated([r[:2] for r in cut], items)}
    assert clean == [r for r in cut if not hit[r[0]]]
    tokenizer = Tokenizer.from_file(PATH)
    last = corpus_pipeline.tokens(spark, spark.createDataFrame(clean, docs.schema), sf_dir).collect()
    assert {r["doc_id"]: r["ids"] for r in last} == {r[0]: tokenizer.encode(r[1], add_special_tokens=False).ids for r in clean}


def test_pipeline_with_awkward_rows(spark, sf_dir, docs, nothing):
    for start in (docs, nothing):
        rows = start
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, rows, sf_dir)
            rows = spark.createDataFrame(found.collect(), found.schema)
        assert rows.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert simhash.deduplicate(nothing).count() == 0
