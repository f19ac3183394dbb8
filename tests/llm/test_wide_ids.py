"""Ids beyond 2^53 beside a null id, and passed-through numbers beside a null, come back as they were."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from moodlens.llm import bpe, byte_cnn, decontaminate, licenses, quality_rules, shards, simhash, substring, token_files, warc
from moodlens.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
WIDE = 1 << 60
IDS = [WIDE + 1, None, WIDE + 3, 7]
BODY = [f"w{k}" for k in range(40)]


@pytest.fixture(scope="module")
def wide(spark):
    rows = [(i, " ".join([*BODY[k * 3 :], f"own{k}"]), "en", "s", None if k == 2 else WIDE + 5 + k) for k, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1).cache()


def same(found, column="doc_id"):
    assert sorted((r[0] for r in found.select(column).collect()), key=str) == sorted(IDS, key=str)


def test_operators_on_documents(spark, wide):
    same(licenses.scan(wide))
    same(bpe.encode(wide, PATH))
    same(decontaminate.mark(wide, spark.createDataFrame([(WIDE + 9, " ".join(BODY[:12]))], "item_id bigint, text string")))
    same(shards.assign(wide, shards=2))
    same(quality_rules.judge(wide, quality_rules.log_ratios(wide, wide.select("doc_id").where("doc_id IS NOT NULL"))))
    same(simhash.fingerprints(wide))
    network = byte_cnn.fit(["good words here"] * 20 + ["##$ 9 %"] * 20, [1] * 20 + [0] * 20)
    assert all(0 <= r["score"] <= 1 for r in byte_cnn.score(wide, network).collect())
    same(byte_cnn.score(wide, network))


def test_near_duplicates(wide):
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(wide).collect()}
    assert set(found) == set(IDS) and set(found.values()) <= set(IDS)
    kept = simhash.deduplicate(wide).collect()
    assert {(r["doc_id"], r["n_chars"]) for r in kept} <= {(r["doc_id"], r["n_chars"]) for r in wide.collect()}


def test_repeats(wide):
    found = {r["doc_id"]: (r["n_removed"], r["n_chars"]) for r in substring.remove_repeats(wide).collect()}
    # the smallest id keeps its words, the null id counts as the largest
    assert found == {7: (0, WIDE + 8), WIDE + 1: (31, WIDE + 5), WIDE + 3: (34, None), None: (37, WIDE + 6)}


def test_token_files(spark, wide):
    folder = scratch_path(spark, "tokens")
    same(token_files.read(token_files.write(wide, folder, PATH, end=1), folder))


def test_pages(spark):
    page = "<p>" + "text " * 300
    pages = spark.createDataFrame([(i, f"http://x/{k}", page if k != 1 else "short") for k, i in enumerate(IDS)], "page_id bigint, url string, html string").coalesce(1)
    folder = scratch_path(spark, "warc")
    found = warc.read(warc.write(pages, folder), folder)
    assert {r["page_id"]: r["refers_to"] for r in found.collect()} == {WIDE + 1: WIDE + 3, None: None, WIDE + 3: None, 7: WIDE + 3}


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, sf_dir, wide, k):
    known = wide.withColumn("text", F.when(F.col("doc_id") == 7, F.col("text")).otherwise(F.concat("text", F.lit(" "), F.col("text"))))
    found = corpus_pipeline.STAGES[k][1](spark, known, sf_dir).select("doc_id").collect()
    assert {r[0] for r in found} <= set(IDS) and (k not in (2, 4) or len(found) == len(IDS))
