"""The corpus pipeline: quality rules, near-duplicates, repeated passages, benchmark passages, tokens.

``STAGES`` names the stages in order. Each takes the documents that its predecessor kept; ``run`` writes each
stage's rows to the shared folder and reads them back for the next.

1. ``quality rules``: documents that the rules reject go, the others are unchanged.
2. ``near duplicates``: of each group of linked fingerprints the row with the smallest id stays, unchanged.
3. ``substring dedup``: words inside windows that an earlier document has are cut. A text that loses words is what
   is left, joined by spaces, and its ``n_chars`` is counted anew; other texts keep their white space.
4. ``benchmark decontamination``: documents with a benchmark passage go, the others are unchanged.
5. ``tokens``: ids of every text and the text decoded from them.

Null texts fail the rules and go with the first stage. Repeated rows are near-duplicates: one stays. Columns other
than those of documents are dropped by the first stage. An empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.llm import bpe, decontaminate, quality_rules, simhash, substring
from moodlens.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ratios = quality_rules.log_ratios(docs, quality_rules.trusted_ids(table(spark, sf_dir, "labels")))
    # stored, as a filter on computed columns would be pushed below them and work them out again for every window
    judged = stored(quality_rules.judge(docs.select(*COLUMNS), ratios).select(*COLUMNS, "kept"), "judged")
    return judged.where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(docs.select(*COLUMNS))
    cut = F.col("n_removed") > 0
    return found.withColumns({
        "text": F.when(cut, F.col("kept_text")).otherwise(F.col("text")),
        "n_chars": F.when(cut, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")),
    }).select(*COLUMNS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.mark(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    found = bpe.encode(docs.select("doc_id", "text"), path, decoded="decoded", keep_text=False)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("tokens", tokens),
]

#: No SQL twin: hashing, fingerprints and the tokenizer have no counterpart in SQL. Tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
