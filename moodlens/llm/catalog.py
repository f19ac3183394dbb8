"""The registered queries of this folder and, where SQL can say the same, their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.llm import bpe, byte_cnn, chat, decontaminate, hard_negatives, licenses, quality_rules, runs, shards, simhash, substring, token_files, warc
from moodlens.llm.common import SPACES, pieces, table, whole
from moodlens.session import scratch_path

#: The tokenizer file that the token queries use.
TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


OP3_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, w[i:i + 12] AS k FROM words, unnest(range(1, len(w) - 11)) AS t(i)
), firsts AS (
  SELECT k, min(doc_id) AS f FROM windows GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, i + o AS p FROM windows JOIN firsts USING (k), unnest(range(0, 13)) AS t(o) WHERE f < doc_id
), cut AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE [x FOR x, i IN w IF NOT list_contains(ps, i)] END, ' ')) AS kept_sha256
FROM words LEFT JOIN cut USING (doc_id)
"""

OP5_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, w[i:i + 9] AS k FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT len(k) AS n FROM item_windows
), doc_windows AS (
  SELECT doc_id, n, i, w[i:i + n - 1] AS k FROM docs, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
), found AS (
  SELECT doc_id, n, i, item_id FROM doc_windows JOIN item_windows USING (k)
), hit AS (
  SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM found, unnest(range(0, n)) AS t(o) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM found GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP9_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages
), l AS (
  SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d, n) END AS last FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN last > page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN last > page_id THEN last END AS refers_to
FROM l
"""


def _op1_sql() -> str:
    base = ", ".join(f"('{p}', '{label}')" for p, label in licenses.BASE)
    kinds = ", ".join(f"('{t}', '{label}', {licenses.width(len(t.split()))})" for t, label in licenses.TEMPLATES)
    return rf"""
WITH base AS (
  SELECT string_split(p, ' ') AS pw, label FROM (VALUES {base}) AS t(p, label)
), kinds AS (
  SELECT list_distinct(string_split(t, ' ')) AS tw, label, size, ceil({licenses.CONTAINMENT} * len(tw) - 1e-9) AS need
  FROM (VALUES {kinds}) AS t(t, label, size)
), words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), hits AS (
  SELECT doc_id, i - 1 AS start, label, 1.0::DOUBLE AS score FROM words, base, unnest(range(1, len(w) - len(pw) + 2)) AS t(i) WHERE w[i:i + len(pw) - 1] = pw
), possible AS (
  SELECT * FROM words, kinds WHERE len(list_intersect(tw, w)) >= need
), met AS (
  SELECT doc_id, NULL AS start, label, max(len(list_intersect(tw, w[i:i + size - 1]))) / any_value(len(tw))::DOUBLE AS score
  FROM possible, unnest(range(1, greatest(len(w) - size + 1, 1) + 1)) AS t(i)
  WHERE len(list_intersect(tw, w[i:i + size - 1])) >= need GROUP BY doc_id, label, tw
), found AS (
  SELECT doc_id, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word, max(score) AS score,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE start IS NOT NULL) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT * FROM hits UNION ALL SELECT * FROM met) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM words LEFT JOIN found USING (doc_id)
"""


@query("op1_licenses", _op1_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratios = quality_rules.log_ratios(docs, quality_rules.trusted_ids(table(spark, sf_dir, "labels")))
    return quality_rules.judge(docs, ratios).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


@query("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query("op3_substring_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op5_decontamination", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query("op2_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.encode(docs, path, decoded="decoded", keep_text=False)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write(docs, folder, public_tokenizers.path(TOKENIZER), end=1)
    return token_files.read(manifest, folder, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op9_warc", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    manifest = warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"), shards=16)


@query("op7_byte_cnn")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = byte_cnn.train(docs, table(spark, sf_dir, "labels"))
    return byte_cnn.score(docs, network).select(
        "doc_id", byte_cnn.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


OP11_SQL = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM kept a, kept b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)::INTEGER AS rank,
  n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) <= 5
"""


@query("op11_hard_negatives", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved))


#: A conversation added to the table: both turns hold marks of templates.
PLANTED = "</s>[INST] ok [/INST]"


def _op12_sql() -> str:
    escaped = "coalesce(text, '')"
    for first in sorted({c[0] for c in chat.CONTROL}):
        rests = "|".join(re.escape(c[1:]) for c in chat.CONTROL if c[0] == first)
        escaped = rf"regexp_replace({escaped}, '{re.escape(first)}(\\*(?:{rests}))', '{first}\\\1', 'g')"
    marks = len(chat.START) + len(chat.END) + 2
    return rf"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PLANTED}' UNION ALL SELECT -7, 1, '{chat.LOSS_ROLE}', '{PLANTED}'
), learned AS (
  SELECT *, CASE WHEN role = '{chat.LOSS_ROLE}' THEN coalesce(text, '') ELSE '' END AS loss FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(length(loss))::BIGINT AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum({marks} + length(role) + length({escaped}))::BIGINT AS formatted_chars
FROM learned GROUP BY conv_id
"""


@query("op12_chat", _op12_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], turns.schema)
    return chat.digests(chat.format(turns.unionByName(planted)))


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents whose id hashes to a multiple of ten get a periodic tail; the others are unchanged."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def tail(words):
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        kept = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(kept, " ")).otherwise(F.lit(""))

    # the words are bound once, not cut anew for every place
    changed = F.get(F.transform(F.array(pieces(whole(F.col("text")), SPACES)), tail), F.lit(0))
    return docs.select("doc_id", F.when(h % 10 == 0, changed).otherwise(F.col("text")).alias("text"))


@query("op13_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find(with_periods(table(spark, sf_dir, "documents")))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = found.withColumn("best", runs.longest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
