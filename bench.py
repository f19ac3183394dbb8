"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the cores. Every query runs once to warm up and is
then timed; the result is written to the no-op sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import re
import time

from moodlens.plans import catalog
from moodlens.session import build_session

HEADLINE = (
    "src5_coerce_types", "row2_drop_exact_duplicates", "row6_exact_text_duplicates", "row8_random_sample", "txt12_clean_text",
    "txt17_lexicon_indicators", "agg1_profile_lineitem", "agg7_cleaning_report", "agg12_length_histogram", "agg13_vocabulary_counts",
    "agg14_lexical_richness", "agg16_mean_tfidf", "top2_top_tokens_per_emotion", "spl1_stratified_split", "spl2_stratified_folds",
    "emb6_sif_document_vectors", "emb10_token_coverage", "evl1_macro_metrics", "evl5_auc_per_class", "evl6_roc_micro",
    "key2_log_odds", "key7_centroid_similarity", "top6_keyword_table", "prd6_batch_summary", "mod5_weight_grid", "emb1_word2vec", "spl4_smote",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in catalog.QUERIES if re.search(os.environ["BENCH_ONLY"], n)] if "BENCH_ONLY" in os.environ else list(HEADLINE)
    spark = build_session(
        "moodlens-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        for timed in (False, True):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spark.catalog.clearCache()
            if timed:
                times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    match = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(match.group(1)) if match else None,
    }))


if __name__ == "__main__":
    main()
