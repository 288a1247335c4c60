"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced with a no-op write (full computation, nothing collected)
and timed from the first action to the end, after one untimed warm-up query.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "listing_features_by_category",
    "clean_token_filters_doc",
    "keyword_features_doc",
    "cleaning_config_lengths",
    "top_ngrams_2_3",
    "describe_features",
    "duplicate_groups_doc",
    "tfidf_description",
    "char_ngrams_title",
    "split_weighted_blocks",
    "numeric_measures_part",
    "numeric_tokens_part",
    "model_metrics",
    "ensemble_methods",
    "fusion_weight_grid",
    "stratified_holdout",
    "early_stopping",
    "image_directional_edges",
    "image_color_proportions",
    "coefficient_importance",
    "best_vectorization_fit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    os.environ.setdefault("VITRINE_MASTER", f"local[{cpus}]")
    from vitrine.session import get_spark
    from vitrine.plans import REGISTRY

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    spark.conf.set("vitrine.readPartitions", cpus)  # the bench files hold one row group each
    # warm-up (JVM, codegen caches)
    REGISTRY["listing_features_by_category"].builder(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in (only or HEADLINE):
        t0 = time.time()
        df = REGISTRY[name].builder(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
