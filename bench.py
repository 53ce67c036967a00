"""Time the headline queries; prints one JSON line.

Each query is written to the no-op sink, so all columns of all rows are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardflow import registry  # noqa: E402

HEADLINES = [
    "jb1_cohort_30_days",
    "jb1_cohort_180_days",
    "jb2_labelled_clean_notes",
    "jb3_training_data",
    "jb5_month_labelled_set",
    "jb6_vote_report",
    "jb7_cohort_profile",
    "wn2_backfilled_next",
    "wn3_latest_note",
    "sp2_stratified_split",
    "tx1_clean_notes",
    "tx4_word_chunks",
    "tx12_clinical_stop_words",
    "ag12_describe_gap",
    "ag16_note_length_density",
    "ag19_mean_pooled_vectors",
    "ar1_encoded_sequences",
    "ev6_roc_points",
    "ev11_classification_report",
    "ml2_tfidf",
    "ml6_elastic_net_scores",
    "ml7_forest_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wardflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").count()
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        start = time.perf_counter()
        registry.ALL[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
