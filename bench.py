"""Time the headline queries, or those named as arguments, and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores. `bench.py all` times
every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from opinara.session import local_session  # noqa: E402

FLAGSHIP = "train_and_evaluate"
HEADLINE = """
train_and_evaluate variant_comparison prepare_datasets word_reports clean_text tokenize_strip
stem_words lemmatize_words balanced_sample word_count term_frequency document_frequency tf_idf
feature_selection feature_text class_statistics avg_tfidf_by_sentiment top_words_by_sentiment
train_word_counts score_reviews model_lookup_join top_fraction_per_group
top_fraction_of_large_groups csv_reviews merged_export
""".split()


def run(spark, folder: str, name: str) -> float:
    """Seconds to build the query, run it and drop its rows."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, folder, FLAGSHIP)  # start-up and compilation are not the queries' time
    seconds = {name: round(run(spark, folder, name), 3) for name in names}
    metrics = QUERIES[FLAGSHIP](spark, folder).first().asDict()
    result = {
        "metric": "total seconds over the timed queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "quality": metrics,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
