"""Headline timings: prints one JSON line.

``$BENCH_SF_DIR`` names the data, ``$BENCH_CPUS`` the cores. ``prepare_corpus``
(clean, split and term tables) and ``fit_naive_bayes`` write what later entries
read, as in real use, and are timed on their own.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from docsift.plans import all_queries  # noqa: E402
from docsift.plans import registry as R  # noqa: E402
from docsift.session import local_session  # noqa: E402

HEADLINE = [
    "top_corpus_terms",
    "clean_text",
    "document_keywords",
    "corpus_metrics",
    "duplicate_report",
    "first_of_duplicates",
    "word_length_summary",
    "raw_vocabulary",
    "top_terms_by_category",
    "token_budget",
    "lemma_map",
    "stratified_split",
    "stratified_folds",
    "vocabulary",
    "tfidf_weights",
    "naive_bayes_predictions_all",
    "centroid_predictions",
    "classification_report",
    "macro_auc",
    "mcnemar_text_and_vector",
    "dual_scoring",
    "logistic_regression_metrics",
    "linear_svm_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "docsift-bench")
    spark.range(1).count()
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)

    timed("prepare_corpus", lambda: R.corpus(spark, sf_dir))
    timed("fit_naive_bayes", lambda: R.naive_bayes(spark, sf_dir))
    chosen = sys.argv[1:] or HEADLINE
    for name in chosen:
        run = all_queries()[name].run
        timed(name, lambda run=run: run(spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
