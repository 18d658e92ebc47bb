"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line. Every query is driven to the
end with the ``noop`` sink (all rows computed, nothing collected).

A text table that is one file with one row group can be read by one task only. A large
table never is, so such tables are first written anew as several files (same
rows; not timed, and told as ``layout`` in the result).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from smishlens.plans.catalog import QUERIES  # noqa: E402
from smishlens.session import get_spark  # noqa: E402

HEADLINE = (
    "preprocess",        # labels + URL join + cleaning
    "tokenise",
    "text_preprocessor",  # lemma/stem lookup joins
    "stem_porter",       # Porter stems of the corpus vocabulary, joined back
    "split_stratified",
    "term_counts",
    "tfidf",
    "nb_predict",        # flagship: clean -> split -> TF-IDF -> naive Bayes -> scores
    "roc_auc",
    "compare_models",
    "augment_union",
    "stream_score",
    "production_refit",
)

TEXT_TABLES = ("documents", "pages", "conversations")


def laid_out(spark, sf_dir: str, files: int) -> str:
    """A folder with the tables of ``sf_dir``, text tables in ``files`` files."""
    folder = tempfile.mkdtemp(prefix="smishlens-bench-")
    for name in os.listdir(sf_dir):
        source, target = os.path.join(sf_dir, name), os.path.join(folder, name)
        if name.removesuffix(".parquet") in TEXT_TABLES and os.path.isfile(source):
            spark.read.parquet(source).repartition(files).write.parquet(target)
        else:
            os.symlink(source, target)
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    spark = get_spark(f"local[{cpus}]", int(cpus), app_name="smishlens-bench",
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    files = 4 * int(cpus)
    tables = laid_out(spark, sf_dir, files)
    # Warm-up: JIT and file listing, not timed.
    QUERIES["fold_accents"](spark, tables).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus),
                      "layout": f"text tables in {files} files"}))
    spark.stop()


if __name__ == "__main__":
    main()
