"""Headline queries on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR``.

Prints one JSON line. The long dosage table and the annotation documents are
inputs (files, in a real run) and are written before the clock starts;
everything else, including every haplotype estimation, is timed from scratch.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "merged_summary",
    "region_interval_join",
    "vcf_sample_explode",
    "genotype_pivot",
    "genotype_patterns",
    "em_haplotype_freq",
    "haplotype_glm",
    "tidy_coefficients",
    "posterior_reweight",
    "annotation_rank",
    "af_histogram_30",
    "af_bin_width",
)


def main() -> None:
    from checks import views
    from checks.registry import QUERIES
    from locusframe.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")

    def prepare() -> None:
        views.clear_store()
        views.v_dosage(spark, sf_dir)
        views.v_annotation(spark, sf_dir)

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    prepare()
    run("merged_summary")  # JVM warm-up
    inputs = dict(views._STORE)
    timings: dict[str, float] = {}
    for name in HEADLINE:
        # posterior_reweight continues the models of tidy_coefficients.
        if name != "posterior_reweight":
            views._STORE.clear()
            views._STORE.update(inputs)
        timings[name] = round(run(name), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
