"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the table folder and ``BENCH_CPUS`` the number of local cores. Each
query runs twice and the second run counts, so class loading and code generation of a
cold JVM are left out. Results are consumed in full by a sink that discards them.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = [
    "cohort_common_variants",
    "variant_to_gene",
    "gene_burden_long",
    "top_burdened_genes",
    "hard_filter_pass",
    "vcf_scan",
    "mutation_burden",
    "substitution_spectrum",
    "cell_allele_counts",
    "cluster_allele_sums",
    "fastq_merge_r2_r3",
    "sample_integration",
    "spearman_tests",
    "bh_fdr",
    "roc_auc",
    "stratified_folds",
    "logo_validation",
    "stage_durations",
]


def main() -> None:
    from locusloom.plans import all_queries
    from locusloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores, int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}
    names = sys.argv[1:] or HEADLINES
    for name in names:
        for _ in range(2):
            began = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - began, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
