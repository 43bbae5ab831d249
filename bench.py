"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from isoloom.plans.catalog import QUERIES
from isoloom.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP = "combine_results"
HEADLINE = (
    "report_sort", "amr_summary", "phenotype_summary", "validation_issues", "validation_report", "write_validated",
    "lab_projection", "stage_plan", "missing_outputs", "paired_mates", "detect_join_key", "scan_gff", "scan_fasta",
    "cut_tail", "length_filter", "filter_summary", "per_base_quality", "base_content", "duplication_levels",
    "overrepresented", "assembly_stats", "qc_overview", "allele_exact", "locus_status", "best_scheme", "gene_screen",
    "gene_phenotype", "kmer_taxon", "taxon_report", "incremental_ingest",
)


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", int(CPUS), driver_memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES[WARM_UP](spark, SF_DIR).write.format("noop").mode("overwrite").save()  # compile and load before the clock
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
