"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 5), BENCH_WARMUP (default 2). All queries are first run
BENCH_WARMUP times (JIT warm-up of the shared code paths), then BENCH_REPEAT
interleaved rounds are timed; the per-query value is the median wall time of a
full evaluation into Spark's ``noop`` sink (every row computed, nothing
collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from wordfold.operators import report, tokenize, word_count  # noqa: E402
from wordfold.plans.jobs import top_words_of_files  # noqa: E402
from wordfold.plans.queries import QUERIES, documents, export_doc_texts  # noqa: E402
from wordfold.session import local_session  # noqa: E402
from wordfold.sources import lines_from_column  # noqa: E402

HEADLINE = [
    "top_words",
    "top_words_report",
    "word_count",
    "tokenize",
    "text_lines",
    "line_union_all",
    "int_sum",
    "int_sum_wrap32",
    "even_count",
    "even_rows",
    "list_children",
    "path_status",
    "page_status",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def cpu_calibration() -> float:
    """Seconds for a fixed pure-Python loop: a yardstick for the machine's speed
    at the time of the run (shared VMs vary), to compare runs with each other."""
    t0 = time.perf_counter()
    sum(i * i for i in range(2_000_000))
    return round(time.perf_counter() - t0, 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")

    calibration_before = cpu_calibration()
    # The reference's own workload: two text-file sources -> top 100 report.
    # Setup (not timed): Spark writes all documents as text, English and others.
    text_files = export_doc_texts(spark, sf_dir)
    jobs = {name: (lambda q=QUERIES[name]: q(spark, sf_dir)) for name in HEADLINE}
    # The documents file is one row group, so its scan is one task: the same jobs after
    # spreading the rows over the cores first, which only pays for such an input.
    lines = lambda: lines_from_column(documents(spark, sf_dir).repartition(cpus), "text")
    jobs["word_count_spread"] = lambda: word_count(tokenize(lines(), line_col="line"))
    jobs["text_lines_spread"] = lines
    jobs["files_top_words_report"] = lambda: report(top_words_of_files(spark, text_files))

    warmup = int(os.environ.get("BENCH_WARMUP", "2"))
    for _ in range(warmup):
        for job in jobs.values():
            run(job())
    samples: dict[str, list[float]] = {name: [] for name in jobs}
    for _ in range(repeat):
        for name, job in jobs.items():
            t0 = time.perf_counter()
            run(job())
            samples[name].append(time.perf_counter() - t0)
    times = {name: round(statistics.median(s), 4) for name, s in samples.items()}

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_sec",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "repeat": repeat,
                "warmup": warmup,
                "cpu_calibration_sec": [calibration_before, cpu_calibration()],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
