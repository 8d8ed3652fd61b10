"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
Queries without a model are run twice and the faster run counts; models are trained once.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from precinct.operators import ml  # noqa: E402
from precinct.plans.catalog import QUERIES  # noqa: E402
from precinct.plans.jobs import train_and_evaluate  # noqa: E402
from precinct.session import local_session, scratch_path  # noqa: E402
from precinct.sources import incidents  # noqa: E402

HEADLINE = [
    "csv_weekly_offenses",
    "weekly_offenses",
    "weekly_top10",
    "features_base",
    "row_counts",
    "label_distribution",
    "theft_by_state",
    "types_by_state",
    "top_states_per_type",
    "split_sizes",
    "category_index",
    "confusion_counts",
    "per_class_metrics",
    "evaluation",
    "compare_models",
    "report_lines",
    "run_stats",
]
MODELS = ["lr_metrics", "rf_metrics"]


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def phases(spark, algorithm: str, folder: str) -> dict[str, float]:
    """Seconds of each phase of the training job, and rows a second of fitting and of scoring with evaluation."""
    raw = incidents(spark, folder)
    summary = train_and_evaluate(spark, raw, scratch_path(spark, "bench"), algorithm, key="A_INCIDENT_ID", partitions=ml.train_partitions)
    row = summary.first()
    out = {k.removesuffix("_seconds"): round(v, 3) for k, v in row["timings_seconds"].items()}
    out["fit_rows_per_sec"] = round(row["train_rows"] / out["fit"])
    out["evaluate_rows_per_sec"] = round(row["test_rows"] / out["evaluate"])
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    shared = os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-")
    spark = local_session("bench", cores, **{"spark.sql.shuffle.partitions": cores, "spark.checkpoint.dir": shared})
    timed(spark, "weekly_top10", folder)  # starts the JVM's code paths
    rows = QUERIES["row_counts"](spark, folder).first().asDict()
    seconds = {name: round(min(timed(spark, name, folder) for _ in range(2)), 3) for name in HEADLINE}
    seconds |= {name: round(timed(spark, name, folder), 3) for name in MODELS}
    training = {name: phases(spark, name, folder) for name in ("lr", "rf")}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
                "rows": rows,
                "training": training,
                "cores": int(cores),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
