"""Runs the training job on a CSV of about the published size (9.13 million incidents).

    python benchmarks/full_size.py SCRATCH_FOLDER [lr|rf] [CORES] [COPIES]

The incidents of /root/testdata/sf0.1 are written ``COPIES`` times (61 by default) with new ids; the file is
kept in the scratch folder for the next run. Prints one JSON line with seconds and rows per second by phase.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from precinct.plans import aggregate_analysis, train_and_evaluate  # noqa: E402
from precinct.session import local_session  # noqa: E402
from precinct.sources import incidents, read_incidents_csv, write_csv  # noqa: E402


def main(scratch: str, algorithm: str = "lr", cores: str = "2", copies: str = "61") -> None:
    spark = local_session("full-size", cores, **{"spark.checkpoint.dir": str(Path(scratch).resolve())})
    path = Path(scratch) / f"incidents-{copies}"
    if not (path / "_SUCCESS").exists():
        base = incidents(spark, "/root/testdata/sf0.1")
        copy = F.explode(F.sequence(F.lit(0), F.lit(int(copies) - 1))).alias("copy")
        many = base.select("*", copy).repartition(32)
        many = many.withColumn("incident_number", F.col("incident_number") * 1000 + F.col("copy")).drop("copy")
        write_csv(many, str(path))
    size = sum(f.stat().st_size for f in path.glob("*.csv"))

    raw = read_incidents_csv(spark, str(path))
    start = time.time()
    aggregate_analysis(raw, 10).collect()
    weekly = time.time() - start
    summary = train_and_evaluate(spark, raw, tempfile.mkdtemp(prefix="out-", dir=scratch), algorithm, "csv").first()
    rows = {"feature_engineering_seconds": summary["records_total"], "fit_seconds": summary["train_rows"], "evaluate_seconds": summary["test_rows"]}
    timings = summary["timings_seconds"] | {"weekly_offenses_seconds": weekly}
    print(
        json.dumps(
            {
                "algorithm": algorithm,
                "cores": int(cores),
                "csv_bytes": size,
                "records_total": summary["records_total"],
                "records_processed": summary["records_processed"],
                "train_rows": summary["train_rows"],
                "test_rows": summary["test_rows"],
                "accuracy": summary["metrics"]["accuracy"],
                "f1": summary["metrics"]["f1"],
                "seconds": {k: round(v, 2) for k, v in timings.items()},
                "total_seconds": round(summary["total_runtime_seconds"], 2),
                "rows_per_second": {k: round(n / timings[k]) for k, n in rows.items()}
                | {"weekly_offenses_seconds": round(summary["records_total"] / weekly)},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
