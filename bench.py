"""Headline timings: the pipeline's stages, then operators and reports on them.

Prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose the data and threads.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from tieout.plans import catalog, pipeline
from tieout.plans import workspace as ws
from tieout.session import run_folder
from tieout.sources.extracts import write_extract
from tieout.sources.lakehouse import Lakehouse

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "csv_roundtrip_gl",
    "check_unique",
    "annotate_gl",
    "annotate_ap",
    "rule_violation_counts",
    "recon_full_outer",
    "recon_classified",
    "status_counts",
    "quarantine_single_sided",
    "recon_summary",
    "recon_exceptions",
    "exception_rank",
    "dq_rule_scorecard",
    "tile_headline",
    "tile_top_exceptions",
    "tile_duplicates",
    "control_checks",
    "fate_vs_status",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = ws.workspace(spark, SF_DIR)
    seconds: dict[str, float] = {}

    frames = {name: work.source(name) for name in work.contract.datasets}
    from_files = Lakehouse(spark, root=run_folder(spark))
    paths = {name: f"{from_files.root}/extracts/{name}" for name in frames}
    for name, frame in frames.items():
        write_extract(frame, paths[name])
    seconds["stage_land_extracts"] = timed(lambda: pipeline.land_extracts(from_files, paths))
    seconds["stage_land"] = timed(
        lambda: pipeline.land_frames(work.lake, frames, SF_DIR, batch_id=ws.BATCH)
    )
    for stage in ("refine", "publish", "score"):
        seconds[f"stage_{stage}"] = timed(lambda: getattr(pipeline, stage)(work.lake))
    work.built("land", "refine", "publish", "score")

    queries = catalog.queries()
    for name in HEADLINE:
        seconds[name] = timed(
            lambda: queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        )
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "stages_and_headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else SF_DIR,
            }
        )
    )


if __name__ == "__main__":
    main()
