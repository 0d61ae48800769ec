"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

ENGINE = {
    # Extract timestamps are written in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Generated methods beyond this are not compiled by HotSpot.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Detail rows are written by status; six open writers spare a sort.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}
CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def build_session(app_name: str = "tieout", **config: str) -> SparkSession:
    """A session with the engine's settings and those given.

    On an active session all are applied, too; one that cannot change any more
    and differs raises.
    """
    wanted = ENGINE | {key.replace("__", "."): str(value) for key, value in config.items()}
    active = SparkSession.getActiveSession()
    if active is None:
        return SparkSession.builder.appName(app_name).config(map=wanted).getOrCreate()
    fixed = {k: v for k, v in wanted.items() if not active.conf.isModifiable(k)}
    differing = {k: v for k, v in fixed.items() if active.conf.get(k, None) != v}
    if differing:
        raise ValueError(f"the running session cannot take {differing}")
    for key in wanted.keys() - fixed.keys():
        active.conf.set(key, wanted[key])
    return active


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for an input of this size, to pass to `build_session`.

    About a quarter of a ledger row is shuffled: key, amount and period. Shuffle
    partitions hold 256 MB whatever the input, and AQE merges what turns out small.
    Splits are 128 MB up to 6 TB and then grow, so that there are 50,000 of them.
    """
    mb = 1 << 20
    partitions = -(-input_bytes // (4 * 256 * mb))
    split = max(input_bytes // 50_000, 128 * mb)
    return {
        "spark__sql__shuffle__partitions": str(max(2 * cores, partitions)),
        "spark__sql__files__maxPartitionBytes": str(split),
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": str(256 * mb),
    }


def together(*jobs: Callable[[], object]) -> list:
    """Run independent Spark jobs at once, so that one's last tasks leave no core idle."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can read.

    A cluster names it in spark.checkpoint.dir. Only a local session may go
    without: there driver and executors share one disk.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tieout-")
    return _local_folders[app]


def run_folder(spark: SparkSession) -> str:
    """A fresh folder under the shared one."""
    return f"{shared_folder(spark)}/tieout-{uuid.uuid4().hex}"
