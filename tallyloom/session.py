"""Spark session and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings that hold from a laptop to a large cluster. Partition counts are left to AQE:
# it merges small shuffle partitions and splits skewed ones at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used in local mode only; on a cluster
    a machine-local folder would lose data with its executor, so it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_dir(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _local_dir(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"tallyloom-{application_id}-")


def run_together(spark: SparkSession, jobs: Iterable[Callable[[], object]], concurrency: int) -> None:
    """Run independent Spark jobs some at a time; the first failure is raised.

    The wide stage of one job uses the executors that the short tail of another leaves idle.
    """
    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        for running in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            running.result()
