"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "tidepanel") -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", "/tmp/checkpoints")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``, or below the
    warehouse where that is unset. Every executor sees both; the caller's session owns
    the folder and its cleaning."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df, label: str = "stage"):
    """Cut lineage by a written table in the shared folder; survives lost executors."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def at_once(spark: SparkSession, jobs: Sequence[Callable[[], object]], slots: int = 4) -> list:
    """Results of ``jobs`` in their order, ``slots`` of them at a time.

    For work that the driver leads step by step, such as fits. Each runs in a thread with the
    caller's job properties; where the session schedules fairly and the caller has no pool, the
    slots have one each, so a small job does not wait for the tasks of a large one.
    """
    context = spark.sparkContext
    own = context.getLocalProperty("spark.scheduler.pool") is None

    def led(i: int):
        if own:
            context.setLocalProperty("spark.scheduler.pool", f"at-once-{i % slots}")
        return jobs[i]()

    with ThreadPoolExecutor(slots) as threads:
        running = [threads.submit(inheritable_thread_target(spark)(led), i) for i in range(len(jobs))]
        return [r.result() for r in running]
