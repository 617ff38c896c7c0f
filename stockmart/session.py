"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library expects from any cluster it runs on. Spark decides on broadcasts by
# measured size and splits hot shuffle partitions at run time; nothing here depends on the data.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Building a plan records a call site per column otherwise, which doubles the time it takes.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "stockmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the recommended settings; ``conf`` entries win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written in here go when its write ends.

    Otherwise they stay on the executors' disks until the driver happens to collect its garbage.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def work_dir(spark: SparkSession, default: str) -> str:
    """Folder for intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset, ``default`` is
    used; callers pass a folder next to the table they write, which is shared storage as well.
    """
    return spark.conf.get("spark.checkpoint.dir", None) or default


def session_dir(spark: SparkSession) -> str:
    """Shared folder for tables that live as long as the session.

    Where the cluster names no folder, only a local session may fall back to a temporary one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named}/stockmart-{spark.sparkContext.applicationId}"
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="stockmart-")
    spark.conf.set("spark.checkpoint.dir", made)
    return f"{made}/stockmart-{spark.sparkContext.applicationId}"
