"""Session for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}
_runs: list[str] = []


def local_session(cores: str = "8", app: str = "tickmart") -> SparkSession:
    """A local session; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TICKMART_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    folder of its own; on a cluster a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_scratch.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="tickmart-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    inside = _runs[-1] if _runs else f"{scratch_root(spark)}/tickmart"
    return f"{inside}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is materialized inside is deleted at the end: for runs that leave nothing but tables. One
    run at a time, as there is one writer."""
    folder = f"{scratch_root(spark)}/tickmart/run-{uuid.uuid4().hex}"
    _runs.append(folder)
    try:
        yield
    finally:
        _runs.remove(folder)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once and read back: cuts lineage, and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
