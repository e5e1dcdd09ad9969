"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"

_area: ContextVar[str | None] = ContextVar("scratch_area", default=None)


def _base(spark: SparkSession) -> str:
    """The shared folder of the session.

    Only a local session without the setting falls back to a temporary folder: on a cluster
    such a folder would exist on one machine only.
    """
    base = spark.conf.get(_CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="sondelake-")
        spark.conf.set(_CHECKPOINT_DIR, base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, inside the current `scratch_area` if there is one."""
    return f"{_area.get() or _base(spark)}/sondelake-{label}-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the files.

    This cuts the lineage, survives lost executors, and pins generated ids, which a second
    evaluation of the same plan would not be bound to repeat. Scratch tables hold most of what a run
    writes, so they are packed tighter than the session's tables.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_area(spark: SparkSession) -> Iterator[None]:
    """Collect the scratch tables written inside in one folder and delete it at the end.

    For runs that finish their own writes: no DataFrame made inside may be used afterwards.
    """
    folder = scratch_path(spark, "area")
    token = _area.set(folder)
    try:
        yield
    finally:
        _area.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
