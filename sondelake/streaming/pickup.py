"""Incremental pickup: every inbox file is loaded exactly once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from sondelake.plans.ingest import ingest_records
from sondelake.plans.lake import Lake
from sondelake.sources.blocks import stream_records
from sondelake.sources.tables import path_exists


def _checkpoint_id(lake: Lake, checkpoint: str) -> str:
    """An id that is made with the checkpoint, kept inside it, and goes with it."""
    path = f"{checkpoint.rstrip('/')}/sondelake-id"
    if not path_exists(lake.spark, path):
        fresh = lake.spark.createDataFrame([(uuid.uuid4().hex[:12],)], "value string")
        fresh.coalesce(1).write.text(path)
    return lake.spark.read.text(path).head().value


def pickup(
    lake: Lake,
    inbox: str,
    checkpoint: str,
    *,
    load_prefix: str = "pickup-",
    max_files_per_batch: int | None = None,
) -> None:
    """Load all files that arrived since the last call with the same checkpoint, then stop.

    The checkpoint remembers which files were read. A micro-batch is one load named after its
    number and after the checkpoint's own id, so that loads of different checkpoints never meet; if it fails half-way, the next call repeats the same files under the same name and
    replaces what was written. Moving processed files away is optional housekeeping.
    """
    with lake.logged("pickup"):
        name = f"{load_prefix}{_checkpoint_id(lake, checkpoint)}-"

        def load(batch: DataFrame, number: int) -> None:
            ingest_records(lake, batch, f"{name}{number}")

        records = stream_records(lake.spark, inbox, max_files_per_batch=max_files_per_batch)
        query = (
            records.writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
