"""The published dataset: Parquet, one folder per altitude band."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondelake.functions.bands import PARTITION_COLUMN
from sondelake.functions.layout import HEADER_LAYOUT, LEVEL_LAYOUT
from sondelake.schemas import PUBLISHED_COLUMNS
from sondelake.sources.tables import create_small, delete_path, folder_names, read_or_empty, read_small

RUN_COLUMN = "from_id"
_POINTER = "current"
#: Folder of a dataset's log; Spark does not take names with this first character for data.
_LOG = "_runs"
_SEALED = "sealed"
_POINTER_SCHEMA = T.StructType(
    [T.StructField("folder", T.StringType()), T.StructField("version", T.LongType())]
)

_TEXT = {f.name.lower() for f in (*HEADER_LAYOUT.fields, *LEVEL_LAYOUT.fields) if f.is_text}
PUBLISHED_SCHEMA = T.StructType(
    [
        T.StructField(c, T.StringType() if c in _TEXT else T.IntegerType())
        for c in PUBLISHED_COLUMNS
    ]
)


def rebalanced(rows: DataFrame, partition_column: str = PARTITION_COLUMN) -> DataFrame:
    """Bring the rows of a band together in evenly sized tasks before a partitioned write.

    Adaptive execution merges small bands' tasks and cuts large bands into several, so a band
    gets as many files as its size asks for and no file is shared between bands.
    """
    return rows.hint("rebalance", partition_column)


def write_banded(
    rows: DataFrame, path: str, *, mode: str = "errorifexists", partition_column: str = PARTITION_COLUMN
) -> None:
    """Write Parquet partitioned by band; by default an existing target is an error."""
    rebalanced(rows, partition_column).write.mode(mode).partitionBy(partition_column).parquet(path)


def _versions(spark: SparkSession, root: str) -> list[Row]:
    """Folders of the full runs still kept, newest first; never more than three."""
    kept = read_or_empty(spark, f"{root}/{_POINTER}", _POINTER_SCHEMA)
    return kept.orderBy(F.desc("version")).collect()


def current_folder(spark: SparkSession, root: str) -> str:
    """Folder of the newest complete full run; ``root`` itself if no run was written there."""
    newest = _versions(spark, root)[:1]
    return f"{root}/{newest[0].folder}" if newest else root


@dataclass(frozen=True)
class Run:
    """A finished run: the folder it wrote, and the ids above ``after`` up to ``up_to`` that it holds.

    ``inclusive`` says that it also repeats the rows of ``after``. Without ``up_to`` (data older than
    the log) it is not known which ids the folder holds.
    """

    folder: str
    after: int
    up_to: int | None
    inclusive: bool = False


class RunLog:
    """What the runs of one dataset folder have written, one small numbered file per run.

    A number is given to one run only, so of two runs at once one comes second and sees what the
    first has written. Only folders named in the log are read: an unfinished run leaves no rows.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.path = f"{folder}/{_LOG}"

    def entries(self) -> list[dict]:
        names = [n for n in folder_names(self.spark, self.path) if n.endswith(".json") and not n.startswith(".")]
        return [json.loads(read_small(self.spark, f"{self.path}/{name}")) for name in names]

    def runs(self) -> list[Run]:
        return [Run(**entry) for entry in self.entries() if _SEALED not in entry]

    def _add(self, number: int, entry: dict) -> bool:
        return create_small(self.spark, f"{self.path}/{number:012d}.json", json.dumps(entry))

    def adopt(self) -> None:
        """Enter folders that were written before there was a log."""
        if not self.entries():
            for number, name in enumerate(n for n in folder_names(self.spark, self.folder) if n.startswith(f"{RUN_COLUMN}=")):
                self._add(number, asdict(Run(name, -1, None)))

    def commit(self, run: Run) -> None:
        """Enter a run, or raise if another one has meanwhile published any of its ids."""
        while True:
            entries = self.entries()
            if any(_SEALED in entry for entry in entries):
                raise Conflict("a full run is replacing the dataset, or died at it; repeat this run after a full one")
            others = [Run(**entry) for entry in entries]
            if any(o.up_to is not None and max(o.after, run.after) < min(o.up_to, run.up_to) for o in others):
                raise Conflict(f"ids in ({run.after}, {run.up_to}] were published meanwhile")
            if self._add(len(entries), asdict(run)):
                return

    def seal(self) -> list[Run]:
        """Let no run in any more; returns those that came in."""
        while not any(_SEALED in entry for entry in self.entries()):
            self._add(len(self.entries()), {_SEALED: True})
        return self.runs()


class Conflict(RuntimeError):
    """Another run was faster; look again at what is left to publish."""


def unpublished(runs: Sequence[Run], lo: int, hi: int) -> list[tuple[int, int]]:
    """The parts of the ids above ``lo`` up to ``hi`` that no run holds, as (after, up to)."""
    gaps, at = [], lo
    for run in sorted((r for r in runs if r.up_to is not None), key=lambda r: r.after):
        if run.after > at and at < hi:
            gaps.append((at, min(run.after, hi)))
        at = max(at, run.up_to)
    return [*gaps, (at, hi)] if at < hi else gaps


def published_runs(spark: SparkSession, root: str) -> list[Run]:
    """The runs that make up the dataset."""
    log = RunLog(spark, current_folder(spark, root))
    log.adopt()
    return log.runs()


def _write_full(rows: DataFrame, root: str, up_to: int | None, late: Callable[[int, int], DataFrame] | None) -> None:
    """Write a new folder beside the current one, then point to it.

    Readers see the old rows until the new ones are complete. The folder before stays for
    readers that are still at it, older ones go. Ids that deltas have published in the old folder
    while the new one was written come from ``late`` (after, up to), so none is lost.
    """
    spark = rows.sparkSession
    before = _versions(spark, root)
    folder = f"run-{uuid.uuid4().hex}"
    log = RunLog(spark, f"{root}/{folder}")
    try:
        first = _write_folder(rows, log.folder, 0)
        log.commit(Run(first, -1, up_to if up_to is not None else -1))
        old = RunLog(spark, current_folder(spark, root)).seal() if before else []
        for run in old:
            if late and up_to is not None and run.up_to is not None and run.up_to > up_to:
                start = max(run.after, up_to)
                log.commit(Run(_write_folder(late(start, run.up_to), log.folder, start), start, run.up_to))
    except Exception:
        delete_path(spark, log.folder)
        raise
    version = before[0].version + 1 if before else 1
    pointer = spark.createDataFrame([(folder,)], "folder string").coalesce(1)
    pointer.write.parquet(f"{root}/{_POINTER}/version={version}")
    for gone in before[1:]:
        delete_path(spark, f"{root}/{_POINTER}/version={gone.version}")
        delete_path(spark, f"{root}/{gone.folder}")


def _write_folder(rows: DataFrame, folder: str, after: int) -> str:
    """Write rows below a name of their own in ``folder``; returns the name."""
    name = f"{RUN_COLUMN}={after}-{uuid.uuid4().hex[:12]}"
    write_banded(rows, f"{folder}/{name}")
    return name


def write_run(
    rows: DataFrame,
    root: str,
    from_id: int | None,
    up_to: int | None = None,
    inclusive: bool = False,
    late: Callable[[int, int], DataFrame] | None = None,
) -> None:
    """Write one publishing run below ``root``.

    A full run (``from_id`` None) replaces the dataset once it is complete. A delta run adds the rows
    of the ids above ``from_id`` up to ``up_to`` and raises `Conflict`, leaving no rows, if another run
    holds any of them by then.
    """
    if from_id is None:
        _write_full(rows, root, up_to, late)
        return
    spark = rows.sparkSession
    log = RunLog(spark, current_folder(spark, root))
    log.adopt()
    name = _write_folder(rows, log.folder, from_id)
    try:
        log.commit(Run(name, from_id, up_to if up_to is not None else from_id, inclusive))
    except Exception:
        delete_path(spark, f"{log.folder}/{name}")
        raise


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """Published columns and the band; a filter on the band reads only its folders."""
    schema = T.StructType(
        [
            *PUBLISHED_SCHEMA.fields,
            T.StructField(RUN_COLUMN, T.StringType()),
            T.StructField(PARTITION_COLUMN, T.IntegerType()),
        ]
    )
    folder = current_folder(spark, root)
    runs = RunLog(spark, folder).runs()
    if not runs:  # written before there was a log, or by `write_banded` alone
        return read_or_empty(spark, folder, schema).drop(RUN_COLUMN)
    paths = [f"{folder}/{run.folder}" for run in runs]
    return spark.read.schema(schema).option("basePath", folder).parquet(*paths).drop(RUN_COLUMN)
