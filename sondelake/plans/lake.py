"""Where the tables of one installation live."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondelake.functions.layout import HEADER_LAYOUT, LEVEL_LAYOUT, Layout
from sondelake.operators.control import ControlTable
from sondelake.schemas import (
    ERROR_SCHEMA,
    LEDGER_SCHEMA,
    MANIFEST_SCHEMA,
    QUARANTINE_SCHEMA,
    RANGE_SCHEMA,
    UID_SCHEMA,
    beside_schema,
    header_schema,
    level_schema,
)
from sondelake.sources.tables import (
    LoadTable,
    append_rows,
    create_small,
    delete_path,
    path_exists,
    read_or_empty,
    read_small,
)

_BY_FILE, _BY_BLOCK = "whole files", "blocks"
#: Lakes that a load of this process writes to: its place is not that of a dead one.
_writing: set[str] = set()


class Lake:
    """Tables below one root folder.

    ``whole_files`` selects the file-at-a-time rules for bad input (see `plans.ingest`). In
    that mode a load may hold levels whose header came with another load, so readers join on
    the uid alone; otherwise a level and its header always share their load. The first load
    writes the choice into the lake, and a lake opened with the other one is refused.

    The layouts say how lines are decoded and which columns the tables have; by default they are
    the built-in ones, and `functions.layout.load_layout` reads others.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        whole_files: bool = False,
        header_layout: Layout = HEADER_LAYOUT,
        level_layout: Layout = LEVEL_LAYOUT,
    ):
        root = root.rstrip("/")
        self.spark = spark
        self.whole_files = whole_files
        self.header_layout = header_layout
        self.level_layout = level_layout
        self.headers = LoadTable(spark, f"{root}/headers", header_schema(header_layout))
        beside = None if whole_files else beside_schema(header_layout, level_layout)
        self.levels = LoadTable(spark, f"{root}/levels", level_schema(level_layout), beside)
        self.ranges = LoadTable(spark, f"{root}/ranges", RANGE_SCHEMA)
        self.uid_parts = LoadTable(spark, f"{root}/uid_parts", UID_SCHEMA)
        self.quarantine = LoadTable(spark, f"{root}/quarantine", QUARANTINE_SCHEMA)
        self.ledger = LoadTable(spark, f"{root}/ledger", LEDGER_SCHEMA)
        self.manifest = LoadTable(spark, f"{root}/manifest", MANIFEST_SCHEMA)
        self.control = ControlTable(spark, f"{root}/control")
        self.errors_path = f"{root}/errors"
        self.published_path = f"{root}/published"
        self._rules_path = f"{root}/rules"
        self._writer_path = f"{root}/writer"

    def check_rules(self, *, keep: bool = False) -> None:
        """Raise if the lake was filled under other rules; with ``keep``, write down those of a new one."""
        own = _BY_FILE if self.whole_files else _BY_BLOCK
        if path_exists(self.spark, self._rules_path):
            kept = self.spark.read.text(self._rules_path).head().value
            if kept != own:
                raise ValueError(f"this lake is loaded by {kept}, not by {own}")
        elif keep:
            rules = self.spark.createDataFrame([(own,)], "value string")
            rules.coalesce(1).write.text(self._rules_path)

    @contextmanager
    def writing(self, load_id: str) -> Iterator[None]:
        """Be the only load of this lake, or raise.

        Ids go on from the highest and uids are checked against what is there, so two loads at once
        would not see each other. A load that died keeps its place; repeat it under its own id, or give it
        up with `release`.
        """
        if self._writer_path in _writing:
            raise RuntimeError("another load of this session is running in this lake")
        if not create_small(self.spark, self._writer_path, load_id):
            other = self.writer()
            if other != load_id:
                raise RuntimeError(f"load {other!r} is running or has died; finish it or release the lake first")
        _writing.add(self._writer_path)
        try:
            yield
        finally:
            _writing.discard(self._writer_path)
            self.release()

    def writer(self) -> str | None:
        """Id of the load that is running, or died while it ran."""
        return read_small(self.spark, self._writer_path) if path_exists(self.spark, self._writer_path) else None

    def release(self) -> None:
        """Let other loads in."""
        delete_path(self.spark, self._writer_path)

    @contextmanager
    def logged(self, step: str) -> Iterator[None]:
        """Write any error to the error log before it goes on."""
        try:
            yield
        except Exception as error:
            self.log_error(step, error)
            raise

    def errors(self) -> DataFrame:
        return read_or_empty(self.spark, self.errors_path, ERROR_SCHEMA)

    def log_errors(self, rows: DataFrame) -> None:
        """Append rows of etl_name, client_name and exception_message to the error log, dated now."""
        dated = rows.withColumn("date_time", F.current_timestamp()).select(*ERROR_SCHEMA.names)
        append_rows(dated, self.errors_path)

    def log_error(self, step: str, error: Exception, client: str = "") -> None:
        """Append one row to the error log."""
        columns = "etl_name string, client_name string, exception_message string"
        self.log_errors(self.spark.createDataFrame([(step, client, str(error))], columns).coalesce(1))
