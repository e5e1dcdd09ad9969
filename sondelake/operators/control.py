"""The control table: which job runs, in which mode, and how far it has come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondelake.schemas import CONTROL_SCHEMA
from sondelake.sources.tables import delete_path, read_or_empty

# Flags and range column understood in a control row.
SKIP = "Y"
FULL = "Y"
NOT_FULL = "N"
RANGE_COLUMN = "HEADER_ID"

FULL_MODE = "full"
DELTA_MODE = "delta"
INVALID_MODE = "invalid"

_VERSION = "version"
#: Versions kept, for readers that are still at an older one and for looking back.
KEPT_VERSIONS = 20


def runnable(control: DataFrame, etl_name: str) -> DataFrame:
    """Rows of one job that are not to be skipped; a NULL flag also keeps a row from running."""
    return control.where((F.col("etl_name") == etl_name) & (F.col("skip_execution") != SKIP))


def first_row(rows: DataFrame, key: str = "id") -> DataFrame:
    """The row with the smallest key; at most one row."""
    return rows.orderBy(key).limit(1)


def load_mode() -> Column:
    """Load mode of a control row.

    Full when asked for, or when no last id is known yet; otherwise a delta, provided that the
    range column is one we can filter by.
    """
    wants_full = F.coalesce(F.upper("full_load") == FULL, F.lit(False))
    by_id = F.coalesce(F.upper("filter_col1_name") == RANGE_COLUMN, F.lit(False))
    return (
        F.when(wants_full, F.lit(FULL_MODE))
        .when(by_id & F.col("filter_col1_value").isNull(), F.lit(FULL_MODE))
        .when(by_id, F.lit(DELTA_MODE))
        .otherwise(F.lit(INVALID_MODE))
    )


def advanced(control: DataFrame, row_id: int, max_id: Column | int) -> DataFrame:
    """Control rows after a run of ``row_id`` that published up to ``max_id``."""
    this = F.col("id") == row_id
    mark = (F.lit(max_id) if isinstance(max_id, int) else max_id).cast("string")

    def set_to(column: str, new: Column) -> Column:
        return F.when(this, new).otherwise(F.col(column)).alias(column)

    changes = {
        "run_date": F.current_timestamp(),
        "filter_col1_value": mark,
        "full_load": F.lit(NOT_FULL),
    }
    return control.select(
        *[set_to(c, changes[c]) if c in changes else F.col(c) for c in control.columns]
    )


class ControlTable:
    """Control rows kept as numbered versions of a small Parquet table.

    A change writes the next version beside the old ones, and readers take the newest, so an
    interrupted change leaves the previous state in force.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _versions(self) -> DataFrame:
        schema = T.StructType([*CONTROL_SCHEMA.fields, T.StructField(_VERSION, T.LongType())])
        return read_or_empty(self.spark, self.path, schema)

    def version(self) -> int:
        """Number of the newest version; 0 if the table does not exist yet."""
        return self._versions().agg(F.max(_VERSION)).head()[0] or 0

    def rows(self) -> DataFrame:
        newest = self.version()
        return self._versions().where(F.col(_VERSION) == newest).drop(_VERSION)

    def replace(self, rows: DataFrame) -> None:
        """Make ``rows`` the next version. Fails if another run has already written it."""
        target = f"{self.path}/{_VERSION}={self.version() + 1}"
        # One row per job: a single small file, committed with one rename.
        rows.coalesce(1).write.mode("errorifexists").parquet(target)
        delete_path(self.spark, f"{self.path}/{_VERSION}={self.version() - KEPT_VERSIONS}")

    def current(self, etl_name: str) -> Row | None:
        """The job's control row with its load mode, or None if the job must not run."""
        chosen = first_row(runnable(self.rows(), etl_name))
        return chosen.withColumn("load_mode", load_mode()).head()

    def advance(self, row_id: int, max_id: int) -> None:
        self.replace(advanced(self.rows(), row_id, max_id))
