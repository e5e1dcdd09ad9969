"""Parquet tables filled one load at a time."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_COLUMN = "load_id"

_LOAD_NAME = re.compile(r"[A-Za-z0-9_.\-]+")


def _located(spark: SparkSession, path: str) -> tuple:
    """The file system that holds ``path``, and the path as it takes it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), there


def path_exists(spark: SparkSession, path: str) -> bool:
    system, there = _located(spark, path)
    return system.exists(there)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; nothing happens if it is not there."""
    system, there = _located(spark, path)
    system.delete(there, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if it is not there."""
    system, there = _located(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(there)) if system.exists(there) else []


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    system, there = _located(spark, path)
    stream = system.open(there)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_small(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its text, or return False if there is one already.

    The text is written beside and gets its name in one step, so of several writers exactly one
    succeeds and no reader sees a part of it. That step is a hard link on a local file system and a
    rename elsewhere, which must refuse an existing target, as HDFS does.
    """
    system, there = _located(spark, path)
    system.mkdirs(there.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(there.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if system.getUri().getScheme() != "file":
            return not system.exists(there) and system.rename(draft, there)
        os.link(draft.toUri().getPath(), there.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        system.delete(draft, False)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet files at ``path``; no rows if nothing has been written there yet."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


class LoadTable:
    """A Parquet table with one folder per load.

    Writing a load replaces that load's own folder and nothing else, so a load can be retried
    any number of times with the same result.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, beside: T.StructType | None = None
    ):
        """``beside`` are columns that a load may write as well; `read` leaves them out."""
        self.spark = spark
        self.path = path
        self.schema = schema
        self.beside = beside or T.StructType([])

    def read(self, *, beside: bool = False) -> DataFrame:
        fields = [*self.schema.fields, *(self.beside.fields if beside else [])]
        schema = T.StructType([*fields, T.StructField(LOAD_COLUMN, T.StringType())])
        return read_or_empty(self.spark, self.path, schema)

    def read_load(self, load_id: str) -> DataFrame:
        return self.read().where(F.col(LOAD_COLUMN) == load_id)

    def read_other_loads(self, load_id: str) -> DataFrame:
        return self.read().where(F.col(LOAD_COLUMN) != load_id)

    def write_load(self, rows: DataFrame, load_id: str) -> None:
        if not _LOAD_NAME.fullmatch(load_id):
            raise ValueError(f"load id {load_id!r} cannot be used as a folder name")
        given = [f for f in self.beside.fields if f.name in rows.columns]
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in (*self.schema.fields, *given)])
        typed.write.mode("overwrite").parquet(f"{self.path}/{LOAD_COLUMN}={load_id}")


    def drop_load(self, load_id: str) -> None:
        delete_path(self.spark, f"{self.path}/{LOAD_COLUMN}={load_id}")


def append_rows(rows: DataFrame, path: str) -> None:
    """Append to a plain Parquet table, such as the error log."""
    rows.write.mode("append").parquet(path)


def save_bucketed(rows: DataFrame, table: str, buckets: int, key: str = "uid") -> None:
    """Append to a catalog table bucketed by ``key``.

    Header and level tables saved with the same number of buckets join on the key without a
    shuffle; use it where a shared catalog is available and full loads are frequent.
    """
    rows.write.mode("append").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
