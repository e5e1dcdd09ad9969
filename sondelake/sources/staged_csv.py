"""CSV staging files: one set for headers, one for levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondelake.functions.text import HEADER_PREFIX, LEVEL_PREFIX, STAGED_EXTENSION, file_stem
from sondelake.schemas import HEADER_SCHEMA, LEVEL_SCHEMA

_ENGINE_COLUMNS = ("header_id", "source_file")
_STEM = "source"


def _file_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in _ENGINE_COLUMNS])


def _any_of(prefix: str) -> str:
    """Names of staged files: those delivered under ``prefix``, and those `write_staged` makes."""
    extension = "".join(f"[{c}{c.upper()}]" for c in STAGED_EXTENSION)
    return f"{{{prefix}*,part-*}}.{extension}"


STAGED_HEADER_SCHEMA = _file_schema(HEADER_SCHEMA)
STAGED_LEVEL_SCHEMA = _file_schema(LEVEL_SCHEMA)


def write_staged(rows: DataFrame, schema: T.StructType, path: str, file_column: str) -> None:
    """Append decoded rows as CSV below ``path``, one folder per source file stem.

    Empty text is written as ``""`` and NULL as nothing, which keeps them apart; quotes inside
    text are escaped.
    """
    name = F.element_at(F.split(file_column, "/"), -1)
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], file_stem(name).alias(_STEM))
    typed.write.mode("append").partitionBy(_STEM).option("escape", '"').csv(path)


def _read(spark: SparkSession, path: str, schema: T.StructType, glob: str) -> DataFrame:
    rows = (
        spark.read.schema(schema)
        .option("pathGlobFilter", glob)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )
    # The reader cannot tell "" from nothing; text columns of a staged file are never NULL.
    return rows.select(
        *[
            F.coalesce(F.col(f.name), F.lit("")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in schema.fields
        ]
    )


def staged_rows(spark: SparkSession, path: str, table_schema: T.StructType, prefix: str) -> DataFrame:
    """Rows of staged files with their origin (file, block_start, seq), the text of a line that does
    not fit the schema in ``corrupt``, and the line as ``raw``.

    ``seq`` rises within a file; write the rows before using it twice.
    """
    schema = _file_schema(table_schema)
    rows = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField("corrupt", T.StringType())]))
        .option("pathGlobFilter", _any_of(prefix))
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", "corrupt")
        .csv(path)
    )
    columns = [
        F.coalesce(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in schema.fields
    ]
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("seq"),
        *columns,
        "corrupt",
        F.coalesce("corrupt", F.to_csv(F.struct(*schema.names))).alias("raw"),
    )


def read_staged_headers(spark: SparkSession, path: str, glob: str = _any_of(HEADER_PREFIX)) -> DataFrame:
    """Header rows of the staged files below ``path`` whose name fits ``glob``."""
    return _read(spark, path, STAGED_HEADER_SCHEMA, glob)


def read_staged_levels(spark: SparkSession, path: str, glob: str = _any_of(LEVEL_PREFIX)) -> DataFrame:
    """Level rows of the staged files below ``path`` whose name fits ``glob``."""
    return _read(spark, path, STAGED_LEVEL_SCHEMA, glob)
