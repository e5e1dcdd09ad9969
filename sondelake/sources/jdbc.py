"""Database tables as sources and sinks, through Spark's JDBC connector."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sondelake.schemas import PUBLISHED_HEADER_COLUMNS, PUBLISHED_LEVEL_COLUMNS


@dataclass(frozen=True)
class ReadRange:
    """Split of a read into ``partitions`` queries over an integer column."""

    column: str
    lower: int
    upper: int
    partitions: int


def subquery(sql: str, alias: str) -> str:
    """A query in the form that the connector accepts in place of a table name."""
    return f"({sql}) {alias}"


def read_query(
    spark: SparkSession,
    url: str,
    sql: str,
    alias: str,
    properties: Mapping[str, str],
    split: ReadRange | None = None,
) -> DataFrame:
    """Rows of a query that the database itself evaluates, optionally read in parallel."""
    table = subquery(sql, alias)
    if split is None:
        return spark.read.jdbc(url, table, properties=dict(properties))
    return spark.read.jdbc(
        url,
        table,
        column=split.column,
        lowerBound=split.lower,
        upperBound=split.upper,
        numPartitions=split.partitions,
        properties=dict(properties),
    )


def quoted(name: str) -> str:
    """Identifier in double quotes: databases fold unquoted names to different cases."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


def control_sql(table: str, etl_name: str) -> str:
    name = etl_name.replace("'", "''")
    return (
        f"SELECT * FROM {quoted(table)} "
        f"WHERE {quoted('etl_name')} = '{name}' AND {quoted('skip_execution')} <> 'Y'"
    )


def max_header_sql(header_table: str) -> str:
    return f"SELECT max({quoted('header_id')}) AS {quoted('max_head')} FROM {quoted(header_table)}"


def published_sql(header_table: str, level_table: str, hi: int, lo: int | None, inclusive: bool) -> str:
    """Join of both tables inside the database, with the header id kept to split the read by."""
    names = [f"h.{c}" for c in PUBLISHED_HEADER_COLUMNS] + [f"l.{c}" for c in PUBLISHED_LEVEL_COLUMNS]
    header_id = quoted("h.header_id")
    sql = (
        f"SELECT {header_id}, {', '.join(map(quoted, names))} FROM {quoted(header_table)} {quoted('h')} "
        f"JOIN {quoted(level_table)} {quoted('l')} ON {quoted('h.uid')} = {quoted('l.uid')} "
        f"WHERE {header_id} <= {int(hi)}"
    )
    if lo is None:
        return sql
    return f"{sql} AND {header_id} {'>=' if inclusive else '>'} {int(lo)}"


def read_published(
    spark: SparkSession,
    url: str,
    header_table: str,
    level_table: str,
    properties: Mapping[str, str],
    hi: int,
    lo: int | None = None,
    *,
    inclusive: bool = False,
    partitions: int = 32,
) -> DataFrame:
    """Published columns of an id range, joined by the database and read in id slices."""
    rows = read_query(
        spark,
        url,
        published_sql(header_table, level_table, hi, lo, inclusive),
        "published",
        properties,
        ReadRange("header_id", lo or 0, hi + 1, partitions),
    )
    return rows.drop("header_id")


def append_table(rows: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    """Append rows to a database table; each partition is one connection and transaction."""
    rows.write.jdbc(url, table, mode="append", properties=dict(properties))
