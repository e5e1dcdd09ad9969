"""Small text helpers for file names, messages and control values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unpadded date-time format, staged-file prefixes and the tables they feed.
DATETIME_FORMAT = "d/M/y H:m:s"
HEADER_PREFIX = "headers-"
LEVEL_PREFIX = "records-"
STAGED_EXTENSION = "csv"
HEADER_ROUTE = "header"
LEVEL_ROUTE = "level"


def datetime_text(ts: Column) -> Column:
    """Day/month/year hour:minute:second without leading zeros."""
    return F.date_format(ts, DATETIME_FORMAT)


def double_quotes(message: Column) -> Column:
    """Single quotes doubled, for messages that end up in SQL text elsewhere."""
    return F.replace(message, F.lit("'"), F.lit("''"))


def field_text(df: DataFrame, name: str) -> Column:
    """Named column as text; NULL when the column is absent or holds NULL."""
    known = {c.lower() for c in df.columns}
    return (F.col(name).cast("string") if name.lower() in known else F.lit(None).cast("string"))


def file_stem(name: Column) -> Column:
    """File name up to its last dot."""
    return F.regexp_extract(name, r"(?s)^(.*)\.[^.]*$", 1)


def file_extension(name: Column) -> Column:
    """File name after its last dot."""
    return F.regexp_extract(name, r"(?s)^.*\.([^.]*)$", 1)


def staged_route(name: Column) -> Column:
    """Table that a staged file belongs to; NULL for files that are not ours."""
    is_csv = F.lower(file_extension(name)) == STAGED_EXTENSION
    return F.when(is_csv & name.startswith(HEADER_PREFIX), F.lit(HEADER_ROUTE)).when(
        is_csv & name.startswith(LEVEL_PREFIX), F.lit(LEVEL_ROUTE)
    )
