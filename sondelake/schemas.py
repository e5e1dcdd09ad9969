"""Declared table schemas. Nothing in the engine infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

from sondelake.functions.layout import HEADER_LAYOUT, LEVEL_LAYOUT, Layout


def _decoded_fields(layout: Layout) -> list[T.StructField]:
    return [
        T.StructField(f.name.lower(), T.StringType() if f.is_text else T.IntegerType())
        for f in layout.ordered
    ]


_KEY_AND_SOURCE = [T.StructField("uid", T.StringType()), T.StructField("source_file", T.StringType())]


def header_schema(layout: Layout = HEADER_LAYOUT) -> T.StructType:
    """Rows of the header table as a load writes them; ``header_id`` rises in load order."""
    return T.StructType(
        [T.StructField("header_id", T.LongType()), *_decoded_fields(layout), *_KEY_AND_SOURCE]
    )


def level_schema(layout: Layout = LEVEL_LAYOUT) -> T.StructType:
    """Rows of the level table. ``uid`` points at the header the level belongs to."""
    return T.StructType([*_decoded_fields(layout), *_KEY_AND_SOURCE])


HEADER_SCHEMA = header_schema()
LEVEL_SCHEMA = level_schema()

#: One row per publishing job: what to load next and how far the last run came.
CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("etl_name", T.StringType()),
        T.StructField("skip_execution", T.StringType()),
        T.StructField("full_load", T.StringType()),
        T.StructField("run_date", T.TimestampType()),
        T.StructField("filter_col1_name", T.StringType()),
        T.StructField("filter_col1_value", T.StringType()),
        T.StructField("filter_col2_name", T.StringType()),
        T.StructField("filter_col2_value", T.StringType()),
    ]
)

ERROR_SCHEMA = T.StructType(
    [
        T.StructField("date_time", T.TimestampType()),
        T.StructField("etl_name", T.StringType()),
        T.StructField("client_name", T.StringType()),
        T.StructField("exception_message", T.StringType()),
    ]
)

#: Input that a load refused, with the raw text so that it can be repaired and replayed.
QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("block_start", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("uid", T.StringType()),
        T.StructField("scope", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("blocks", T.LongType()),
        T.StructField("headers", T.LongType()),
        T.StructField("levels", T.LongType()),
    ]
)

#: Files that a load in slices is to load.
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("slice", T.IntegerType()),
        T.StructField("file", T.StringType()),
        T.StructField("length", T.LongType()),
    ]
)

#: One row per load: the ids of its headers, and whether its levels carry the columns of their headers.
RANGE_SCHEMA = T.StructType(
    [
        T.StructField("first_id", T.LongType()),
        T.StructField("last_id", T.LongType()),
        T.StructField("colocated", T.BooleanType()),
    ]
)

#: Per load and part of its uids: smallest and largest rest of the uid.
UID_SCHEMA = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("low", T.StringType()),
        T.StructField("high", T.StringType()),
    ]
)

# Declared column widths, NOT NULL columns of the tables.
HEADER_TEXT_WIDTHS = {"id": 12, "p_src": 10, "np_src": 10, "uid": 60}
LEVEL_TEXT_WIDTHS = {"pflag": 3, "zflag": 3, "tflag": 3, "uid": 60}
CONTROL_TEXT_WIDTHS = {
    "etl_name": 60,
    "skip_execution": 1,
    "full_load": 1,
    "filter_col1_name": 100,
    "filter_col1_value": 1000,
    "filter_col2_name": 100,
    "filter_col2_value": 1000,
}
HEADER_NOT_NULL = ("id", "year", "month", "day", "hour", "reltime", "uid")
LEVEL_NOT_NULL = ("uid",)
CONTROL_NOT_NULL = ("etl_name", "skip_execution", "full_load")

# The published columns, in order.
PUBLISHED_HEADER_COLUMNS = (
    "id", "year", "month", "day", "hour", "reltime", "numlev", "p_src", "np_src", "lat", "lon",
)
PUBLISHED_LEVEL_COLUMNS = (
    "lvltyp1", "lvltyp2", "etime", "press", "pflag", "gph", "zflag", "temp", "tflag",
    "rh", "dpdp", "wdir", "wspd",
)
PUBLISHED_COLUMNS = PUBLISHED_HEADER_COLUMNS + PUBLISHED_LEVEL_COLUMNS


def beside_schema(header_layout: Layout = HEADER_LAYOUT, level_layout: Layout = LEVEL_LAYOUT) -> T.StructType:
    """Published header columns that levels can carry: all of them, or none if names clash."""
    fields = {f.name: f for f in header_schema(header_layout).fields}
    taken = {f.name for f in level_schema(level_layout).fields}
    wanted = [fields.get(c) for c in PUBLISHED_HEADER_COLUMNS]
    fits = all(f is not None and f.name not in taken for f in wanted)
    return T.StructType(wanted if fits else [])


def seed_control(spark, etl_name: str):
    """First control row of a new job: not skipped, full load, ranged by header id."""
    from pyspark.sql import functions as F

    # Flags and range column of a first control row.
    row = (1, etl_name, "N", "Y", None, "HEADER_ID", None, None, None)
    return spark.createDataFrame([row], CONTROL_SCHEMA).withColumn(
        "run_date", F.current_timestamp()
    )
