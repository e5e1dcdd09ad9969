"""Fixed-width layouts: which characters of a line hold which column."""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_TEXT_TYPE = "character"


class Field(NamedTuple):
    """One column; ``start`` and ``end`` are 1-based and inclusive."""

    name: str
    start: int
    end: int
    type: str
    order: int

    @property
    def is_text(self) -> bool:
        # Whatever is not declared as text is a number, misspelt type names included.
        return self.type.lower() == _TEXT_TYPE

    @property
    def length(self) -> int:
        return self.end - self.start + 1


@dataclass(frozen=True)
class Layout:
    """A record layout: its fields, the exact line width, and which columns form the key."""

    fields: tuple[Field, ...]
    width: int
    key_pattern: str = ""
    count_pattern: str = ""

    @property
    def ordered(self) -> tuple[Field, ...]:
        return tuple(sorted(self.fields, key=lambda f: f.order))

    def matching(self, pattern: str) -> tuple[Field, ...]:
        """Fields whose whole name matches ``pattern``, in column order."""
        return tuple(f for f in self.ordered if pattern and re.fullmatch(pattern, f.name))

    @property
    def key_fields(self) -> tuple[Field, ...]:
        return self.matching(self.key_pattern)

    @property
    def count_field(self) -> Field:
        return self.matching(self.count_pattern)[0]


# Line widths, key columns, level-count column and field positions
# of the sounding format.
HEADER_WIDTH = 71
LEVEL_WIDTH = 52
KEY_PATTERN = "ID|YEAR|MONTH|DAY|HOUR|RELTIME"
COUNT_PATTERN = "NUMLEV"
HEADER_FIELDS = (
    Field("ID", 2, 12, "Character", 1),
    Field("YEAR", 14, 17, "Integer", 2),
    Field("MONTH", 19, 20, "Integer", 3),
    Field("DAY", 22, 23, "Integer", 4),
    Field("HOUR", 25, 26, "Integer", 5),
    Field("RELTIME", 28, 31, "Integer", 6),
    Field("NUMLEV", 33, 36, "Integer", 7),
    Field("P_SRC", 38, 45, "Character", 8),
    Field("NP_SRC", 47, 54, "Character", 9),
    Field("LAT", 56, 62, "Integer", 10),
    Field("LON", 64, 71, "Integer", 11),
)
LEVEL_FIELDS = (
    Field("LVLTYP1", 1, 1, "Integer", 1),
    Field("LVLTYP2", 2, 2, "Integer", 2),
    Field("ETIME", 4, 8, "Integer", 3),
    Field("PRESS", 10, 15, "Integer", 4),
    Field("PFLAG", 16, 16, "Character", 5),
    Field("GPH", 17, 21, "Integer", 6),
    Field("ZFLAG", 22, 22, "Character", 7),
    Field("TEMP", 23, 27, "Integer", 8),
    Field("TFLAG", 28, 28, "Character", 9),
    Field("RH", 29, 33, "Integer", 10),
    Field("DPDP", 35, 39, "Integer", 11),
    Field("WDIR", 41, 45, "Integer", 12),
    Field("WSPD", 47, 51, "Integer", 13),
)

HEADER_LAYOUT = Layout(HEADER_FIELDS, HEADER_WIDTH, KEY_PATTERN, COUNT_PATTERN)
LEVEL_LAYOUT = Layout(LEVEL_FIELDS, LEVEL_WIDTH)

_SPEC_SCHEMA = (
    "record_format array<struct<column_name:string,start_index:string,end_index:string,"
    "column_type:string,column_order:string>>"
)


def layout_for(kind: str) -> Layout:
    """The built-in layout called ``head`` or ``data``, in any letter case."""
    known = {"head": HEADER_LAYOUT, "data": LEVEL_LAYOUT}
    if kind.lower() not in known:
        raise ValueError(f"unknown layout {kind!r}; expected 'head' or 'data'")
    return known[kind.lower()]


def spec_rows(spark: SparkSession, path: str):
    """Rows of a JSON layout spec (``{"record_format": [...]}``) as a DataFrame."""
    spec = spark.read.schema(_SPEC_SCHEMA).option("multiLine", True).json(path)
    return spec.select(F.inline("record_format")).select(
        "column_name",
        F.col("start_index").cast("int").alias("start_index"),
        F.col("end_index").cast("int").alias("end_index"),
        "column_type",
        F.col("column_order").cast("int").alias("column_order"),
    )


def load_layout(spark: SparkSession, path: str, kind: str) -> Layout:
    """Read a JSON layout spec; width and key columns come from the built-in ``kind``.

    A spec is configuration of a few dozen rows, so reading it on the driver is bounded.
    """
    base = layout_for(kind)
    fields = tuple(Field(*row) for row in spec_rows(spark, path).toLocalIterator())
    if not fields:
        raise ValueError(f"layout spec {path} lists no columns")
    return Layout(fields, base.width, base.key_pattern, base.count_pattern)
