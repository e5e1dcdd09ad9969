"""Altitude bands of a geopotential height in metres."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band height, last numbered band, band of everything else, missing marker.
BAND_METRES = 1000
LAST_BAND = 9
OTHER_BAND = 0
MISSING = -9999

PARTITION_COLUMN = "partition_gph"


def _band_number(gph: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(gph / BAND_METRES)).cast("int")


def partition_band(gph: Column) -> Column:
    """Band 1 up to 1000 m (missing marker included), 2..9 per further thousand, else 0."""
    return F.when(gph <= BAND_METRES * LAST_BAND, _band_number(gph)).otherwise(F.lit(OTHER_BAND))


def open_band(gph: Column) -> Column:
    """Bands without an upper end; a missing height has no band."""
    return F.when(gph != MISSING, _band_number(gph))
