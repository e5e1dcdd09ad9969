"""Load of staged CSV files: header files to the header table, level files to the level table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondelake.functions.text import HEADER_PREFIX, LEVEL_PREFIX
from sondelake.operators.joins import join_checked
from sondelake.operators.keys import duplicates
from sondelake.operators.quality import DUPLICATE_UID, first_reason, header_checks, level_checks
from sondelake.operators.scratch import scratch_area, write_scratch
from sondelake.plans.ingest import existing_headers, ledger_rows, refuse_finished, write_headers
from sondelake.plans.lake import Lake
from sondelake.sources.staged_csv import staged_rows


def _reason(checks: tuple) -> Column:
    return F.when(F.col("corrupt").isNotNull(), F.lit("malformed")).otherwise(first_reason(*checks))


def _quarantine(rows: DataFrame, scope: str) -> DataFrame:
    return rows.select(
        F.col("file").alias("source_file"), "block_start", "seq", "uid", F.lit(scope).alias("scope"), "reason", "raw"
    )


def _load(lake: Lake, headers_path: str, levels_path: str, load_id: str) -> None:
    headers = staged_rows(lake.spark, headers_path, lake.headers.schema, HEADER_PREFIX)
    headers = write_scratch(headers.withColumn("reason", _reason(header_checks(lake.header_layout))), "staged-headers")
    levels = staged_rows(lake.spark, levels_path, lake.levels.schema, LEVEL_PREFIX)
    levels = write_scratch(levels.withColumn("reason", _reason(level_checks(lake.level_layout))), "staged-levels")

    keys = headers.where("reason IS NULL").select("uid", "file", "block_start", "seq")
    copies = duplicates(keys, existing_headers(lake, keys, load_id)).withColumn("reason", F.lit(DUPLICATE_UID))
    refused = headers.where("reason IS NOT NULL").select("seq", "reason").union(copies)
    refused = write_scratch(refused, "refused")

    good_levels = levels.where("reason IS NULL").withColumn("source_file", F.col("file"))
    lake.levels.write_load(good_levels, load_id)
    bad_headers = join_checked(headers.drop("reason"), refused, "seq", "inner")
    bad_levels = levels.where("reason IS NOT NULL")
    lake.quarantine.write_load(_quarantine(bad_headers, "header").union(_quarantine(bad_levels, "level")), load_id)

    # Headers last: a reader finds levels only through them.
    good = join_checked(headers, refused.select("seq"), "seq", "left_anti")
    write_headers(lake, good.drop("corrupt", "raw"), load_id)

    found = headers.groupBy("file").agg(F.count("*").alias("blocks"))
    found = found.union(levels.groupBy("file").agg(F.lit(0).cast("long").alias("blocks")))
    found = found.groupBy("file").agg(F.max("blocks").alias("blocks"))
    lake.ledger.write_load(ledger_rows(found, lake, load_id), load_id)


def load_staged(lake: Lake, headers_path: str, levels_path: str, load_id: str) -> DataFrame:
    """Load staged header and level files and return the load's ledger rows.

    Both paths may be one folder of delivered files, which are told apart by their prefix; files
    that `write_staged` made are kept in a folder for each kind. A row that does not fit its columns, misses a required
    value or is too wide goes to quarantine alone, and so do all but the first header of a uid.
    Levels are kept whatever happens to their header, as staged rows of copies cannot be told
    apart. A finished load id is refused; an unfinished one is done again.
    """
    with lake.logged("staged"):
        refuse_finished(lake, load_id)
        lake.check_rules(keep=True)
        with lake.writing(load_id), scratch_area(lake.spark):
            lake.ranges.drop_load(load_id)  # of an attempt that died: its levels are about to change
            _load(lake, headers_path, levels_path, load_id)
        return lake.ledger.read_load(load_id)
