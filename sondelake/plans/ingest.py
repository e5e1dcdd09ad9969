"""Ingest: sounding files to header and level tables.

The text is read once and kept as a columnar table of blocks. From there the wide level data
flows to its table without a shuffle; only header keys are shuffled, to find copies and to
number the headers.

By default bad input is refused as finely as possible: a block with an unusable or duplicate
header goes to quarantine with its levels, a malformed level goes alone, the first copy of a
uid wins. With ``Lake(whole_files=True)`` the coarser file-at-a-time rules hold instead: an
unusable header ends its file, one invalid or duplicate header refuses all headers of its file,
one malformed level refuses all levels of its file, and the two are independent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sondelake.functions.fixedwidth import block_uid
from sondelake.functions.layout import Layout
from sondelake.operators.decode import ORIGIN, decode_headers, decode_levels, level_lines
from sondelake.operators.joins import join_checked
from sondelake.operators.keys import duplicates, files_with_conflicts, loads_that_may_hold, serial_ids, uid_parts
from sondelake.operators.quality import (
    BAD_HEADER,
    DUPLICATE_UID,
    FILE_REFUSED,
    bad_header_cutoffs,
    header_reason,
    level_reason,
)
from sondelake.operators.scratch import scratch_area, write_scratch
from sondelake.plans.lake import Lake
from sondelake.sources.blocks import all_blocks, bounded_records, cut_lines, inbox_files, literal_path
from sondelake.sources.tables import LOAD_COLUMN


#: Files of one slice of a large inbox.
MAX_FILES = 10_000


def _block_quarantine(blocks: DataFrame, layout: Layout) -> DataFrame:
    """Whole refused blocks; ``blocks`` carries the reason."""
    return blocks.select(
        F.col("file").alias("source_file"),
        "block_start",
        "seq",
        block_uid("header", layout).alias("uid"),
        F.lit("block").alias("scope"),
        "reason",
        F.concat_ws("\n", F.col("header"), F.array_join("body", "\n")).alias("raw"),
    )


def _line_quarantine(judged: DataFrame) -> DataFrame:
    return judged.select(
        "source_file",
        "block_start",
        "seq",
        "uid",
        F.lit("level").alias("scope"),
        "reason",
        F.col("line").alias("raw"),
    )


def _judged_levels(blocks: DataFrame, lake: Lake) -> DataFrame:
    """Decoded levels of whole groups with their line, origin and the reason to refuse them.

    By the rules for blocks, a level also carries the published columns of its header.
    """
    beside = lake.levels.beside.names
    lines = level_lines(blocks, lake.header_layout, beside)
    levels = decode_levels(lines, lake.level_layout, keep=(*ORIGIN, "line", *beside))
    return levels.withColumn("reason", level_reason(lake.level_layout)).withColumnRenamed("file", "source_file")


def _checked_headers(blocks: DataFrame, lake: Lake) -> DataFrame:
    """Decoded headers with the reason to refuse them, written once for the key steps."""
    headers = decode_headers(blocks, lake.header_layout)
    return write_scratch(headers.withColumn("reason", header_reason(lake.header_layout)), "headers")


def header_rows(checked: DataFrame, lake: Lake, load_id: str) -> DataFrame:
    """Headers of a load, numbered on from those of the other loads."""
    base = lake.headers.read_other_loads(load_id).agg(F.max("header_id")).head()[0] or 0
    rows = checked.drop("header", "reason").withColumn("source_file", F.col("file"))
    return serial_ids(rows, list(ORIGIN), base=base)


def existing_headers(lake: Lake, uids: DataFrame, load_id: str) -> DataFrame:
    """Headers of the other loads that can hold one of ``uids``.

    A broadcast of one short row per load prunes the folders of all others.
    """
    headers = lake.headers.read_other_loads(load_id)
    loads = loads_that_may_hold(uids, headers, lake.uid_parts.read_other_loads(load_id), LOAD_COLUMN)
    # Stored, as it is read for every use of the headers. Spark prunes by a join if the small side has a
    # filter and the large one has none on the folders; ``loads`` holds no row of this load.
    loads = write_scratch(loads, "loads-with-uids").where(F.col(LOAD_COLUMN) > "")
    return lake.headers.read().join(F.broadcast(loads), LOAD_COLUMN, "left_semi")


def write_headers(lake: Lake, checked: DataFrame, load_id: str, *, colocated: bool = False) -> None:
    """Number and write the headers of a load, then what later runs have to know of them."""
    lake.headers.write_load(header_rows(checked, lake, load_id), load_id)
    written = lake.headers.read_load(load_id)
    lake.uid_parts.write_load(uid_parts(written).coalesce(1), load_id)
    ids = written.agg(F.min("header_id").alias("first_id"), F.max("header_id").alias("last_id"))
    lake.ranges.write_load(ids.where("first_id IS NOT NULL").withColumn("colocated", F.lit(colocated)), load_id)


def ledger_rows(found: DataFrame, lake: Lake, load_id: str) -> DataFrame:
    """Per input file: blocks ``found``, headers and levels loaded."""

    def loaded(table, name: str) -> DataFrame:
        rows = table.read_load(load_id).groupBy(F.col("source_file").alias("file"))
        return rows.agg(F.count("*").alias(name))

    return (
        found.join(loaded(lake.headers, "headers"), "file", "left")
        .join(loaded(lake.levels, "levels"), "file", "left")
        .na.fill(0, ["headers", "levels"])
    )


def _ingest_by_block(lake: Lake, blocks: DataFrame, load_id: str) -> None:
    checked = _checked_headers(blocks, lake)
    keys = checked.where("reason IS NULL").select("uid", *ORIGIN)
    existing = existing_headers(lake, keys, load_id)
    copies = duplicates(keys, existing).withColumn("reason", F.lit(DUPLICATE_UID))
    refused = write_scratch(
        checked.where("reason IS NOT NULL").select("seq", "reason").union(copies), "refused"
    )
    refused_seq = refused.select("seq")

    judged = _judged_levels(join_checked(blocks, refused_seq, "seq", "left_anti"), lake)
    seen = Observation()
    levels = judged.observe(seen, F.count("reason").alias("bad")).where("reason IS NULL")
    lake.levels.write_load(levels, load_id)

    refusals = join_checked(blocks, refused, "seq", "inner")
    rejected = _block_quarantine(refusals, lake.header_layout)
    if seen.get["bad"]:
        # Only now is a second pass over the lines worth it.
        rejected = rejected.union(_line_quarantine(judged.where("reason IS NOT NULL")))
    lake.quarantine.write_load(rejected, load_id)

    # Headers last: a reader finds levels only through them.
    good = join_checked(checked, refused_seq, "seq", "left_anti")
    write_headers(lake, good, load_id, colocated=bool(lake.levels.beside.names))


def _ingest_by_file(lake: Lake, blocks: DataFrame, load_id: str) -> None:
    cutoffs = write_scratch(bad_header_cutoffs(blocks, lake.header_layout), "cutoffs")
    marked = join_checked(blocks, cutoffs, "file", "left")
    lost = F.coalesce(F.struct("block_start", "seq") >= F.col("cutoff"), F.lit(False))
    kept = marked.where(~lost).drop("cutoff")

    # Written once: three steps follow that would each decode all lines again.
    judged = write_scratch(_judged_levels(kept, lake), "judged")
    bad_level_files = judged.where("reason IS NOT NULL").select(F.col("source_file").alias("file"))
    bad_level_files = write_scratch(bad_level_files.distinct(), "bad-level-files")
    files = judged.withColumn("file", F.col("source_file"))
    levels = join_checked(files, bad_level_files, "file", "left_anti")
    lake.levels.write_load(levels, load_id)

    checked = _checked_headers(kept, lake)
    invalid = checked.where("reason IS NOT NULL").select("file").distinct()
    existing = existing_headers(lake, checked, load_id)
    refused = files_with_conflicts(checked.select("uid", "file"), existing, invalid)
    refused = write_scratch(refused.distinct(), "refused-files")

    cut_away = _block_quarantine(
        marked.where(lost).withColumn("reason", F.lit(f"after_{BAD_HEADER}")), lake.header_layout
    )
    header_files = join_checked(checked, refused, "file", "left_semi").select(
        F.col("file").alias("source_file"),
        "block_start",
        "seq",
        "uid",
        F.lit("header_file").alias("scope"),
        F.coalesce("reason", F.lit(FILE_REFUSED)).alias("reason"),
        F.col("header").alias("raw"),
    )
    refused_lines = join_checked(files, bad_level_files, "file", "left_semi")
    level_files = _line_quarantine(refused_lines).withColumns(
        {
            "scope": F.lit("level_file"),
            "reason": F.coalesce("reason", F.lit(FILE_REFUSED)),
        }
    )
    lake.quarantine.write_load(cut_away.union(header_files).union(level_files), load_id)

    good = join_checked(checked, refused, "file", "left_anti")
    write_headers(lake, good, load_id)


def ingest_records(lake: Lake, records: DataFrame, load_id: str, files: DataFrame | None = None) -> DataFrame:
    """Load raw records (file, block_start, value) and return the load's ledger rows.

    ``files`` (file, length) lists the files that the records were read from. With it, files of which
    `bounded_records` has left a part out are scanned by line, and files without records are in the ledger too.

    A load replaces whatever an earlier attempt with the same ``load_id`` wrote. One load runs in a lake at
    a time; a second one is refused.
    """
    lake.check_rules(keep=True)
    with lake.writing(load_id), scratch_area(lake.spark):
        lake.ranges.drop_load(load_id)  # of an attempt that died: its levels are about to change
        cut = write_scratch(cut_lines(records, lake.header_layout), "blocks")
        blocks = all_blocks(cut, lake.header_layout, files)
        if lake.whole_files:
            _ingest_by_file(lake, blocks, load_id)
        else:
            _ingest_by_block(lake, blocks, load_id)
        found = cut.groupBy("file").agg(F.count("*").alias("blocks"))
        if files is not None:
            found = files.select("file").join(found, "file", "left").na.fill(0, ["blocks"])
        lake.ledger.write_load(ledger_rows(found, lake, load_id), load_id)
    return lake.ledger.read_load(load_id)


def pending_files(lake: Lake, inbox: str) -> DataFrame:
    """Non-empty inbox files that no load has in its ledger."""
    files = inbox_files(lake.spark, inbox).where("length > 0")
    return files.join(lake.ledger.read(), "file", "left_anti")


def refuse_finished(lake: Lake, load_id: str) -> None:
    """Raise if the load is in the ledger: writing under its id again would replace its rows."""
    if not lake.ledger.read_load(load_id).isEmpty():
        raise ValueError(f"load {load_id!r} is finished; new files need a load id of their own")


def ingest(lake: Lake, inbox: str, load_id: str) -> DataFrame | None:
    """Load the inbox files not loaded before; None if there are none.

    A finished load id is refused. An unfinished one is done again: its files are not in the
    ledger, so they are among the new ones.

    The list of new file names passes through the driver, as every list of input paths does.
    For a large inbox use `ingest_all`, for a steadily filled one `streaming.pickup`.
    """
    with lake.logged("ingest"):
        refuse_finished(lake, load_id)
        pending = write_scratch(pending_files(lake, inbox).select("file", "length"), "pending")
        names = [row.file for row in pending.select("file").toLocalIterator()]
        if not names:
            return None
        records = bounded_records(lake.spark, [literal_path(n) for n in names])
        return ingest_records(lake, records, load_id, pending)


def ingest_all(lake: Lake, inbox: str, load_id: str, max_files: int = MAX_FILES) -> DataFrame | None:
    """Load the inbox files not loaded before in slices of at most ``max_files``; None if there are none.

    The files found are written down once, as the manifest of ``load_id``, and each slice is a load of its
    own, so the driver holds the names of one slice only. After a failure the same call goes on with
    the slices that are not in the ledger. A finished load id is refused.
    """
    with lake.logged("ingest"):
        manifest = lake.manifest.read_load(load_id)
        if manifest.isEmpty():
            with scratch_area(lake.spark):
                found = serial_ids(pending_files(lake, inbox).select("file", "length"), ["file"], name="n")
                slice_of = F.expr(f"cast((n - 1) div {max_files} as int)").alias("slice")
                lake.manifest.write_load(found.select(slice_of, "file", "length"), load_id)
            manifest = lake.manifest.read_load(load_id)
        slices = {f"{load_id}-{r.slice:06d}": r.slice for r in manifest.select("slice").distinct().orderBy("slice").collect()}
        if not slices:
            lake.manifest.drop_load(load_id)
            return None
        finished = {r[0] for r in lake.ledger.read().select(LOAD_COLUMN).distinct().where(F.col(LOAD_COLUMN).startswith(f"{load_id}-")).collect()}
        if finished.issuperset(slices):
            raise ValueError(f"load {load_id!r} is finished; new files need a load id of their own")
        for name, number in slices.items():
            if name not in finished:
                files = manifest.where(F.col("slice") == number).select("file", "length")
                paths = [literal_path(row.file) for row in files.select("file").toLocalIterator()]
                ingest_records(lake, bounded_records(lake.spark, paths), name, files)
        return lake.ledger.read().where(F.col(LOAD_COLUMN).isin(list(slices)))
