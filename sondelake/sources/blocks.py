"""Scan of sounding files as whole blocks: a ``#`` header line and the lines after it.

The text source is told to end records at a line break followed by ``#``. Each record is then
one block, a file is split over as many tasks as its size asks for, and no join, window or sort
is needed to bring a data line together with its header.

What the record text alone cannot tell is settled afterwards from narrow columns:

* every record but the first of a file has lost its ``#`` to the separator;
* text before a file's first header is a record of its own and belongs to no block;
* the last record of a file still has the line break that ends the file, which must not count
  as an empty line.

Batch reads pass over records longer than `LONGEST_RECORD`: the bytes of a file's records then do not add
up to the file's size, and that file is scanned line by line instead (`long_blocks`). So neither a file without
headers nor junk after a block needs memory of its size. Streaming reads, which have no list of their
files to check against, read every record, whatever its length.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from sondelake.functions.fixedwidth import level_count
from sondelake.functions.layout import HEADER_LAYOUT, Layout
from sondelake.operators.joins import join_checked
from sondelake.operators.scratch import write_scratch

# Header marker, record separator, inbox file extension.
MARK = "#"
BLOCK_SEPARATOR = "\n#"
INBOX_EXTENSION = "txt"

_BARE_SEPARATOR = "\r#"
_ANY_BREAK = r"\r\n|\r|\n"

#: Bytes of the longest record that is read as one; a block of 9999 lines has about half a megabyte.
LONGEST_RECORD = 32 << 20
_LONGEST = "mapreduce.input.linerecordreader.line.maxlength"

_EXTRA_MARK = "extra_mark"
_PREAMBLE = "preamble"
_FINAL_BREAK = "final_break"


def _configured(reader: DataFrameReader | DataStreamReader, extension: str):
    return reader.option("lineSep", BLOCK_SEPARATOR).option("pathGlobFilter", f"*.{extension}")


def _with_origin(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        "value",
    )


def inbox_files(spark: SparkSession, inbox: str, extension: str = INBOX_EXTENSION) -> DataFrame:
    """Files directly inside ``inbox`` with the extension (case-sensitive), without content.

    Only direct children are listed: folders such as ``processed`` or ``k=1`` are not looked into.
    """
    try:
        listing = spark.read.format("binaryFile").load(f"{inbox}/*.{extension}")
    except AnalysisException as error:  # no such file yet
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file string, length long, modificationTime timestamp")
    return listing.select(F.col("_metadata.file_path").alias("file"), "length", "modificationTime")


def literal_path(file: str) -> str:
    """A listed file name (an encoded URI) as a path that readers take as it is, not as a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(file))


def read_records(
    spark: SparkSession, paths: str | list[str], extension: str = INBOX_EXTENSION
) -> DataFrame:
    """Raw records of the files below ``paths``: (file, block_start, value)."""
    return _with_origin(_configured(spark.read, extension).text(paths))


def bounded_records(spark: SparkSession, paths: str | list[str], extension: str = INBOX_EXTENSION) -> DataFrame:
    """`read_records` without those longer than `LONGEST_RECORD`, which `all_blocks` makes up for."""
    return _with_origin(_configured(spark.read, extension).option(_LONGEST, LONGEST_RECORD).text(paths))


def listed_files(spark: SparkSession, paths: str | list[str], extension: str = INBOX_EXTENSION) -> DataFrame:
    """(file, length) of the files that `read_records` reads, without content."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{extension}").load(paths)
    return listing.select(F.col("_metadata.file_path").alias("file"), "length")


def stream_records(
    spark: SparkSession,
    inbox: str,
    extension: str = INBOX_EXTENSION,
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """Streaming form of `read_records`; a micro-batch always holds whole files."""
    reader = _configured(spark.readStream, extension)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return _with_origin(reader.text(f"{inbox}/*.{extension}"))


def cut_lines(records: DataFrame, layout: Layout = HEADER_LAYOUT) -> DataFrame:
    """Split records into lines and number them; one narrow stage.

    ``seq`` is unique over the scan and rises within a file split, so that
    (block_start, seq) is the order of blocks in a file. ``bytes`` are those of a record and the
    separator after it.
    """
    has_cr = F.contains("value", F.lit("\r"))
    pieces = records.select(
        "file",
        "block_start",
        F.octet_length("value").alias("bytes"),
        # A carriage return alone also ends a line; inside a record it may hide a header.
        F.posexplode(
            F.when(has_cr, F.split("value", _BARE_SEPARATOR)).otherwise(F.array("value"))
        ).alias("piece", "value"),
    )
    # Half of a CRLF is left when the separator took the other half.
    text = F.when(
        F.endswith("value", F.lit("\r")), F.substring("value", 1, F.length("value") - 1)
    ).otherwise(F.col("value"))
    numbered = pieces.select(
        "file",
        "block_start",
        F.when(F.col("piece") == 0, F.col("bytes") + len(BLOCK_SEPARATOR)).otherwise(0).alias("bytes"),
        F.monotonically_increasing_id().alias("seq"),
        F.endswith("value", F.lit("\n")).alias("open_end"),
        F.when(has_cr, F.split(text, _ANY_BREAK)).otherwise(F.split(text, "\n")).alias("lines"),
    )
    first_line = F.col("lines")[0]
    n_body = F.size("lines") - 1
    # With or without the mark put back: which one applies is not settled yet.
    announced = [level_count(h, layout) for h in ("lines[0]", f"concat('{MARK}', lines[0])")]
    return numbered.select(
        "file",
        "block_start",
        "bytes",
        "seq",
        first_line.alias("first_line"),
        F.slice("lines", 2, F.greatest(n_body, F.lit(0))).alias("body"),
        ((F.col("block_start") == 0) & first_line.startswith(MARK)).alias("has_mark"),
        # Only here does it matter whether the text ends with the file's own line break.
        F.coalesce(
            F.col("open_end") & ((n_body == announced[0]) | (n_body == announced[1])), F.lit(False)
        ).alias("end_decides"),
    )


def _edge_fixes(cut: DataFrame) -> DataFrame:
    """(seq, fix) of the few records that the text alone would misread."""
    ends = cut.groupBy("file").agg(
        F.min(F.struct("block_start", "seq", "has_mark")).alias("first"),
        F.max(F.struct("block_start", "seq", "end_decides")).alias("last"),
    )
    first_or_last = ends.select(
        F.inline(
            F.array_compact(
                F.array(
                    F.when(
                        ~F.col("first.has_mark"),
                        F.struct(F.col("first.seq").alias("seq"), F.lit(_PREAMBLE).alias("fix")),
                    ),
                    F.when(
                        F.col("last.end_decides")
                        & (F.col("first.has_mark") | (F.col("last.seq") != F.col("first.seq"))),
                        F.struct(F.col("last.seq").alias("seq"), F.lit(_FINAL_BREAK).alias("fix")),
                    ),
                )
            )
        )
    )
    # A header line that starts with two marks, not at the start of its file.
    doubled = (
        cut.where("has_mark")
        .select("seq")
        .join(ends.select(F.col("first.seq").alias("seq")), "seq", "left_anti")
        .withColumn("fix", F.lit(_EXTRA_MARK))
    )
    return (
        first_or_last.union(doubled)
        .groupBy("seq")
        .agg(F.collect_set("fix").alias("fixes"))
    )


def _as_blocks(cut: DataFrame, is_complete: Column, body: Column) -> DataFrame:
    """Put the mark back where the separator took it."""
    header = F.when(is_complete, F.col("first_line")).otherwise(
        F.concat(F.lit(MARK), "first_line")
    )
    return cut.select("file", "block_start", "seq", header.alias("header"), body.alias("body"))


def assemble_blocks(cut: DataFrame) -> DataFrame:
    """Blocks (file, block_start, seq, header, body) from the written output of `cut_lines`.

    ``body`` may hold one empty string after the last line of a file when nothing depends on
    it; it is never among the announced levels.
    """
    fixes = write_scratch(_edge_fixes(cut), "edges")
    if fixes.isEmpty():
        return _as_blocks(cut, F.col("has_mark"), F.col("body"))
    fixed = join_checked(cut, fixes, "seq", "left")

    def has(fix: str):
        return F.coalesce(F.array_contains("fixes", fix), F.lit(False))

    shortened = F.slice("body", 1, F.size("body") - 1)
    return _as_blocks(
        fixed.where(~has(_PREAMBLE)),
        F.col("has_mark") & ~has(_EXTRA_MARK),
        F.when(has(_FINAL_BREAK), shortened).otherwise(F.col("body")),
    )


def unread_files(cut: DataFrame, files: DataFrame) -> list[str]:
    """Those of the ``files`` (file, length) of which the reader has passed over a part.

    They hold a record longer than `LONGEST_RECORD` and are few; their names are an input path each.
    """
    read = cut.groupBy("file").agg((F.sum("bytes") - len(BLOCK_SEPARATOR)).alias("read"))
    short = files.join(read, "file", "left").where(F.coalesce("read", F.lit(0)) < F.col("length"))
    return [row.file for row in short.select("file").collect()]


def long_blocks(spark: SparkSession, files: list[str], layout: Layout = HEADER_LAYOUT) -> DataFrame:
    """Blocks of files that hold very long ones, scanned line by line.

    Of a block, the header and the lines that it announces are kept; what comes after them, or before a
    file's first header, is passed over. Lines are numbered within their file split; a split hands on
    to the next ones the place of its last header and its number of lines (one row per split). So lines find
    their header wherever the file is cut, and no task holds more than a split or one block's announced
    lines.
    """
    raw = spark.read.option(_LONGEST, LONGEST_RECORD).text([literal_path(f) for f in files])
    # The numbers stay clear of those of the other files' blocks.
    seq = F.monotonically_increasing_id() - (1 << 62)
    lines = write_scratch(_with_origin(raw).withColumn("seq", seq), "long-lines")

    split = Window.partitionBy("file", "block_start").orderBy("seq")
    so_far = split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    narrow = lines.select("file", "block_start", "seq", F.startswith("value", F.lit(MARK)).alias("is_header"))
    placed = narrow.withColumn("at", F.row_number().over(split))
    head = F.when(F.col("is_header"), F.struct("at", "seq"))
    placed = placed.withColumn("head", F.max(head).over(so_far))

    ends = placed.groupBy("file", "block_start").agg(F.max("at").alias("n"), F.max("head").alias("last"))
    earlier = Window.partitionBy("file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    counted = ends.withColumn("lines_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    in_file = F.when(
        F.col("last").isNotNull(),
        F.struct((F.col("lines_before") + F.col("last.at")).alias("at"), F.col("last.seq").alias("seq")),
    )
    carried = counted.select(
        "file", "block_start", "lines_before", F.max(in_file).over(earlier).alias("carried")
    )

    here = F.struct((F.col("lines_before") + F.col("head.at")).alias("at"), F.col("head.seq").alias("seq"))
    own = F.when(F.col("head").isNotNull(), here).otherwise(F.col("carried"))
    known = placed.join(carried, ["file", "block_start"]).withColumn("own", own).select(
        "seq", F.col("own.seq").alias("head_seq"), (F.col("lines_before") + F.col("at") - F.col("own.at")).alias("pos")
    )
    most = 10**layout.count_field.length - 1
    headers = lines.where(F.startswith("value", F.lit(MARK))).select(
        F.col("seq").alias("head_seq"), F.coalesce(level_count("value", layout), F.lit(0)).alias("n"), "file", "block_start"
    )
    wanted = known.where(F.col("pos") <= most).join(headers, "head_seq").where("pos = 0 OR pos <= n")
    wanted = write_scratch(wanted.select("seq", "head_seq", "pos", F.col("file").alias("of"), F.col("block_start").alias("start")), "wanted")
    texts = join_checked(lines.select("seq", "value"), wanted, "seq", "inner")
    line = F.when(F.col("pos") > 0, F.struct("pos", "value"))
    grouped = texts.groupBy("of", "start", "head_seq").agg(
        F.max(F.when(F.col("pos") == 0, F.col("value"))).alias("header"),
        F.array_sort(F.collect_list(line)).alias("body"),  # no more than the header announces
    )
    return grouped.select(
        F.col("of").alias("file"),
        F.col("start").alias("block_start"),
        F.col("head_seq").alias("seq"),
        "header",
        F.transform("body", lambda b: b.value).alias("body"),
    )


def all_blocks(cut: DataFrame, layout: Layout = HEADER_LAYOUT, files: DataFrame | None = None) -> DataFrame:
    """Blocks from the written output of `cut_lines`.

    With the list of ``files`` (file, length) read, those that hold very long blocks are scanned by line.
    """
    unread = unread_files(cut, files) if files is not None else []
    if not unread:
        return assemble_blocks(cut)
    whole = cut.where(~F.col("file").isin(unread))
    return assemble_blocks(whole).unionByName(write_scratch(long_blocks(cut.sparkSession, unread, layout), "long-blocks"))


def read_blocks(
    spark: SparkSession,
    paths: str | list[str],
    extension: str = INBOX_EXTENSION,
    layout: Layout = HEADER_LAYOUT,
) -> DataFrame:
    """Blocks of all sounding files directly inside ``paths``. The text is read once and kept as columns."""
    cut = write_scratch(cut_lines(bounded_records(spark, paths, extension), layout), "blocks")
    return all_blocks(cut, layout, listed_files(spark, paths, extension))
