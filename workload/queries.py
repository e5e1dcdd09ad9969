"""One query per capability of the engine, each over whole tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondelake.functions.bands import PARTITION_COLUMN, open_band, partition_band
from sondelake.functions.fixedwidth import csv_line
from sondelake.functions.layout import (
    HEADER_FIELDS,
    HEADER_LAYOUT,
    LEVEL_FIELDS,
    LEVEL_LAYOUT,
    Layout,
    load_layout,
)
from sondelake.functions.text import (
    datetime_text,
    double_quotes,
    field_text,
    file_extension,
    file_stem,
    staged_route,
)
from sondelake.operators.control import advanced, first_row, load_mode, runnable
from sondelake.operators.decode import decode_headers, decode_levels, sized_lines
from sondelake.operators.decode import level_lines as announced_lines
from sondelake.operators.extract import extract, max_header_id, pad_text, with_band
from sondelake.operators.keys import files_with_conflicts, first_per_uid, serial_ids
from sondelake.operators.quality import (
    cut_at_bad_header,
    first_reason,
    header_reason,
    level_reason,
    null_name,
    wide_name,
)
from sondelake.operators.scratch import scratch_path, write_scratch
from sondelake.plans.ingest import ingest, ingest_records, pending_files
from sondelake.plans.lake import Lake
from sondelake.plans.publish import publish
from sondelake.plans.staged import load_staged
from sondelake.schemas import (
    CONTROL_NOT_NULL,
    CONTROL_TEXT_WIDTHS,
    HEADER_SCHEMA,
    LEVEL_SCHEMA,
    PUBLISHED_COLUMNS,
    seed_control,
)
from sondelake.sources.blocks import literal_path, read_blocks
from sondelake.sources.published import read_published, write_banded
from sondelake.sources.staged_csv import (
    STAGED_HEADER_SCHEMA,
    STAGED_LEVEL_SCHEMA,
    read_staged_headers,
    read_staged_levels,
    write_staged,
)
from sondelake.streaming.pickup import pickup
from workload import inputs
from workload.inputs import once, table

JOB = "soundings"


# --- decoding -------------------------------------------------------------------------------


def header_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = inputs.header_blocks(spark, sf_dir)
    return decode_headers(blocks).drop("file", "block_start", "seq", "header")


def level_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.level_lines(spark, sf_dir).withColumn("uid", F.col("l_orderkey").cast("string"))
    return decode_levels(lines)


def _layout_from_spec(spark: SparkSession, kind: str, fields) -> Layout:
    """The fields written as a JSON layout spec and read back from it."""
    rows = [
        {
            "column_name": f.name,
            "start_index": f.start,
            "end_index": f.end,
            "column_type": f.type,
            "column_order": f.order,
        }
        for f in fields
    ]
    path = scratch_path(spark, "spec")
    spec = json.dumps({"record_format": rows}, indent=2)
    spark.createDataFrame([(spec,)], "value string").coalesce(1).write.text(path)
    return load_layout(spark, path, kind)


def spec_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header decode driven by a layout spec read from JSON."""
    layout = _layout_from_spec(spark, "HEAD", HEADER_FIELDS)
    blocks = inputs.header_blocks(spark, sf_dir)
    return decode_headers(blocks, layout).drop("file", "block_start", "seq", "header")


def length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.level_lines(spark, sf_dir).select(
        "l_orderkey",
        F.expr("case when l_orderkey%5 = 2 then substr(line,1,51) else line end").alias("line"),
    )
    return sized_lines(lines)


def csv_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = decode_headers(inputs.header_blocks(spark, sf_dir))
    headers = blocks.select(csv_line("header", HEADER_LAYOUT, "uid").alias("csv"))
    lines = inputs.level_lines(spark, sf_dir).withColumn("uid", F.col("l_orderkey").cast("string"))
    return headers.union(lines.select(csv_line("line", LEVEL_LAYOUT, "uid")))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and level rows staged as CSV and read back, their columns as one text per row."""
    headers = decode_headers(inputs.header_blocks(spark, sf_dir)).withColumn(
        "file", F.concat("file", F.lit(".part.txt"))
    )
    levels = inputs.level_table(spark, sf_dir).withColumn(
        "file", F.expr("concat('f', lpad(cast(cast(uid as long) % 16 as string), 3, '0'), '.part.txt')")
    )
    folders = scratch_path(spark, "csv-headers"), scratch_path(spark, "csv-levels")
    write_staged(headers, STAGED_HEADER_SCHEMA, folders[0], "file")
    write_staged(levels, STAGED_LEVEL_SCHEMA, folders[1], "file")

    def as_text(rows: DataFrame, kind: str) -> DataFrame:
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in rows.columns if c != "uid"]
        return rows.select(F.lit(kind).alias("kind"), "uid", F.concat_ws("|", *cells).alias("cells"))

    back = read_staged_headers(spark, folders[0]), read_staged_levels(spark, folders[1])
    return as_text(back[0], "header").union(as_text(back[1], "level"))


# --- blocks from files ----------------------------------------------------------------------


def block_scan_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = read_blocks(spark, inputs.sounding_files(spark, sf_dir, messy=False))
    return (
        decode_levels(announced_lines(blocks))
        .groupBy("uid")
        .agg(
            F.count("*").alias("levels"),
            F.sum("gph").alias("sum_gph"),
            F.sum("wdir").alias("sum_wdir"),
            F.max("press").alias("max_press"),
        )
    )


def level_count_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = read_blocks(spark, inputs.sounding_files(spark, sf_dir, messy=True))
    return announced_lines(blocks).select("uid", "pos", "line")


def block_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = read_blocks(spark, inputs.sounding_files(spark, sf_dir, messy=True))
    return blocks.select("header")


# --- checks and keys ------------------------------------------------------------------------

_SOME_CUT = (
    "case when o_orderkey%97 = 5 then substr(header,1,70) when o_orderkey%89 = 7 "
    "then concat(substr(header,1,32),'    ',substr(header,37)) else header end"
)
_SOME_WRONG = (
    "case when o_orderkey%31 = 1 then concat(substr(header,1,13),'    ',substr(header,18)) "
    "when o_orderkey%37 = 2 then concat(substr(header,1,55),'  12x45',substr(header,63)) "
    "else header end"
)


def bad_header_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = decode_headers(inputs.header_blocks(spark, sf_dir, _SOME_CUT)).withColumn(
        "reason", header_reason()
    )
    # Written first, as in a load: a filter on the reason would repeat the whole decode.
    checked = write_scratch(checked, "checked")
    return checked.where("reason IS NOT NULL").select("file", "seq", "reason", "header")


def bad_header_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_at_bad_header(inputs.header_blocks(spark, sf_dir, _SOME_CUT)).select("file", "seq", "header")


def header_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = decode_headers(inputs.header_blocks(spark, sf_dir, _SOME_WRONG)).withColumn(
        "reason", header_reason()
    )
    return checked.select("seq", "year", "lat", "reason")


def level_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.level_lines(spark, sf_dir).select(
        "l_orderkey",
        F.expr(
            "case when l_orderkey%19 = 3 then concat(substr(line,1,16),' 1 2 ',substr(line,22)) "
            "when l_orderkey%23 = 4 then concat(substr(line,1,16),'     ',substr(line,22)) "
            "else line end"
        ).alias("line"),
    )
    # Written first, as a load stages its text: the decode must not repeat the rendering.
    lines = write_scratch(lines, "lines")
    judged = decode_levels(
        lines.withColumn("uid", F.col("l_orderkey").cast("string")), keep=("l_orderkey", "line")
    ).withColumn("reason", level_reason())
    return judged.where("reason IS NOT NULL").select("l_orderkey", "reason", "line")


def _control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as control rows: a few jobs, with all kinds of flags."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("id"),
        F.col("c_mktsegment").alias("etl_name"),
        F.expr("case c_nationkey%4 when 0 then 'N' when 1 then 'Y' when 2 then null else 'NO' end")
        .alias("skip_execution"),
        F.expr("case c_custkey%5 when 0 then 'Y' when 1 then 'y' when 2 then null else 'N' end")
        .alias("full_load"),
        F.lit(None).cast("timestamp").alias("run_date"),
        F.expr("case c_custkey%3 when 0 then 'HEADER_ID' when 1 then 'header_id' else c_name end")
        .alias("filter_col1_name"),
        F.expr("case when c_custkey%7 = 0 then null else cast(c_custkey*10 as string) end")
        .alias("filter_col1_value"),
        F.lit(None).cast("string").alias("filter_col2_name"),
        F.lit(None).cast("string").alias("filter_col2_value"),
    )


def control_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _control_rows(spark, sf_dir)
    return rows.select(
        "id",
        first_reason(
            ("null", null_name(CONTROL_NOT_NULL)), ("width", wide_name(CONTROL_TEXT_WIDTHS))
        ).alias("reason"),
    )


def uid_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one customer are copies of one uid; customers below 10 are loaded already."""
    keys = inputs.header_blocks(spark, sf_dir).drop("header", "body").join(
        table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("seq"), F.col("o_custkey").cast("string").alias("uid")
        ),
        "seq",
    )
    customers = table(spark, sf_dir, "customer")
    existing = customers.where("c_custkey < 10").select(F.col("c_custkey").cast("string").alias("uid"))
    return first_per_uid(keys, existing)


def uid_file_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of orders, some of which repeat a key of the next file or of their own."""
    keys = table(spark, sf_dir, "orders").select(
        F.expr("concat('f', lpad(cast(o_orderkey % 64 as string), 3, '0'))").alias("file"),
        F.expr(
            "cast(case when o_orderkey%997 = 0 then o_orderkey+1 "
            "when o_orderkey%4999 = 3 then o_orderkey+64 else o_orderkey end as string)"
        ).alias("uid"),
    )
    return files_with_conflicts(keys).distinct()


def serial_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return serial_ids(orders, ["o_orderdate", "o_orderkey"], base=1000).select(
        "header_id", "o_orderkey"
    )


# --- extract and publish --------------------------------------------------------------------


def _top(spark: SparkSession, sf_dir: str) -> int:
    return max_header_id(
        table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("header_id"))
    ).head()[0]


def _extract(spark: SparkSession, sf_dir: str, **bounds) -> DataFrame:
    return extract(
        inputs.header_table(spark, sf_dir),
        inputs.level_table(spark, sf_dir),
        _top(spark, sf_dir),
        **bounds,
    )


def max_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_header_id(inputs.header_table(spark, sf_dir))


def max_header_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_header_id(inputs.header_table(spark, sf_dir).where("header_id < 0"))


def full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(spark, sf_dir)


def delta_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(spark, sf_dir, lo=_top(spark, sf_dir) // 2)


def delta_load_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(spark, sf_dir, lo=_top(spark, sf_dir) // 2, inclusive=True)


def full_load_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pad_text(_extract(spark, sf_dir))
    return rows.select("id", "p_src", "np_src", "pflag", "zflag", "tflag", "gph")


def altitude_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    heights = table(spark, sf_dir, "lineitem").select(_height().alias("gph"))
    return heights.select("gph", partition_band(F.col("gph")).alias(PARTITION_COLUMN))


def altitude_band_uncapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    heights = table(spark, sf_dir, "lineitem").select(_height().alias("gph"))
    return heights.select("gph", open_band(F.col("gph")).alias("altitude_band"))


def _height():
    """Heights from below zero to far above the last band, with missing and NULL ones."""
    return F.expr(
        "case when l_partkey%50 = 0 then -9999 when l_partkey%50 = 1 then null "
        "else cast(floor(l_extendedprice) as int) - 1000 end"
    )


def _with_columns(rows: DataFrame, schema) -> DataFrame:
    """The rows with the columns of a table that they lack, empty."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in rows.columns}
    return rows.withColumns(missing)


def band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: full load of orders and lineitem, rows and heights per band."""
    headers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("header_id"), F.col("o_orderkey").cast("string").alias("uid")
    )
    levels = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("uid"),
        F.floor(F.col("l_extendedprice") / 10).cast("int").alias("gph"),
    )
    loaded = extract(
        _with_columns(headers, HEADER_SCHEMA), _with_columns(levels, LEVEL_SCHEMA), _top(spark, sf_dir)
    )
    return with_band(loaded).groupBy(PARTITION_COLUMN).agg(
        F.count("*").alias("rows"), F.sum("gph").alias("sum_gph"), F.max("gph").alias("max_gph")
    )


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "published")
    write_banded(with_band(_extract(spark, sf_dir)), path)
    back = read_published(spark, path)
    return back.groupBy(PARTITION_COLUMN).agg(
        F.count("*").alias("rows"), F.sum("gph").alias("sum_gph"), F.sum("wspd").alias("sum_wspd")
    )


# --- control table --------------------------------------------------------------------------


def control_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runnable(_control_rows(spark, sf_dir), "BUILDING").select("id", "etl_name", "skip_execution")


def control_first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = first_row(runnable(_control_rows(spark, sf_dir), "BUILDING"))
    return chosen.select("id", "full_load", "filter_col1_name", "filter_col1_value")


def control_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = advanced(_control_rows(spark, sf_dir), 7, _top(spark, sf_dir))
    return rows.select("id", "etl_name", "skip_execution", "full_load", "filter_col1_name", "filter_col1_value")


def control_load_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _control_rows(spark, sf_dir).select("id", load_mode().alias("mode"))


# --- text helpers ---------------------------------------------------------------------------


def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(
        F.expr(
            "concat(case p_partkey%4 when 0 then 'headers-' when 1 then 'records-' "
            "when 2 then 'Headers-' else '' end, replace(p_name,' ','.'), "
            "case p_size%4 when 0 then '.csv' when 1 then '.CSV' when 2 then '.txt' else '' end)"
        ).alias("name")
    )
    return names.select(
        "name",
        file_stem(F.col("name")).alias("stem"),
        file_extension(F.col("name")).alias("extension"),
        staged_route(F.col("name")).alias("route"),
    )


def datetime_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", datetime_text(F.col("ts")).alias("text"))


def field_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        field_text(events, "event_id").alias("known"),
        field_text(events, "USER_ID").alias("other_case"),
        field_text(events, "client").alias("absent"),
    )


def error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with quotes, one per part, appended to a lake's error log and read from it."""
    message = F.concat(F.lit("can't load '"), "p_name", F.lit("'"))
    rows = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("etl_name"), F.lit("").alias("client_name"), double_quotes(message).alias("exception_message")
    )
    lake = Lake(spark, scratch_path(spark, "lake"))
    lake.log_errors(rows)
    return lake.errors().where("date_time IS NOT NULL").drop("date_time")


# --- whole runs -----------------------------------------------------------------------------


def _loaded(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake after one load of the messy files."""

    def make() -> Lake:
        lake = Lake(spark, scratch_path(spark, "lake"))
        ingest(lake, inputs.sounding_files(spark, sf_dir, messy=True), "first")
        return lake

    return once(spark, sf_dir, "loaded", make=make)


def _exchanged(fields, one: str, other: str):
    """The fields with the places of two of them exchanged."""
    places = {f.name: (f.start, f.end) for f in fields}
    places[one], places[other] = places[other], places[one]
    return tuple(f._replace(start=places[f.name][0], end=places[f.name][1]) for f in fields)


def spec_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load driven by layout specs with moved columns: headers, and sums over their levels."""
    header_fields = _exchanged(_exchanged(HEADER_FIELDS, "LAT", "LON"), "P_SRC", "NP_SRC")
    lake = Lake(
        spark,
        scratch_path(spark, "lake"),
        header_layout=_layout_from_spec(spark, "HEAD", header_fields),
        level_layout=_layout_from_spec(spark, "DATA", _exchanged(LEVEL_FIELDS, "GPH", "DPDP")),
    )
    ingest(lake, inputs.sounding_files(spark, sf_dir, messy=True), "first")
    sums = lake.levels.read().groupBy("uid").agg(
        F.count("*").alias("levels"), F.sum("gph").alias("sum_gph"), F.sum("dpdp").alias("sum_dpdp")
    )
    headers = lake.headers.read().select("uid", "p_src", "np_src", "lat", "lon")
    return headers.join(sums, "uid")


def ingest_whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load by the file-at-a-time rules: rows per file in the lake's tables and in quarantine."""
    lake = Lake(spark, scratch_path(spark, "lake"), whole_files=True)
    ingest_records(lake, inputs.sounding_records(spark, sf_dir, inputs.SOUNDINGS_PER_FILE), "first")
    loaded = lake.headers.read().select(F.lit("header").alias("kind"), "source_file").union(
        lake.levels.read().select(F.lit("level"), "source_file")
    )
    refused = lake.quarantine.read().select(F.concat_ws(" ", "scope", "reason"), "source_file")
    return loaded.union(refused).groupBy("kind", F.col("source_file").alias("file")).agg(F.count("*").alias("rows"))


def staged_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged header and level files loaded into a lake: rows per uid in its tables and in quarantine.

    Some headers share a uid or miss their year, some levels have a flag that is too wide.
    """
    headers = decode_headers(inputs.header_blocks(spark, sf_dir)).withColumns(
        {
            "uid": F.expr("cast(if(seq % 7 = 3, seq - seq % 64, seq) as string)"),
            "year": F.expr("if(seq % 31 = 1, null, year)"),
            "file": F.concat("file", F.lit(".txt")),
        }
    )
    levels = inputs.level_table(spark, sf_dir).withColumns(
        {
            "pflag": F.expr("if(cast(uid as long) % 29 = 3, 'wide', pflag)"),
            "file": F.expr("concat('f', cast(uid as long) % 16, '.txt')"),
        }
    )
    folders = scratch_path(spark, "staged-headers"), scratch_path(spark, "staged-levels")
    write_staged(headers, STAGED_HEADER_SCHEMA, folders[0], "file")
    write_staged(levels, STAGED_LEVEL_SCHEMA, folders[1], "file")
    lake = Lake(spark, scratch_path(spark, "lake"))
    load_staged(lake, *folders, "staged")
    loaded = lake.headers.read().select(F.lit("header").alias("kind"), "uid").union(
        lake.levels.read().select(F.lit("level"), "uid")
    )
    refused = lake.quarantine.read().select(F.concat_ws(" ", "scope", "reason"), "uid")
    return loaded.union(refused).groupBy("kind", "uid").agg(F.count("*").alias("rows"))


def _grown(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake filled by two pickups of messy files, with a full and a delta publishing run."""

    def make() -> Lake:
        lake = Lake(spark, scratch_path(spark, "lake"))
        inbox, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "pickup")
        lake.control.replace(seed_control(spark, JOB))
        for half in _halves(spark, sf_dir):
            inputs.write_soundings(half, inbox)
            pickup(lake, inbox, checkpoint)
            publish(lake, JOB)
        return lake

    return once(spark, sf_dir, "grown", make=make)


def ingest_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).headers.read().drop("source_file", "load_id")


def ingest_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).levels.read().drop("source_file", "load_id")


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).quarantine.read().groupBy("uid", "scope", "reason").agg(
        F.count("*").alias("rows")
    )


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger's counts per file, summed over the files of the load."""
    ledger = _loaded(spark, sf_dir).ledger.read()
    return ledger.groupBy("load_id").agg(
        *[F.sum(c).alias(c) for c in ("blocks", "headers", "levels")]
    )


def incremental_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grown(spark, sf_dir).headers.read().select("header_id", "uid", "numlev")


def published_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _grown(spark, sf_dir)
    return read_published(spark, lake.published_path).select(*PUBLISHED_COLUMNS, PARTITION_COLUMN)


def control_after_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _grown(spark, sf_dir).control.rows()
    return rows.select("id", "etl_name", "skip_execution", "full_load", "filter_col1_name", "filter_col1_value")


def _halves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Lines of the first and of the second half of all messy soundings."""
    lines = inputs.sounding_lines(spark, sf_dir, messy=True)
    middle = inputs.numbered_lines(spark, sf_dir).agg(F.max("b")).head()[0] // 2
    return [lines.where(F.col("b") <= middle), lines.where(F.col("b") > middle)]


def processed_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of the files that are still to be loaded when a half of them is in the ledger."""
    lake, inbox = Lake(spark, scratch_path(spark, "lake")), scratch_path(spark, "inbox")
    first, second = _halves(spark, sf_dir)
    inputs.write_soundings(first, inbox)
    ingest(lake, inbox, "first")
    inputs.write_soundings(second, inbox)
    files = [literal_path(row.file) for row in pending_files(lake, inbox).collect()]
    return read_blocks(spark, files).select("header")


def published_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs that publish the same lake in turn, with a mark set back: each row once."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    jobs = [seed_control(spark, name).withColumn("id", F.lit(k)) for k, name in enumerate(("a", "b"), 1)]
    lake.control.replace(jobs[0].union(jobs[1]))
    records = inputs.sounding_records(spark, sf_dir, inputs.SOUNDINGS_PER_FILE)
    # Not written in between: a load reads its records once, and only its part is brought together.
    records = records.withColumn("part", F.expr("cast(substr(file, 2, 8) as int) % 2"))
    for part, runs in enumerate((["a", "b"], ["a", "b", "a"])):
        ingest_records(lake, records.where(F.col("part") == part).drop("part"), f"part-{part}")
        for job in runs:
            publish(lake, job)
    behind = F.when(F.col("etl_name") == "b", F.lit("1")).otherwise(F.col("filter_col1_value"))
    lake.control.replace(lake.control.rows().withColumn("filter_col1_value", behind))
    publish(lake, "b")
    return read_published(spark, lake.published_path).select(*PUBLISHED_COLUMNS, PARTITION_COLUMN)


QUERIES = {
    q.__name__: q
    for q in (
        header_decode, level_decode, spec_decode, length_filter, csv_render, csv_roundtrip,
        block_scan_levels, level_count_gate, block_headers,
        bad_header_quarantine, bad_header_cutoff, header_rejects, level_rejects, control_checks,
        uid_first_wins, uid_file_reject, serial_numbers,
        max_header, max_header_empty, full_load, delta_load, delta_load_inclusive,
        full_load_padded, altitude_band, altitude_band_uncapped, band_counts,
        partitioned_roundtrip,
        control_select, control_first_row, control_advance, control_load_mode,
        route_files, datetime_texts, field_texts, error_rows,
        ingest_headers, ingest_levels, ingest_quarantine, load_counts, spec_ingest, ingest_whole_files, staged_load,
        incremental_pickup, published_runs, control_after_runs, processed_ledger, published_jobs,
    )
}
