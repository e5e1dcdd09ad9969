"""The same results in plain SQL over the same tables, for DuckDB."""

from __future__ import annotations

import re

from workload.inputs import (
    LEVELS_PER_SOUNDING,
    MESSY_DECLARED,
    MESSY_HEADER,
    MESSY_KEY,
    MESSY_LINE,
    RAW_HEADER,
    RAW_LEVEL,
    SOUNDING_HEADER,
    SOUNDINGS_PER_FILE,
)

# Rendered lines of orders and lineitem.
RENDERED = f"""
counts AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
raw_h AS (
  SELECT o_orderkey, {RAW_HEADER.format(S="varchar")} AS header
  FROM orders LEFT JOIN counts ON o_orderkey = l_orderkey),
raw_l AS (SELECT l_orderkey, l_linenumber, {RAW_LEVEL.format(S="varchar")} AS line FROM lineitem)
"""

HEADER_TEXT = """
trim(substr(header,2,11)) AS id, trim(substr(header,14,4)) AS year, trim(substr(header,19,2)) AS month,
trim(substr(header,22,2)) AS day, trim(substr(header,25,2)) AS hour, trim(substr(header,28,4)) AS reltime,
trim(substr(header,33,4)) AS numlev, trim(substr(header,38,8)) AS p_src, trim(substr(header,47,8)) AS np_src,
trim(substr(header,56,7)) AS lat, trim(substr(header,64,8)) AS lon
"""
HEADER_UID = """
concat(trim(substr(header,2,11)), trim(substr(header,14,4)), trim(substr(header,19,2)),
  trim(substr(header,22,2)), trim(substr(header,25,2)), trim(substr(header,28,4)))
"""
HEADER_DECODED = """
trim(substr(header,2,11)) AS id, try_cast(trim(substr(header,14,4)) AS int) AS year,
try_cast(trim(substr(header,19,2)) AS int) AS month, try_cast(trim(substr(header,22,2)) AS int) AS day,
try_cast(trim(substr(header,25,2)) AS int) AS hour, try_cast(trim(substr(header,28,4)) AS int) AS reltime,
try_cast(trim(substr(header,33,4)) AS int) AS numlev, trim(substr(header,38,8)) AS p_src,
trim(substr(header,47,8)) AS np_src, try_cast(trim(substr(header,56,7)) AS int) AS lat,
try_cast(trim(substr(header,64,8)) AS int) AS lon
"""
LEVEL_TEXT = """
trim(substr(line,1,1)) AS lvltyp1, trim(substr(line,2,1)) AS lvltyp2, trim(substr(line,4,5)) AS etime,
trim(substr(line,10,6)) AS press, trim(substr(line,16,1)) AS pflag, trim(substr(line,17,5)) AS gph,
trim(substr(line,22,1)) AS zflag, trim(substr(line,23,5)) AS temp, trim(substr(line,28,1)) AS tflag,
trim(substr(line,29,5)) AS rh, trim(substr(line,35,5)) AS dpdp, trim(substr(line,41,5)) AS wdir,
trim(substr(line,47,5)) AS wspd
"""
LEVEL_DECODED = """
try_cast(trim(substr(line,1,1)) AS int) AS lvltyp1, try_cast(trim(substr(line,2,1)) AS int) AS lvltyp2,
try_cast(trim(substr(line,4,5)) AS int) AS etime, try_cast(trim(substr(line,10,6)) AS int) AS press,
trim(substr(line,16,1)) AS pflag, try_cast(trim(substr(line,17,5)) AS int) AS gph,
trim(substr(line,22,1)) AS zflag, try_cast(trim(substr(line,23,5)) AS int) AS temp,
trim(substr(line,28,1)) AS tflag, try_cast(trim(substr(line,29,5)) AS int) AS rh,
try_cast(trim(substr(line,35,5)) AS int) AS dpdp, try_cast(trim(substr(line,41,5)) AS int) AS wdir,
try_cast(trim(substr(line,47,5)) AS int) AS wspd
"""
PUBLISHED = """id, year, month, day, hour, reltime, numlev, p_src, np_src, lat, lon, lvltyp1, lvltyp2,
etime, press, pflag, gph, zflag, temp, tflag, rh, dpdp, wdir, wspd"""

BAND = """CAST(CASE WHEN gph <= 1000 THEN 1 WHEN gph <= 2000 THEN 2 WHEN gph <= 3000 THEN 3
WHEN gph <= 4000 THEN 4 WHEN gph <= 5000 THEN 5 WHEN gph <= 6000 THEN 6 WHEN gph <= 7000 THEN 7
WHEN gph <= 8000 THEN 8 WHEN gph <= 9000 THEN 9 ELSE 0 END AS int)"""

TABLES = f"""
headers AS (SELECT o_orderkey AS header_id, cast(o_orderkey AS varchar) AS uid, {HEADER_DECODED} FROM raw_h),
levels AS (SELECT cast(l_orderkey AS varchar) AS uid, {LEVEL_DECODED} FROM raw_l)
"""

# Every lineitem row as a numbered line of a sounding.
_LINES = f"""
raw_l AS (SELECT l_orderkey, l_linenumber, {RAW_LEVEL.format(S="varchar")} AS line FROM lineitem),
numbered AS (
  SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, line) - 1 AS n, line FROM raw_l),
lines AS (SELECT n, n // {LEVELS_PER_SOUNDING} AS b, n % {LEVELS_PER_SOUNDING} AS i, line FROM numbered),
sizes AS (SELECT b, count(*) AS levels FROM lines GROUP BY b)
"""
CLEAN = f"""
{_LINES},
heads AS (
  SELECT b, {SOUNDING_HEADER.format(S="varchar")} AS header FROM (SELECT b, b AS k, levels AS declared FROM sizes))
"""
MESSY = f"""
{_LINES},
whole_heads AS (
  SELECT b, levels, declared, {SOUNDING_HEADER.format(S="varchar")} AS header
  FROM (SELECT b, {MESSY_KEY} AS k, levels, {MESSY_DECLARED} AS declared FROM sizes)),
heads AS (SELECT b, levels, declared, {MESSY_HEADER} AS header FROM whole_heads),
gated AS (
  SELECT b, {HEADER_UID} AS uid, i, {MESSY_LINE} AS line
  FROM lines JOIN heads USING (b)
  WHERE length(header) = 71 AND declared <= levels AND i < declared)
"""
# What a load of the messy files accepts and refuses.
LOADED = f"""
{MESSY},
checked AS (
  SELECT b, header, {HEADER_UID} AS uid,
    CASE WHEN length(header) <> 71 THEN 'bad_header' END AS reason FROM heads),
judged AS (
  SELECT b, header, uid, coalesce(reason, CASE WHEN row_number() OVER (
    PARTITION BY uid, reason ORDER BY b) > 1 THEN 'duplicate_uid' END) AS reason FROM checked),
accepted AS (
  SELECT row_number() OVER (ORDER BY b) AS header_id, b, header, uid FROM judged WHERE reason IS NULL),
sized AS (
  SELECT b, gated.uid, line FROM gated JOIN accepted USING (b) WHERE length(line) = 52)
"""
LEVEL_OK = "NOT coalesce(try_cast(trim(substr(line,17,5)) AS int) IS NULL AND trim(substr(line,17,5)) <> '', false)"

# Of the files f with uids in keys, those accepted one after the other.
ACCEPTED_FILES = """
twice AS (SELECT DISTINCT f FROM (SELECT f, uid FROM keys GROUP BY f, uid HAVING count(*) > 1)),
shared AS (SELECT uid FROM keys GROUP BY uid HAVING count(DISTINCT f) > 1),
pairs AS (SELECT DISTINCT a.f AS f, b.f AS g FROM keys a JOIN shared USING (uid)
  JOIN keys b USING (uid) WHERE b.f < a.f),
earlier AS (SELECT f, list(g) AS gs FROM pairs GROUP BY f),
files AS (SELECT f, row_number() OVER (ORDER BY f) AS i, coalesce(gs, []) AS gs,
    twice.f IS NOT NULL AS is_twice
  FROM (SELECT DISTINCT f FROM keys) LEFT JOIN earlier USING (f) LEFT JOIN twice USING (f)),
walk(i, accepted) AS (
  SELECT CAST(0 AS bigint), CAST([] AS bigint[])
  UNION ALL
  SELECT files.i, CASE WHEN is_twice OR list_has_any(accepted, gs) THEN accepted
    ELSE list_append(accepted, f) END
  FROM walk JOIN files ON files.i = walk.i + 1)
"""

SOME_CUT = """CASE WHEN o_orderkey%97 = 5 THEN substr(header,1,70) WHEN o_orderkey%89 = 7
THEN concat(substr(header,1,32),'    ',substr(header,37)) ELSE header END"""
SOME_WRONG = """CASE WHEN o_orderkey%31 = 1 THEN concat(substr(header,1,13),'    ',substr(header,18))
WHEN o_orderkey%37 = 2 THEN concat(substr(header,1,55),'  12x45',substr(header,63)) ELSE header END"""
FILE_16 = "concat('f', lpad(cast(o_orderkey % 16 AS varchar), 3, '0'))"
IS_BAD = "(length(header) <> 71 OR try_cast(trim(substr(header,33,4)) AS int) IS NULL)"

CONTROL = """
control AS (
  SELECT cast(c_custkey AS int) AS id, c_mktsegment AS etl_name,
    CASE c_nationkey%4 WHEN 0 THEN 'N' WHEN 1 THEN 'Y' WHEN 2 THEN NULL ELSE 'NO' END AS skip_execution,
    CASE c_custkey%5 WHEN 0 THEN 'Y' WHEN 1 THEN 'y' WHEN 2 THEN NULL ELSE 'N' END AS full_load,
    CASE c_custkey%3 WHEN 0 THEN 'HEADER_ID' WHEN 1 THEN 'header_id' ELSE c_name END AS filter_col1_name,
    CASE WHEN c_custkey%7 = 0 THEN NULL ELSE cast(c_custkey*10 AS varchar) END AS filter_col1_value
  FROM customer)
"""
HEIGHTS = """
heights AS (
  SELECT CASE WHEN l_partkey%50 = 0 THEN -9999 WHEN l_partkey%50 = 1 THEN NULL
    ELSE cast(floor(l_extendedprice) AS int) - 1000 END AS gph FROM lineitem)
"""
JOINED = f"WITH {RENDERED}, {TABLES} SELECT {PUBLISHED} FROM headers JOIN levels USING (uid)"
MIDDLE = "(SELECT max(o_orderkey) // 2 FROM orders)"



def _cells(decoded: str) -> str:
    """The columns named in a list of decoded ones, as one text."""
    names = re.findall(r" AS (\w+)(?=,|$)", decoded.strip().replace("\n", " "))
    return f"concat_ws('|', {', '.join(f"coalesce(cast({n} AS varchar), 'none')" for n in names)})"


#: Published rows of the loads a then b, of files with even and with odd numbers: of equal uids the first is kept.
IN_TWO_LOADS = f"""
{MESSY},
checked AS (
  SELECT b, (b // {SOUNDINGS_PER_FILE}) % 2 AS part, header, {HEADER_UID} AS uid, length(header) <> 71 AS bad FROM heads),
accepted AS (
  SELECT b, header, uid FROM (
    SELECT *, row_number() OVER (PARTITION BY uid, bad ORDER BY part, b) AS place FROM checked)
  WHERE NOT bad AND place = 1),
sized AS (
  SELECT b, gated.uid, line FROM gated JOIN accepted USING (b) WHERE length(line) = 52)
"""

ORACLES = {
    "header_decode": f"WITH {RENDERED} SELECT {HEADER_DECODED}, {HEADER_UID} AS uid FROM raw_h",
    "spec_decode": f"WITH {RENDERED} SELECT {HEADER_DECODED}, {HEADER_UID} AS uid FROM raw_h",
    "level_decode": f"""WITH {RENDERED}
        SELECT {LEVEL_DECODED}, cast(l_orderkey AS varchar) AS uid FROM raw_l""",
    "length_filter": f"""WITH {RENDERED}
        SELECT l_orderkey, line FROM raw_l WHERE l_orderkey%5 <> 2""",
    "csv_render": f"""WITH {RENDERED},
        h AS (SELECT {HEADER_TEXT}, {HEADER_UID} AS uid FROM raw_h),
        l AS (SELECT {LEVEL_TEXT}, cast(l_orderkey AS varchar) AS uid FROM raw_l)
        SELECT concat('"',id,'",',year,',',month,',',day,',',hour,',',reltime,',',numlev,',"',p_src,
          '","',np_src,'",',lat,',',lon,',"',uid,'"') AS csv FROM h
        UNION ALL
        SELECT concat(lvltyp1,',',lvltyp2,',',etime,',',press,',"',pflag,'",',gph,',"',zflag,'",',temp,
          ',"',tflag,'",',rh,',',dpdp,',',wdir,',',wspd,',"',uid,'"') FROM l""",
    "csv_roundtrip": f"""WITH {RENDERED},
        h AS (SELECT {HEADER_DECODED}, {HEADER_UID} AS uid FROM raw_h),
        l AS (SELECT {LEVEL_DECODED}, cast(l_orderkey AS varchar) AS uid FROM raw_l)
        SELECT 'header' AS kind, uid, {_cells(HEADER_DECODED)} AS cells FROM h
        UNION ALL SELECT 'level', uid, {_cells(LEVEL_DECODED)} FROM l""",
    "block_scan_levels": f"""WITH {CLEAN},
        l AS (SELECT {HEADER_UID} AS uid, {LEVEL_DECODED} FROM lines JOIN heads USING (b))
        SELECT uid, count(*) AS levels, cast(sum(gph) AS bigint) AS sum_gph,
          cast(sum(wdir) AS bigint) AS sum_wdir, max(press) AS max_press FROM l GROUP BY uid""",
    "level_count_gate": f"WITH {MESSY} SELECT uid, cast(i AS int) AS pos, line FROM gated",
    "block_headers": f"WITH {MESSY} SELECT header FROM heads",
    "bad_header_quarantine": f"""WITH {RENDERED},
        h AS (SELECT o_orderkey, {FILE_16} AS file, {SOME_CUT} AS header FROM raw_h)
        SELECT file, o_orderkey AS seq, 'bad_header' AS reason, header FROM h WHERE {IS_BAD}""",
    "bad_header_cutoff": f"""WITH {RENDERED},
        h AS (SELECT o_orderkey AS seq, {FILE_16} AS file, {SOME_CUT} AS header FROM raw_h),
        c AS (SELECT file, min(seq) AS cutoff FROM h WHERE {IS_BAD} GROUP BY file)
        SELECT file, seq, header FROM h LEFT JOIN c USING (file) WHERE cutoff IS NULL OR seq < cutoff""",
    "header_rejects": f"""WITH {RENDERED},
        h AS (SELECT o_orderkey AS seq, {SOME_WRONG} AS header FROM raw_h),
        d AS (SELECT seq, try_cast(trim(substr(header,14,4)) AS int) AS year,
          try_cast(trim(substr(header,56,7)) AS int) AS lat, trim(substr(header,56,7)) AS lat_text FROM h)
        SELECT seq, year, lat, CASE WHEN lat IS NULL AND lat_text <> '' THEN 'malformed:lat'
          WHEN year IS NULL THEN 'null:year' END AS reason FROM d""",
    "level_rejects": f"""WITH {RENDERED}
        SELECT l_orderkey, 'malformed:gph' AS reason, concat(substr(line,1,16),' 1 2 ',substr(line,22)) AS line
        FROM raw_l WHERE l_orderkey%19 = 3""",
    "control_checks": f"""WITH {CONTROL}
        SELECT id, CASE WHEN skip_execution IS NULL THEN 'null:skip_execution'
          WHEN full_load IS NULL THEN 'null:full_load'
          WHEN length(skip_execution) > 1 THEN 'width:skip_execution' END AS reason FROM control""",
    "uid_first_wins": """WITH k AS (
          SELECT o_orderkey, o_custkey, row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_orderkey % 16, o_orderkey) AS r FROM orders)
        SELECT o_orderkey AS seq FROM k WHERE r = 1 AND o_custkey >= 10""",
    "uid_file_reject": f"""WITH RECURSIVE keys AS (
          SELECT o_orderkey % 64 AS f, CASE WHEN o_orderkey%997 = 0 THEN o_orderkey+1
            WHEN o_orderkey%4999 = 3 THEN o_orderkey+64 ELSE o_orderkey END AS uid FROM orders),
        {ACCEPTED_FILES}
        SELECT concat('f', lpad(cast(f AS varchar), 3, '0')) AS file FROM files
        WHERE NOT list_contains((SELECT accepted FROM walk ORDER BY i DESC LIMIT 1), f)""",
    "serial_numbers": """SELECT 1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS header_id,
        o_orderkey FROM orders""",
    "max_header": "SELECT max(o_orderkey) AS max_head FROM orders",
    "max_header_empty": "SELECT max(o_orderkey) AS max_head FROM orders WHERE o_orderkey < 0",
    "full_load": JOINED,
    "delta_load": f"{JOINED} WHERE header_id > {MIDDLE}",
    "delta_load_inclusive": f"{JOINED} WHERE header_id >= {MIDDLE}",
    "full_load_padded": f"""WITH {RENDERED}, {TABLES}
        SELECT rpad(id,12,' ') AS id, rpad(p_src,10,' ') AS p_src, rpad(np_src,10,' ') AS np_src,
          rpad(pflag,3,' ') AS pflag, rpad(zflag,3,' ') AS zflag, rpad(tflag,3,' ') AS tflag, gph
        FROM headers JOIN levels USING (uid)""",
    "altitude_band": f"WITH {HEIGHTS} SELECT gph, {BAND} AS partition_gph FROM heights",
    "altitude_band_uncapped": f"""WITH {HEIGHTS}
        SELECT gph, CASE WHEN gph = -9999 THEN NULL WHEN gph <= 1000 THEN 1
          ELSE (gph + 999) // 1000 END AS altitude_band FROM heights""",
    "band_counts": f"""WITH j AS (
          SELECT cast(floor(l_extendedprice/10) AS int) AS gph FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
        SELECT {BAND} AS partition_gph, count(*) AS rows, cast(sum(gph) AS bigint) AS sum_gph,
          max(gph) AS max_gph FROM j GROUP BY 1""",
    "partitioned_roundtrip": f"""WITH {RENDERED}, {TABLES}
        SELECT {BAND} AS partition_gph, count(*) AS rows, cast(sum(gph) AS bigint) AS sum_gph,
          cast(sum(wspd) AS bigint) AS sum_wspd FROM headers JOIN levels USING (uid) GROUP BY 1""",
    "control_select": f"""WITH {CONTROL} SELECT id, etl_name, skip_execution FROM control
        WHERE etl_name = 'BUILDING' AND skip_execution <> 'Y'""",
    "control_first_row": f"""WITH {CONTROL}
        SELECT id, full_load, filter_col1_name, filter_col1_value FROM control
        WHERE etl_name = 'BUILDING' AND skip_execution <> 'Y' ORDER BY id LIMIT 1""",
    "control_advance": f"""WITH {CONTROL}
        SELECT id, etl_name, skip_execution, CASE WHEN id = 7 THEN 'N' ELSE full_load END AS full_load,
          filter_col1_name, CASE WHEN id = 7 THEN cast((SELECT max(o_orderkey) FROM orders) AS varchar)
          ELSE filter_col1_value END AS filter_col1_value FROM control""",
    "control_load_mode": f"""WITH {CONTROL}
        SELECT id, CASE WHEN upper(full_load) = 'Y' THEN 'full'
          WHEN upper(filter_col1_name) = 'HEADER_ID' AND filter_col1_value IS NULL THEN 'full'
          WHEN upper(filter_col1_name) = 'HEADER_ID' THEN 'delta' ELSE 'invalid' END AS mode FROM control""",
    "route_files": """WITH f AS (
          SELECT concat(CASE p_partkey%4 WHEN 0 THEN 'headers-' WHEN 1 THEN 'records-'
            WHEN 2 THEN 'Headers-' ELSE '' END, replace(p_name,' ','.'),
            CASE p_size%4 WHEN 0 THEN '.csv' WHEN 1 THEN '.CSV' WHEN 2 THEN '.txt' ELSE '' END) AS name FROM part),
        d AS (SELECT name, strpos(reverse(name), '.') AS dot FROM f),
        s AS (SELECT name, CASE WHEN dot = 0 THEN '' ELSE substr(name, 1, length(name) - dot) END AS stem,
          CASE WHEN dot = 0 THEN '' ELSE substr(name, length(name) - dot + 2) END AS extension FROM d)
        SELECT name, stem, extension, CASE WHEN lower(extension) <> 'csv' THEN NULL
          WHEN starts_with(name, 'headers-') THEN 'header'
          WHEN starts_with(name, 'records-') THEN 'level' END AS route FROM s""",
    "datetime_texts": """SELECT event_id, concat(day(ts), '/', month(ts), '/', year(ts), ' ',
        hour(ts), ':', minute(ts), ':', second(ts)) AS text FROM events""",
    "field_texts": """SELECT cast(event_id AS varchar) AS known, cast(user_id AS varchar) AS other_case,
        cast(NULL AS varchar) AS absent FROM events""",
    "error_rows": """SELECT p_type AS etl_name, '' AS client_name,
        replace(concat('can''t load ''', p_name, ''''), '''', '''''') AS exception_message FROM part""",
    "ingest_headers": f"WITH {LOADED} SELECT header_id, {HEADER_DECODED}, uid FROM accepted",
    "ingest_levels": f"WITH {LOADED} SELECT {LEVEL_DECODED}, uid FROM sized WHERE {LEVEL_OK}",
    "ingest_quarantine": f"""WITH {LOADED},
        refused AS (
          SELECT uid, 'block' AS scope, reason FROM judged WHERE reason IS NOT NULL
          UNION ALL SELECT uid, 'level', 'malformed:gph' FROM sized WHERE NOT ({LEVEL_OK}))
        SELECT uid, scope, reason, count(*) AS rows FROM refused GROUP BY uid, scope, reason""",
    "load_counts": f"""WITH {LOADED}
        SELECT 'first' AS load_id, (SELECT count(*) FROM heads) AS blocks,
          (SELECT count(*) FROM accepted) AS headers,
          (SELECT count(*) FROM sized WHERE {LEVEL_OK}) AS levels""",
    "spec_ingest": f"""WITH {LOADED},
        h AS (SELECT uid, trim(substr(header,47,8)) AS p_src, trim(substr(header,38,8)) AS np_src,
          try_cast(trim(substr(header,64,8)) AS int) AS lat, try_cast(trim(substr(header,56,7)) AS int) AS lon
          FROM accepted),
        l AS (SELECT uid, count(*) AS levels,
          cast(sum(try_cast(trim(substr(line,35,5)) AS int)) AS bigint) AS sum_gph,
          cast(sum(try_cast(trim(substr(line,17,5)) AS int)) AS bigint) AS sum_dpdp
          FROM sized WHERE {LEVEL_OK} GROUP BY uid)
        SELECT uid, p_src, np_src, lat, lon, levels, sum_gph, sum_dpdp FROM h JOIN l USING (uid)""",
    "ingest_whole_files": f"""WITH RECURSIVE {MESSY},
        blocks AS (SELECT b, b // {SOUNDINGS_PER_FILE} AS f, {HEADER_UID} AS uid, length(header) <> 71 AS bad FROM heads),
        cuts AS (SELECT f, min(b) AS cutoff FROM blocks WHERE bad GROUP BY f),
        placed AS (SELECT blocks.*, coalesce(b >= cutoff, false) AS lost FROM blocks LEFT JOIN cuts USING (f)),
        keys AS (SELECT f, uid FROM placed WHERE NOT lost),
        {ACCEPTED_FILES},
        accepted AS (SELECT unnest(files) AS f FROM (SELECT accepted AS files FROM walk ORDER BY i DESC LIMIT 1)),
        sized AS (SELECT f, {LEVEL_OK} AS ok FROM gated JOIN placed USING (b) WHERE NOT lost AND length(line) = 52),
        wrong AS (SELECT DISTINCT f FROM sized WHERE NOT ok),
        outcome AS (
          SELECT 'block after_bad_header' AS kind, f FROM placed WHERE lost
          UNION ALL SELECT CASE WHEN f IN (SELECT f FROM accepted) THEN 'header' ELSE 'header_file file_refused' END, f FROM keys
          UNION ALL SELECT CASE WHEN f NOT IN (SELECT f FROM wrong) THEN 'level' WHEN ok THEN 'level_file file_refused'
            ELSE 'level_file malformed:gph' END, f FROM sized)
        SELECT kind, concat('f', lpad(cast(f AS varchar), 8, '0'), '.txt') AS file, count(*) AS rows
        FROM outcome GROUP BY kind, f""",
    "staged_load": """WITH h AS (
          SELECT cast(CASE WHEN o_orderkey%7 = 3 THEN o_orderkey - o_orderkey%64 ELSE o_orderkey END AS varchar) AS uid,
            o_orderkey%31 = 1 AS no_year FROM orders),
        l AS (SELECT cast(l_orderkey AS varchar) AS uid, l_orderkey%29 = 3 AS wide FROM lineitem)
        SELECT 'header' AS kind, uid, cast(1 AS bigint) AS rows FROM h WHERE NOT no_year GROUP BY uid
        UNION ALL SELECT 'header duplicate_uid', uid, count(*) - 1 FROM h WHERE NOT no_year GROUP BY uid HAVING count(*) > 1
        UNION ALL SELECT 'header null:year', uid, count(*) FROM h WHERE no_year GROUP BY uid
        UNION ALL SELECT 'level', uid, count(*) FROM l WHERE NOT wide GROUP BY uid
        UNION ALL SELECT 'level width:pflag', uid, count(*) FROM l WHERE wide GROUP BY uid""",
    "incremental_pickup": f"""WITH {LOADED}
        SELECT header_id, uid, try_cast(trim(substr(header,33,4)) AS int) AS numlev FROM accepted""",
    "published_runs": f"""WITH {LOADED},
        h AS (SELECT uid, {HEADER_DECODED} FROM accepted),
        l AS (SELECT uid, {LEVEL_DECODED} FROM sized WHERE {LEVEL_OK})
        SELECT {PUBLISHED}, {BAND} AS partition_gph FROM h JOIN l USING (uid)""",
    "control_after_runs": f"""WITH {LOADED}
        SELECT 1 AS id, 'soundings' AS etl_name, 'N' AS skip_execution, 'N' AS full_load,
          'HEADER_ID' AS filter_col1_name, cast(max(header_id) AS varchar) AS filter_col1_value FROM accepted""",
    "processed_ledger": f"""WITH {MESSY}
        SELECT header FROM heads WHERE b > (SELECT max(b) // 2 FROM heads)""",
    "published_jobs": f"""WITH {IN_TWO_LOADS},
        h AS (SELECT uid, {HEADER_DECODED} FROM accepted),
        l AS (SELECT uid, {LEVEL_DECODED} FROM sized WHERE {LEVEL_OK})
        SELECT {PUBLISHED}, {BAND} AS partition_gph FROM h JOIN l USING (uid)""",
}
