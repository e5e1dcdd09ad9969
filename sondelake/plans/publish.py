"""Publish: joined header and level rows as a dataset partitioned by altitude band."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondelake.operators.control import DELTA_MODE, INVALID_MODE, runnable
from sondelake.operators.extract import extract, id_range, max_header_id, pad_text, publish_columns, with_band
from sondelake.plans.lake import Lake
from sondelake.sources.published import Conflict, published_runs, unpublished, write_run
from sondelake.sources.tables import LOAD_COLUMN


@dataclass(frozen=True)
class Published:
    """What a run did: its mode and the range of header ids it published."""

    mode: str
    after_id: int | None
    up_to_id: int


def _colocated(loads: DataFrame, hi: int, lo: int | None, inclusive: bool) -> DataFrame:
    """(load) of the loads that lie wholly in the id range and whose levels carry their header's columns."""
    inside = id_range(hi, lo, inclusive=inclusive, column="first_id") & id_range(hi, lo, inclusive=inclusive, column="last_id")
    return loads.where(F.col("colocated") & inside).select(LOAD_COLUMN)


def _to_join(lake: Lake, loads: DataFrame, hi: int, lo: int | None, inclusive: bool) -> DataFrame:
    """(load) of the other loads with headers in the id range."""
    meets = F.col("first_id") <= hi
    if lo is not None:
        meets &= (F.col("last_id") >= lo) if inclusive else (F.col("last_id") > lo)
    rest = loads.where(meets).select(LOAD_COLUMN).join(_colocated(loads, hi, lo, inclusive), LOAD_COLUMN, "left_anti")
    # Headers of a load without a row of ids: written before there were any, or the load died.
    unknown = lake.headers.read().select(LOAD_COLUMN).distinct().join(loads.select(LOAD_COLUMN), LOAD_COLUMN, "left_anti")
    return rest.union(unknown)


def published_rows(
    lake: Lake, hi: int, lo: int | None = None, *, inclusive: bool = False
) -> DataFrame:
    """Published columns of an id range of the lake.

    Loads by the rules for blocks keep the header's columns beside its levels: where such a load lies
    wholly in the range, its level folder is the result and nothing is joined. Other loads (staged
    ones, and those that the range cuts) are joined with their headers. Either way only the level
    folders of loads in the range are read, pruned by a broadcast of one short row per load: the cost
    of a delta follows the new data, not the size of the lake.
    """
    lake.check_rules()
    headers, levels = lake.headers.read(), lake.levels.read()
    if lake.whole_files:
        # Levels of a load that failed come again with the load that repeats its files.
        finished = lake.ledger.read().select(LOAD_COLUMN).distinct()
        levels = levels.join(F.broadcast(finished), LOAD_COLUMN, "left_semi")
        return extract(headers, levels, hi, lo, inclusive=inclusive)
    loads = lake.ranges.read()
    wide = lake.levels.read(beside=True)
    whole = F.broadcast(_colocated(loads, hi, lo, inclusive))
    rest = _to_join(lake, loads, hi, lo, inclusive)
    if rest.isEmpty():
        return publish_columns(wide.join(whole, LOAD_COLUMN, "left_semi"))
    rest = F.broadcast(rest)
    chosen, own = (table.join(rest, LOAD_COLUMN, "left_semi") for table in (headers, levels))
    joined = extract(chosen, own, hi, lo, inclusive=inclusive, on=(LOAD_COLUMN, "uid"))
    if not lake.levels.beside.names:
        return joined
    return publish_columns(wide.join(whole, LOAD_COLUMN, "left_semi")).union(joined)


def _publish_delta(lake: Lake, lo: int, hi: int, inclusive: bool, finish: Callable[[DataFrame], DataFrame]) -> None:
    """Publish what no run holds yet of the ids above ``lo`` up to ``hi``.

    Another job, or a mark that was set back, may have published a part. If a run comes in between, what
    is left is looked up anew.
    """
    while True:
        runs = published_runs(lake.spark, lake.published_path)
        gaps = [(after, up_to, False) for after, up_to in unpublished(runs, lo, hi)]
        if inclusive and not any(r.inclusive and r.after == lo for r in runs):
            # The rows of the last id are asked for once more: with the next ones, or alone.
            first = gaps[0][:2] if gaps and gaps[0][0] == lo else (lo, lo)
            gaps = [(*first, True), *(g for g in gaps if g[:2] != first)]
        try:
            for after, up_to, repeat in gaps:
                rows = published_rows(lake, up_to, after, inclusive=repeat)
                write_run(finish(rows), lake.published_path, after, up_to, repeat)
            return
        except Conflict:
            if published_runs(lake.spark, lake.published_path) == runs:
                raise


def publish(
    lake: Lake, etl_name: str, *, inclusive: bool = False, padded: bool = False
) -> Published | None:
    """Run the publishing job ``etl_name`` as its control row says.

    Nothing happens without a runnable control row or without headers. The control row advances
    only after the rows are written; an error is logged and raised. Ids that another run has
    published are left out, so several jobs may share a lake, and a mark may be set back.
    """

    def finish(rows: DataFrame) -> DataFrame:
        return with_band(pad_text(rows) if padded else rows)

    with lake.logged("publish"):
        row = lake.control.current(etl_name)
        if row is None:
            return None
        if row.load_mode == INVALID_MODE:
            raise ValueError(f"control row {row.id} cannot range over {row.filter_col1_name!r}")
        hi = max_header_id(lake.headers.read()).head()[0]
        if hi is None:
            return None
        lo = int(row.filter_col1_value) if row.load_mode == DELTA_MODE else None
        if lo is None:

            def late(after: int, up_to: int) -> DataFrame:
                return finish(published_rows(lake, up_to, after))

            write_run(finish(published_rows(lake, hi)), lake.published_path, None, hi, False, late)
        elif lo < hi or inclusive:
            _publish_delta(lake, lo, max(lo, hi), inclusive, finish)
        # A mark above all ids stays: going back would publish later loads again.
        lake.control.advance(row.id, hi if lo is None else max(lo, hi))
    return Published(row.load_mode, lo, hi)


#: Named building blocks of the job, each a function of the lake and typed parameters.
NAMED_QUERIES = {
    "control": lambda lake, etl_name: runnable(lake.control.rows(), etl_name),
    "max_header": lambda lake: max_header_id(lake.headers.read()),
    "full_load": lambda lake, hi: published_rows(lake, hi),
    "delta_load": lambda lake, hi, lo, inclusive=False: published_rows(
        lake, hi, lo, inclusive=inclusive
    ),
}


def named_query(lake: Lake, name: str, **parameters) -> DataFrame:
    if name not in NAMED_QUERIES:
        raise ValueError(f"unknown query {name!r}; known: {', '.join(NAMED_QUERIES)}")
    return NAMED_QUERIES[name](lake, **parameters)
