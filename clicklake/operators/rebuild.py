"""Incremental rebuild of the refined layer, equal to a full rebuild for late, moved and vanished rows.

Only a list of dates ever reaches the driver; its length is bounded by the calendar.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from clicklake.functions.web import enrich_clicks
from clicklake.operators.cleaning import valid_row
from clicklake.operators.versions import TIEBREAK, content_hash, latest_versions, newest
from clicklake.schemas import CLICK_TABLE, TableSpec


def enrich(df: DataFrame, spec: TableSpec) -> DataFrame:
    return enrich_clicks(df) if spec.name == "clicks" else df.withColumn("event_date", F.to_date(spec.event_column))


def refine(bronze: DataFrame, spec: TableSpec = CLICK_TABLE) -> DataFrame:
    """The full refined table: clean, then latest version per key, then derived columns.

    Cleaning comes first, so an invalid newest version does not hide an older valid one.
    """
    return enrich(latest_versions(bronze.filter(valid_row(spec)), spec), spec)


#: Numbered keys this far apart are held to be neighbours, and so many runs of neighbours are told apart.
NEIGHBOURS, RUNS = 1 << 24, 64


#: The keys of so many rows are sent to every executor, so that history that does not hold them is dropped where it is read.
FEW_ROWS = 500_000


def _numbered(spec: TableSpec) -> bool:
    return isinstance(spec.schema[spec.key].dataType, NumericType)


def key_blocks(rows: DataFrame, spec: TableSpec) -> list[tuple]:
    """For each block of neighbours its lowest and highest key in ``rows``, and how many rows lie between; one block for keys without numbers."""
    key = F.col(spec.key)
    block = F.floor(key / F.lit(NEIGHBOURS)) if _numbered(spec) else F.lit(0)
    told = [F.min(key), F.max(key), F.count(F.lit(1))]
    return [tuple(row)[1:] for row in rows.where(key.isNotNull()).groupBy(block.alias("block")).agg(*told).collect()]


def key_ranges(rows: DataFrame, spec: TableSpec) -> Column | None:
    """A test that the keys of ``rows`` pass and most others don't; None when they hold no key.

    All bounds are literals, so that a scan skips files and row groups by their statistics: raw files are sorted by
    key, and keys that arrive together lie together. Numbered keys are tested by up to ``RUNS`` ranges, so that an old key among new ones
    does not open all that lies between them.
    """
    return ranges_over(key_blocks(rows, spec), spec)


def ranges_over(blocks: list[tuple], spec: TableSpec) -> Column | None:
    """``key_ranges`` of the rows that ``key_blocks`` tells of."""
    key, runs = F.col(spec.key), sorted((low, high) for low, high, _ in blocks)
    if not runs:
        return None
    gaps = sorted((b[0] - a[1] for a, b in zip(runs, runs[1:])), reverse=True)[: RUNS - 1] if _numbered(spec) else []
    widest, joined = min((g for g in gaps if g > NEIGHBOURS), default=None), [runs[0]]
    for low, high in runs[1:]:
        if widest is not None and low - joined[-1][1] >= widest:
            joined.append((low, high))
        else:
            joined[-1] = (joined[-1][0], high)
    # gaps that are equally wide may give a few more runs; those count as one from there on
    if len(joined) > RUNS:
        joined = [*joined[: RUNS - 1], (joined[RUNS - 1][0], joined[-1][1])]
    return reduce(Column.__or__, [key.between(F.lit(low), F.lit(high)) for low, high in joined])


def touched_dates(bronze: DataFrame, touched: Column, spec: TableSpec = CLICK_TABLE) -> DataFrame:
    """Event dates of every version of each key that has a version in the ``touched`` rows.

    One way for any number of keys, and without an index: history is cut to the slice's ranges of keys by the scan, then reduced to the
    slice's keys by a semi join, which adaptive execution broadcasts where the slice turns out small and splits where a
    key is hot. Versions without an event time have no date.
    """
    slice_keys = bronze.filter(touched).select(spec.key)
    inside = key_ranges(slice_keys, spec)
    versions = bronze.filter(F.lit(False) if inside is None else inside & F.col(spec.event_column).isNotNull())
    keys = slice_keys.filter(F.col(spec.key).isNotNull()).distinct()
    dated = versions.select(spec.key, F.to_date(spec.event_column).alias("event_date"))
    return dated.join(keys, spec.key, "left_semi").select("event_date").distinct()


def date_list(dates: DataFrame) -> list[date]:
    return sorted(row[0] for row in dates.collect() if row[0] is not None)


@dataclass(frozen=True)
class OnDates:
    """What a rebuild has to know of the raw rows on its dates: the first day they changed, whether some have no such day, and their
    ``key_blocks``, of valid rows only.
    """

    first: date | None
    undated: bool
    blocks: list[tuple]


def rows_on(bronze: DataFrame, dates: list[date], spec: TableSpec = CLICK_TABLE) -> OnDates:
    """One scan of a few columns of the row groups that reach into ``dates``."""
    valid, key = valid_row(spec), F.col(spec.key)
    block = F.floor(key / F.lit(NEIGHBOURS)) if _numbered(spec) else F.lit(0)
    told = [
        F.min("extract_date"),
        F.max(F.col("extract_date").isNull()),
        F.min(F.when(valid, key)),
        F.max(F.when(valid, key)),
        F.count_if(valid),
    ]
    found = [tuple(row)[1:] for row in bronze.filter(_reaching(dates, spec)).groupBy(block.alias("block")).agg(*told).collect()]
    first = min((day for day, *_ in found if day is not None), default=None)
    return OnDates(first, any(undated for _, undated, *_ in found), [tuple(rest) for _, _, *rest in found if rest[-1]])


def _reaching(dates: list[date], spec: TableSpec) -> Column:
    return (
        (F.col(spec.event_column) >= F.lit(min(dates)))
        & (F.col(spec.event_column) < F.lit(max(dates) + timedelta(days=1)))
        & F.to_date(spec.event_column).isin(dates)
    )


def competing_rows(
    bronze: DataFrame, dates: list[date], spec: TableSpec = CLICK_TABLE, found: OnDates | None = None
) -> DataFrame:
    """The raw rows that can decide who wins a key on ``dates``, by whole partitions.

    ``extract_date`` is the day a version changed, and the latest change wins. So a partition older than
    every row on ``dates`` holds only losers against them, and history before the first such partition is
    never read. Finding it reads two date columns of the row groups that reach into ``dates``, unless ``found`` tells it.
    """
    if found:
        first, has_undated = found.first, found.undated
    else:
        undated = F.coalesce(F.max(F.col("extract_date").isNull()), F.lit(False))
        first, has_undated = bronze.filter(_reaching(dates, spec)).agg(F.min("extract_date"), undated).first()
    if first is None:
        return bronze if has_undated else bronze.filter(F.lit(False))
    since = F.col("extract_date") >= F.lit(first)
    return bronze if has_undated else bronze.filter(since)


def refine_dates(
    bronze: DataFrame, dates: list[date], spec: TableSpec = CLICK_TABLE, found: OnDates | None = None
) -> DataFrame:
    """The refined rows of ``dates``, as a full rebuild would leave them.

    A version on another date can still win a key, so all of them compete, but only rows on ``dates``
    carry their payload through the shuffle; the others are a key and what orders them. Keys outside the ranges
    of those on ``dates`` are not read. Where ``dates`` have few rows, versions of other keys go no further than a semi join with a broadcast;
    to join many keys would shuffle and sort all versions a second time, so there the winners without payload are dropped instead.
    The ranges take a scan, unless ``found`` tells them.
    """
    on_dates = valid_row(spec) & F.to_date(spec.event_column).isin(dates)
    keys = bronze.filter(on_dates).select(spec.key)
    blocks = found.blocks if found else key_blocks(keys, spec) if dates else []
    inside = ranges_over(blocks, spec)
    if inside is None:
        return refine(bronze.limit(0), spec)
    ordering = [spec.key, spec.change_column, spec.event_column]
    if "batch_id" in bronze.columns:
        ordering.append("batch_id")
    payload = F.struct(*[c for c in bronze.columns if c not in ordering])
    versions = bronze.filter(valid_row(spec) & inside).select(
        *ordering,
        content_hash(spec).alias(TIEBREAK),
        F.when(F.to_date(spec.event_column).isin(dates), payload).alias("payload"),
    )
    if sum(rows for _, _, rows in blocks) <= FEW_ROWS:
        versions = versions.join(F.broadcast(keys.distinct()), spec.key, "left_semi")
    winners = newest(versions, spec).filter("payload IS NOT NULL")
    columns = [F.col(c) if c in ordering else F.col("payload")[c].alias(c) for c in bronze.columns]
    return enrich(winners.select(*columns), spec)
