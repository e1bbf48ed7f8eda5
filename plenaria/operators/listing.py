"""Listings of two sources: routing by date, filters, order and slices."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: sittings before this day are in the archive.
CUTOFF = dt.date(2013, 3, 28)


@dataclass(frozen=True)
class ListOptions:
    start: dt.date | None = None
    end: dt.date | None = None
    house: str | None = None
    page: int = 1
    all: bool = False
    limit: int | None = None
    offset: int | None = None
    page_size: int = 20

    def __post_init__(self):
        if self.start and self.end and self.start > self.end:
            raise ValueError("start is after end")
        if (self.limit is not None and self.limit <= 0) or (self.offset is not None and self.offset <= 0):
            raise ValueError("limit and offset are above 0")
        if self.all and self.page != 1:
            raise ValueError("a page and all pages exclude each other")


def route(start: dt.date | None, end: dt.date | None, cutoff: dt.date = CUTOFF) -> str:
    """current, archive or both."""
    if start is None and end is None:
        return "current"
    if end is not None and end < cutoff:
        return "archive"
    return "current" if start is not None and start >= cutoff else "both"


def between(df: DataFrame, start=None, end=None, column: str = "date") -> DataFrame:
    """Both ends included; a missing one is open."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    return df.filter(F.col(column) <= F.lit(end)) if end is not None else df


def ordered_slice(df: DataFrame, order: list, offset: int | None = None, limit: int | None = None) -> DataFrame:
    """Rows offset to offset + limit in order; beyond the end: none. One TakeOrderedAndProject."""
    df = df.orderBy(*order)
    df = df.offset(offset) if offset else df
    return df.limit(limit) if limit is not None else df


def list_sittings(archive: DataFrame, current: DataFrame, options: ListOptions, cutoff: dt.date = CUTOFF) -> DataFrame:
    """Merged listings, newest first (ties by url). Both sources: a bag, the archive up to the day before the
    cutoff and from start on, the current one up to end."""
    where = route(options.start, options.end, cutoff)
    if where == "archive":
        out = between(archive, options.start, options.end)
    elif where == "current":
        out = between(current, options.start, options.end)
    else:
        out = between(archive, options.start, min(options.end or dt.date.max, cutoff - dt.timedelta(1))).unionByName(between(current, None, options.end))
    if options.house:
        out = out.filter(F.col("house") == options.house)
    order = [F.desc("date"), F.asc("url")]
    if where == "current" and options.start is None and options.end is None and not options.all:
        return ordered_slice(ordered_slice(out, order, (options.page - 1) * options.page_size, options.page_size), order, options.offset, options.limit)
    return ordered_slice(out, order, options.offset, options.limit)


def skip_ingested(listings: DataFrame, stored: DataFrame) -> DataFrame:
    return listings.join(stored.select("url"), "url", "left_anti")


def envelope(df: DataFrame, order: list[str], offset: int = 0, limit: int | None = None) -> DataFrame:
    """One row {count, data} of a slice in order, the answer of a tool: count is that of the slice as asked for, data its rows. A slice with
    a limit is one TakeOrderedAndProject; without one all rows come together, as in any answer that is one value."""
    part = ordered_slice(df, order, offset, limit)
    return part.agg(F.count("*").alias("count"), F.sort_array(F.collect_list(F.struct(*order, *[c for c in df.columns if c not in order]))).alias("data"))
