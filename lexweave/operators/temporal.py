"""Snapshots, differences and timelines of records that are in force from a start to an end day. Both days are inclusive; a null
start means since ever, a null end until ever. ``today`` and all other days are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import OPEN_END, OPEN_START


def _day(day: str | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def _from(start: str) -> Column:
    return F.coalesce(F.col(start), F.lit(OPEN_START).cast("date"))


def _until(end: str) -> Column:
    return F.coalesce(F.col(end), F.lit(OPEN_END).cast("date"))


def in_force(day: str | Column, start: str = "start_date", end: str = "end_date") -> Column:
    """In force on a day."""
    return (_from(start) <= _day(day)) & (_until(end) >= _day(day))


def as_of(df: DataFrame, day: str, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """The rows in force on a day."""
    return df.where(in_force(day, start, end))


def visible_after(df: DataFrame, day: str, end: str = "end_date") -> DataFrame:
    """The rows not ended before a day."""
    return df.where(_until(end) >= _day(day))


def altered(df: DataFrame, day: str, today: str, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """The rows not ended before a day that began or end after it, up to today."""
    within = lambda c: (F.col(c) > _day(day)) & (F.col(c) <= _day(today))
    return visible_after(df, day, end).where(within(start) | within(end))


def starting_from(df: DataFrame, day: str, start: str = "start_date") -> DataFrame:
    """The rows that start on a day or later, or have no start."""
    return df.where((F.col(start) >= _day(day)) | F.col(start).isNull())


def temporal_diff(df: DataFrame, first: str, last: str, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """The rows that differ between two days, with ``change_type``: ``Added`` (in force on the last day only), ``Removed`` (on the
    first only), or ``Restricted`` (else, if both start and end lie after the first day and not after the last)."""
    before, after = in_force(first, start, end), in_force(last, start, end)
    moved = lambda c: F.coalesce((F.col(c) > _day(first)) & (F.col(c) <= _day(last)), F.lit(False))
    change = F.when(~before & after, "Added").when(before & ~after, "Removed").when(moved(start) & moved(end), "Restricted")
    return df.withColumn("change_type", change).where(F.col("change_type").isNotNull())


def change_counts(diff: DataFrame) -> DataFrame:
    """One row: ``added, removed, restricted``."""
    return diff.agg(*(F.count_if(F.col("change_type") == t).alias(t.lower()) for t in ("Added", "Removed", "Restricted")))


def amendment_timeline(diff: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Changes per year and kind: additions by their start, removals by their end, restrictions by both. Rows without the day are left
    out: ``year`` (first day of it), ``event, n_events``."""
    change = F.col("change_type")
    event = lambda day, name: F.struct(F.col(day).alias("day"), F.lit(name).alias("event"))
    events = (
        F.when(change == "Added", F.array(event(start, "Added"))).when(change == "Removed", F.array(event(end, "Removed")))
        .otherwise(F.array(event(start, "Restricted (start)"), event(end, "Restricted (end)")))
    )
    rows = diff.select(F.inline(events).alias("day", "event")).where(F.col("day").isNotNull())
    return rows.groupBy(F.trunc("day", "YEAR").alias("year"), "event").agg(F.count(F.lit(1)).alias("n_events"))


def yearly_series(df: DataFrame, day: str) -> DataFrame:
    """Rows per year of a day; rows without one are left out: ``year`` (text), ``n_rows``."""
    return df.where(F.col(day).isNotNull()).groupBy(F.date_format(day, "yyyy").alias("year")).agg(F.count(F.lit(1)).alias("n_rows"))
