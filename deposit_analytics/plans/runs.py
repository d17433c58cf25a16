"""Runs a report over many snapshot dates and stores it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from deposit_analytics.functions.calendar import Calendar
from deposit_analytics.sources import sinks


def store_snapshots(
    result: DataFrame, path: str, rerun: bool = True, calendar: Calendar | None = None
) -> tuple[DataFrame, int]:
    """Writes a report of any number of dates in one job.

    Returns the stored table and the number of rows written. ``rerun=True``
    replaces the dates in ``result``; ``rerun=False`` appends. Give a rerun the
    ``calendar`` of the report: dates of it that have no rows any more are then
    removed from the table, after the new rows are stored. Dates outside the
    calendar are never touched. Later steps should read the returned table: it costs a file scan, not the whole report
    again, and losing executors does not bring the report back either.
    """
    observation = Observation("stored")
    if rerun:
        sinks.overwrite_snapshots(result, path, observation)
        if calendar is not None:
            written = set(observation.get["snapshots"])
            sinks.drop_snapshots(result.sparkSession, path, [one for one in calendar.dates() if one not in written])
    else:
        sinks.write_parquet(result, path, "append", observation=observation)
    stored = sinks.read_parquet_result(result.sparkSession, path, result.schema)
    return stored, observation.get["rows"]
