"""Incremental runs over a day-partitioned event log.

New event files are handled by recomputing the *days they touch* from all
events of those days:

  readStream (file source, new files only)
    -> foreachBatch: distinct days of the batch
       -> re-read the whole days from the table (a list of day keys in both
          day forms, so partitions are pruned)
       -> run the mart -> replace those days, remove the ones left without rows

A mart whose rows also depend on the days before theirs (an attribution with
a tolerance) says so with ``lookback_days``: then the days after a touched
one are recomputed too, and everything is read from ``lookback_days`` earlier.
Marts that need the whole history (the order mart's user sequence) do not
fit and are run as batch jobs.

The stream's checkpoint lives in the session's shared checkpoint folder,
so a restarted job (or one that lost executors) resumes where it stopped;
replaying a batch rewrites the same day partitions (idempotent).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import parse_day
from ..session import scratch_path
from ..sources.sink import write_by_day


def day_keys(days) -> list[str]:
    """Dates as day strings in both forms."""
    return [f"{d:{form}}" for d in sorted(days) for form in ("%Y%m%d", "%Y-%m-%d")]


def day_mart_stream(spark: SparkSession, events_path: str, mart: Callable[[DataFrame], DataFrame],
                    out_path: str, out_day_col: str = "time_date", dt_col: str = "dt",
                    name: str = "day-mart", checkpoint: str | None = None,
                    available_now: bool = True, max_files_per_trigger: int | None = None,
                    lookback_days: int = 0, tasks_per_day: int | None = None) -> StreamingQuery:
    """Start the incremental runner; returns the streaming query.

    ``mart`` maps events to mart rows (e.g. ``lambda ev: event_funnel(ev,
    params)``); its output must carry ``out_day_col``.  Events with a bad day
    belong to no day and are left out.
    """
    schema = spark.read.parquet(events_path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(events_path)
    key = F.col(dt_col).cast("string")

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        touched = {r[0] for r in batch.select(parse_day(key)).distinct().collect()} - {None}  # one row a day
        if not touched:
            return
        span = [dt.timedelta(i) for i in range(lookback_days + 1)]
        days = {d + s for d in touched for s in span}
        read = {d - s for d in days for s in span}
        out = mart(spark.read.parquet(events_path).where(key.isin(day_keys(read))))
        raw = F.col(out_day_col).cast("string")
        write_by_day(out.where(raw.isin(day_keys(days))), out_path, out_day_col, days=day_keys(days),
                     tasks_per_day=tasks_per_day)

    w = (stream.writeStream.foreachBatch(run_batch)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{name}"))
         .queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
