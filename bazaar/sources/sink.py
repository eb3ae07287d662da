"""Mart sink: write a mart partitioned by day.  A run replaces the days it
recomputed and no others, so a rerun of a day is idempotent."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.scan import quoted


def write_by_day(df: DataFrame, path: str, day_col: str, fmt: str = "parquet",
                 days: Iterable | None = None, tasks_per_day: int | None = None) -> list[str]:
    """Write ``df`` under ``path/<day_col>=<day>/`` and return the days written.

    ``days`` is the run's manifest: the days it recomputed (dates or day
    strings, as ``day_col`` holds them).  A day of the manifest for which
    ``df`` has no rows is removed, after the other days are in place; days
    outside it are only ever replaced by rows of ``df``.  Without a manifest
    nothing is removed.

    ``tasks_per_day`` deals the rows of a day to that many writer tasks by a
    hash of the row (so many files a day at most); None keeps the frame's
    partitioning.
    """
    out = df
    if tasks_per_day:
        hashable = [quoted(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        out = df.repartition(F.col(quoted(day_col)), F.pmod(F.xxhash64(*hashable), F.lit(tasks_per_day)))
    seen = Observation()
    out = out.observe(seen, F.collect_set(F.col(quoted(day_col)).cast("string")).alias("days"))
    (out.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(day_col)
     .format(fmt)
     .save(path))
    written = sorted(seen.get["days"])
    for day in {str(d) for d in days or ()} - set(written):
        _remove(df.sparkSession, f"{path.rstrip('/')}/{day_col}={day}")
    return written


def _remove(spark: SparkSession, folder: str) -> None:
    """Delete a partition folder, on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int,
                  location: str | None = None, fmt: str = "parquet") -> None:
    """Save a source table bucketed and sorted by ``keys``.

    Tables bucketed on the same keys with the same bucket count join and
    aggregate on those keys without a shuffle.  ``location`` keeps the files
    in a shared folder.
    """
    w = df.write.mode("overwrite").format(fmt).bucketBy(buckets, *keys).sortBy(*keys)
    if location:
        w = w.option("path", location)
    w.saveAsTable(table)
