"""Backward as-of match with a tolerance (last-touch attribution).

For every *target* row, find the latest *source* row of the same user at
or before it (a source at the same instant counts and sorts before the
target), and keep it only when it is at most ``tolerance_ms`` older.

A prefix scan (see ``scan``): both row kinds stay in one DataFrame, sorted by
(user, time); the running last source of a chunk is completed by the last
source that earlier chunks of the user carry over.  No range join, no copies
of sources; a burst of one user, or all rows without a user, are cut into
chunks like any others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import key_scan, quoted


def last_touch(df: DataFrame, user: str, ms: Column, is_target: Column, is_source: Column,
               payload: Sequence[str], tolerance_ms: int | None,
               tie_break: Sequence[Column] = (), out: str = "touch",
               chunks: int | None = None) -> DataFrame:
    """Return the target rows with a struct column ``out`` = (ms, *payload)
    of the matched source, or NULL when no source is within tolerance.

    ``tie_break`` orders sources that share a millisecond (the last one in
    that order wins).  ``tolerance_ms=None`` means unbounded.  ``chunks``: into
    how many the rows are cut.
    """
    if tolerance_ms is not None and tolerance_ms <= 0:
        raise ValueError("tolerance_ms must be positive")
    ties = {f"__tie{i}": c for i, c in enumerate(tie_break)}
    x = df.withColumns({"__ms": ms.cast("bigint"), "__tgt": is_target, "__src": is_source & ~is_target, **ties})
    x = x.where(F.col("__tgt") | F.col("__src"))
    source = F.struct(F.col("__ms").alias("ms"), *[F.col(p).alias(p) for p in payload])
    x = x.withColumn("__touch", F.when(F.col("__src"), source))
    order = ["__ms", "__tgt", *ties]  # a source sorts before a target of its instant
    latest = ", ".join(quoted(c) for c in order)
    y = key_scan(
        x, user, order,
        summary={"last_source": f"max_by(__touch, struct({latest})) FILTER (WHERE __src)"},
        carry={"before": "last(last_source, true) OVER earlier"},
        rows={"__best": "coalesce(last(p.__touch, true) OVER above, c.before)"}, chunks=chunks).where(F.col("__tgt"))
    within = F.col("__best").isNotNull()
    if tolerance_ms is not None:
        within = within & ((F.col("__ms") - F.col("__best.ms")) <= F.lit(tolerance_ms))
    return y.withColumn(out, F.when(within, F.col("__best"))).drop("__ms", "__tgt", "__src", "__touch", "__best", *ties)
