"""Per-key window operators: latest version, user order sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import CHUNK, key_scan, quoted


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   tie_break: Sequence[Column] = ()) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (+ ``tie_break``).

    ``order`` holds sort columns such as ``F.col('created_at').desc()``.
    Planned as ROW_NUMBER = 1, which Spark turns into a WindowGroupLimit on
    both sides of the Exchange, so a hot key ships at most one row per map
    partition.
    """
    w = Window.partitionBy(*keys).orderBy(*order, *tie_break)
    return (df.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == 1).drop("__rn"))


def user_sequence(df: DataFrame, user: str, ts: str, tie_break: str, date: str,
                  rank_out: str = "order_rank", next_out: str = "next_order_date",
                  match: Column | None = None, match_out: str | None = None,
                  chunks: int | None = None) -> DataFrame:
    """Add, per user in time order:

    * ``rank_out``: DENSE_RANK by ``ts`` (ties share a rank);
    * ``next_out``: ``date`` of the next row by (``ts``, ``tie_break``);
    * ``match_out``: the smallest ``date`` among strictly later rows for
      which ``match`` holds (the forward frame ``1 FOLLOWING .. UNBOUNDED
      FOLLOWING``).

    NULL users form one sequence and NULL ``ts`` sorts first, as in SQL.
    ``date`` must not decrease when ``ts`` increases (e.g. the date of ts).

    A prefix scan (see ``scan``): no task holds a user's whole history, nor
    all of a user's day.  A chunk hands on how many times it holds, the date
    of its first row and its first matching date; a time on both sides of an
    edge counts once.  ``chunks``: into how many the rows are cut.
    """
    t, k, d = quoted(ts), quoted(tie_break), quoted(date)
    held = df.withColumn("__match", F.coalesce(match, F.lit(False)) if match is not None else F.lit(False))
    rows = {
        next_out: f"if(lead(true) OVER local IS NULL, c.next_date, lead(p.{d}) OVER local)",
        rank_out: (f"cast(dense_rank() OVER (PARTITION BY p.{CHUNK}, p.{quoted(user)} ORDER BY p.{t}) "
                   "+ coalesce(c.before, 0) AS int)"),
    }
    if match is not None:
        rows = {match_out: f"least(min(if(p.__match, p.{d}, NULL)) OVER below, c.next_match)"} | rows
    return key_scan(
        held, user, [ts, tie_break],
        summary={"times": f"count(DISTINCT {t}) + max(int({t} IS NULL))",  # NULL is one time, as in DENSE_RANK
                 "first_time": f"min(struct({t}))", "last_time": f"max(struct({t}))",
                 "first_date": f"min_by({d}, struct({t}, {k}))", "first_match": f"min(if(__match, {d}, NULL))"},
        linked={"on_both": "int(lag(last_time) OVER keys <=> first_time)"},
        carry={"before": "coalesce(sum(times) OVER earlier, 0) - sum(on_both) OVER so_far",
               "next_date": "lead(first_date) OVER keys", "next_match": "min(first_match) OVER later"},
        rows=rows, chunks=chunks).drop("__match")
