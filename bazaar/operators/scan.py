"""Prefix scans: per-key windows over rows that no single task has to hold.

A window partitioned by a key puts all rows of the key into one task.  A scan
cuts the rows, in the order of (key, order columns), into chunks of about
equal size (``repartitionByRange``), whatever the key: a key with a third of
all rows, one day of it, or the rows without a key are cut like any others.
Windows run within (chunk, key).  What has to cross a chunk's edge is carried
by a summary of the keys that lie on an edge: two rows a chunk at most, so
its size is bounded by the number of chunks and it is broadcast.

The chunk of a row depends on sampled range bounds, so both readers of the
chunks (rows and summary) must see the same cut.  That is what a CTE with a
non-deterministic column is for: Spark computes it once and both readers share
its exchange (``ReusedExchange``); the input is scanned once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = "__chunk"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def chunked(df: DataFrame, order: Sequence[str], chunks: int | None = None) -> DataFrame:
    """``df`` with ``CHUNK``: ranges of the rows sorted by ``order`` (NULLs
    first), each in a task of its own.  ``chunks``: how many, by default the
    session's shuffle partitions."""
    spark = df.sparkSession
    n = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartitionByRange(n, *[F.col(quoted(c)).asc_nulls_first() for c in order])
            .withColumn(CHUNK, F.spark_partition_id()).repartitionById(n, F.col(CHUNK)))


def key_scan(df: DataFrame, key: str, order: Sequence[str], summary: Mapping[str, str], carry: Mapping[str, str],
             rows: Mapping[str, str], linked: Mapping[str, str] | None = None, chunks: int | None = None) -> DataFrame:
    """``df`` with the columns ``rows``; all are SQL expressions:

    * ``summary``: aggregates of the rows of a key in a chunk;
    * ``linked``, ``carry``: over the columns of ``summary`` (and ``linked``)
      with the windows ``keys`` (the key's chunks in order), ``earlier`` (those
      before this one), ``so_far`` (and this one) and ``later`` (by a backward running frame);
    * ``rows``: over the row ``p`` and the columns ``c`` of ``carry`` (NULL
      where the key has rows in no other chunk), with the windows ``local`` (the
      rows of the key in the chunk, in ``order``), ``above`` (those before this
      one) and ``below`` (those after it, by a backward running frame).

    NULL keys are one key, NULLs come first in ``order``.
    """
    if df.sparkSession.conf.get("spark.sql.exchange.reuse", "true").lower() != "true":
        raise ValueError("key_scan needs spark.sql.exchange.reuse: rows and summary must share one cut")
    k = quoted(key)
    by = ", ".join(f"p.{quoted(c)}" for c in order)
    back = ", ".join(f"p.{quoted(c)} DESC" for c in order)
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

    def listed(columns: Mapping[str, str]) -> str:
        return "".join(f", {e} AS {quoted(name)}" for name, e in columns.items())

    return df.sparkSession.sql(f"""
WITH placed AS (SELECT * FROM {{placed}}),
chunks AS (
  SELECT {CHUNK}, {k} AS __key{listed(summary)} FROM placed GROUP BY {CHUNK}, {k}),
edges AS (
  SELECT *, row_number() OVER (PARTITION BY {CHUNK} ORDER BY __key) = 1
         OR lead(true) OVER (PARTITION BY {CHUNK} ORDER BY __key) IS NULL AS __on_edge
  FROM chunks),
linked AS (
  SELECT *{listed(linked or {})} FROM edges WHERE __on_edge WINDOW keys AS (PARTITION BY __key ORDER BY {CHUNK})),
carry AS (
  SELECT {CHUNK} AS __c, __key{listed(carry)} FROM linked
  WINDOW keys AS (PARTITION BY __key ORDER BY {CHUNK}),
    earlier AS (PARTITION BY __key ORDER BY {CHUNK} {before}),
    so_far AS (PARTITION BY __key ORDER BY {CHUNK} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    later AS (PARTITION BY __key ORDER BY {CHUNK} DESC {before}))
SELECT /*+ BROADCAST(c) */ p.*{listed(rows)}
FROM placed p LEFT JOIN carry c ON p.{CHUNK} = c.__c AND p.{k} <=> c.__key
WINDOW local AS (PARTITION BY p.{CHUNK}, p.{k} ORDER BY {by}),
  above AS (PARTITION BY p.{CHUNK}, p.{k} ORDER BY {by} {before}),
  below AS (PARTITION BY p.{CHUNK}, p.{k} ORDER BY {back} {before})
""", placed=chunked(df, [key, *order], chunks)).drop(CHUNK)
