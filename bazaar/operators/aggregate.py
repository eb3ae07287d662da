"""Grouping operators: conditional pivots, exposure counts, PV/UV funnels.

All are single ``groupBy().agg()`` plans (partial aggregation on the map
side, one Exchange on the grouping keys), except the funnel, which
pre-aggregates per user and then regroups (two small Exchanges, no Expand,
no join).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_sum_by_type(df: DataFrame, keys: Sequence[str], type_col: str,
                      types: Mapping[str, str], amount: Column,
                      counts: Mapping[str, str] | None = None,
                      extra: Sequence[Column] = (),
                      total: Callable[[Column], Column] = F.sum) -> DataFrame:
    """One row per ``keys`` with ``SUM(CASE type WHEN v THEN amount ELSE 0)``.

    ``types`` maps output column -> type value; ``counts`` maps output
    column -> type value for ``SUM(CASE type WHEN v THEN 1 ELSE 0)``;
    ``extra`` are further aggregate columns over the same groups; ``total``
    is the sum to take of the amounts.
    """
    t = F.col(type_col)
    zero = F.lit(0).cast(amount_type(df, amount))
    aggs = [total(F.when(t == F.lit(v), amount).otherwise(zero)).alias(name)
            for name, v in types.items()]
    aggs += [F.sum(F.when(t == F.lit(v), F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(name)
             for name, v in (counts or {}).items()]
    aggs += list(extra)
    return df.groupBy(*keys).agg(*aggs)


def amount_type(df: DataFrame, amount: Column) -> str:
    return df.select(amount.alias("a")).schema["a"].dataType.simpleString()


def exposure_by(df: DataFrame, keys: Sequence[str | Column], user: str,
                approx: bool = False, times: str = "exposure_times",
                users: str = "exposure_users") -> DataFrame:
    """Row count and distinct non-NULL users per group; NULL keys form groups.

    ``approx=True`` swaps the exact distinct count for HyperLogLog++
    (``approx_count_distinct``), which keeps a fixed-size sketch per group.
    """
    distinct = (F.approx_count_distinct(user) if approx else F.count_distinct(user))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(times),
                                 distinct.cast("bigint").alias(users))


def funnel(df: DataFrame, group: Sequence[str], user: str, level: Column,
           pv_names: Sequence[str], uv_names: Sequence[str],
           in_funnel: Column | None = None, times: str = "exposure_times",
           users: str = "exposure_users") -> DataFrame:
    """Exposure totals plus PV and UV for funnel levels 1..n, per group.

    * ``times`` / ``users``: all rows of the group / distinct users.
    * ``pv_names[k-1]``: rows at exactly level k.
    * ``uv_names[k-1]``: distinct users whose highest level in the group
      is >= k (no need to have passed the lower levels).

    Plan: one scan; aggregate per (group, user) with the row count, the max
    level and the per-level counts; then regroup per group.  A hot user or
    hot group is collapsed by the map-side partial aggregation before each
    Exchange.
    """
    n = len(pv_names)
    if len(uv_names) != n:
        raise ValueError("pv_names and uv_names must have the same length")
    lvl = level if in_funnel is None else F.when(in_funnel, level)
    per_user = (df.select(*group, F.col(user).alias("__u"), lvl.alias("__lvl"))
                .groupBy(*group, "__u")
                .agg(F.count(F.lit(1)).alias("__n"),
                     F.max("__lvl").alias("__max"),
                     *[F.count_if(F.col("__lvl") == k).alias(f"__pv{k}") for k in range(1, n + 1)]))
    aggs = [F.sum("__n").cast("bigint").alias(times),
            F.count("__u").cast("bigint").alias(users)]
    aggs += [F.sum(f"__pv{k}").cast("bigint").alias(pv_names[k - 1]) for k in range(1, n + 1)]
    aggs += [F.count_if(F.col("__u").isNotNull() & (F.col("__max") >= k)).cast("bigint")
             .alias(uv_names[k - 1]) for k in range(1, n + 1)]
    return per_user.groupBy(*group).agg(*aggs)
