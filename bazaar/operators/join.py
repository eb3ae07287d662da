"""Lookups, null-aware exclusion lists and switchable mapping tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Into how many lanes rows without a key are spread (see ``lookup``).
LANES = 10_007


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[tuple[str | Column, str]],
           how: str = "left", matched_flag: str | None = None,
           spread_by: str | None = None) -> DataFrame:
    """Left (or inner) lookup of a dimension.

    No broadcast hint is given and nothing is counted while the plan is
    built: Spark broadcasts a side whose size in bytes is under its
    threshold, AQE measures the others at runtime, and beyond it the join
    shuffles, with skewed partitions split.

    ``on`` pairs a left column/expression with a dimension column name;
    normalise types of the keys before calling (``try_cast``), never rely
    on implicit string/number comparison.  ``matched_flag`` adds a boolean
    column that is TRUE when a dimension row matched.  The dimension's key
    columns are dropped from the output.

    ``spread_by`` (a column that differs between rows): rows with a NULL key
    match nothing, but a shuffle by key would bring all of them to one task.
    They get a lane number of their own instead, which the dimension's rows
    (all in lane 0) never have.
    """
    keys = {f"__k{i}": F.col(c) if isinstance(c, str) else c for i, (c, _) in enumerate(on)}
    left = df.withColumns(keys)
    dim_keys = [d for _, d in on]
    d = dim.withColumn("__bz_matched", F.lit(True)) if matched_flag else dim
    if spread_by is not None:
        none = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        lane = F.lit(1) + F.pmod(F.xxhash64(F.col(spread_by)), F.lit(LANES)).cast("int")
        left = left.withColumn("__lane", F.when(none, lane).otherwise(F.lit(0)))
        # 0 for every row that can match; not a literal, which would be no join key
        d = d.withColumn("__dim_lane", F.when(F.col(dim_keys[0]).isNull(), F.lit(-1)).otherwise(F.lit(0)))
        keys["__lane"] = None
        dim_keys = [*dim_keys, "__dim_lane"]
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__dim.{c}") for k, c in zip(keys, dim_keys)])
    out = left.join(d.alias("__dim"), cond, how)
    for k in dim_keys:
        out = out.drop(F.col(f"__dim.{k}"))
    if matched_flag:
        out = out.withColumn(matched_flag, F.col("__bz_matched").isNotNull()).drop("__bz_matched")
    return out.drop(*keys)


def unique_dimension(dim: DataFrame, keys: Sequence[str], on_repeat: str = "one") -> DataFrame:
    """``dim`` with one row a key, made sure inside the plan.

    A fact row joined to it stays one row, so whatever picks one row of a
    fact key can run before the lookup.  Rows with a NULL key go, as no
    lookup finds them.  ``on_repeat``: "one" keeps, of a repeated key, the row
    whose other columns come last in their order (NULLs first); "error"
    makes the job fail with the key.  Grouped by the lookup's keys, so a
    shuffle join after it needs no further exchange of the dimension.
    """
    if on_repeat not in ("one", "error"):
        raise ValueError("on_repeat must be 'one' or 'error'")
    rest = [c for c in dim.columns if c not in keys]
    known = dim.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    grouped = known.groupBy(*keys).agg(F.max(F.struct(*rest) if rest else F.lit(True)).alias("__rest"),
                                       F.count(F.lit(1)).alias("__n"))
    if on_repeat == "error":
        said = F.concat(F.lit("key found more than once in a lookup table: "), F.to_json(F.struct(*keys)))
        grouped = grouped.withColumn(keys[0], F.when(F.col("__n") == 1, F.col(keys[0])).otherwise(F.raise_error(said)))
    return grouped.select(*[F.col(c) if c in keys else F.col("__rest")[c].alias(c) for c in dim.columns])


def not_in_list(df: DataFrame, column: str, values: DataFrame, value_col: str) -> DataFrame:
    """``WHERE column NOT IN (SELECT value_col FROM values)`` with SQL rules.

    NULL in ``column`` drops the row; one NULL in the list empties the
    result; an empty list keeps every row.  An ordinary anti join plus two
    counts of the list: Spark broadcasts the list below its size threshold
    and shuffles both sides by the value above it, while a null-aware anti
    join would broadcast a list of any size.
    """
    spark = df.sparkSession
    return spark.sql(
        f"SELECT s.* FROM {{src}} s LEFT ANTI JOIN {{lst}} l ON s.`{column}` = l.`{value_col}` "
        f"WHERE (SELECT count(*) FROM {{lst}}) = 0 OR (s.`{column}` IS NOT NULL "
        f"AND (SELECT count_if(`{value_col}` IS NULL) FROM {{lst}}) = 0)",
        src=df, lst=values)


def active_mapping(config: DataFrame, variable_name: str, key: str = "value1",
                   value: str = "value2", key_alias: str = "event_name",
                   value_alias: str = "source_name", validate: bool = True) -> DataFrame:
    """Active rows of one switchable mapping (``value3 = 'TRUE'``).

    With ``validate`` a key mapped twice fails the job that reads the
    mapping, because a duplicate row would multiply every matching fact row
    downstream.  The check is part of the plan: building it runs no job.
    """
    m = (config.where((F.col("variable_name") == F.lit(variable_name))
                      & (F.col("value3") == F.lit("TRUE")))
         .select(F.col(key).alias(key_alias), F.col(value).alias(value_alias)))
    if not validate:
        return m
    said = F.concat(F.lit(f"mapping {variable_name!r} maps more than once: "), F.coalesce(F.col(key_alias), F.lit("NULL")))
    return (m.groupBy(key_alias).agg(F.first(value_alias).alias(value_alias), F.count(F.lit(1)).alias("__n"))
            .select(key_alias, F.when(F.col("__n") == 1, F.col(value_alias)).otherwise(F.raise_error(said)).alias(value_alias)))


def active_values(config: DataFrame, variable_name: str, key: str = "value1",
                  alias: str = "value1") -> DataFrame:
    """Active key list of one config variable (for exclusion lists)."""
    return (config.where((F.col("variable_name") == F.lit(variable_name))
                         & (F.col("value3") == F.lit("TRUE")))
            .select(F.col(key).alias(alias)))
