"""Event funnel (exposures + PV/UV per level) and source exposure.

Both read the day-partitioned app-event log; the day bound is compared to
the raw ``dt`` partition string so Spark prunes partitions / pushes the
filter into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import composite_id, day_between, first_nonempty_json, level_of, parse_day
from ..operators.aggregate import exposure_by, funnel
from ..operators.join import active_mapping
from ..params import ExposureParams, FunnelParams

FUNNEL_KEYS = ["time_date", "W_ID", "language"]
EXPOSURE_KEYS = ["time_date", "W_ID", "eventname", "source_name", "list_name", "source_name_List"]


def day_window(events: DataFrame, days, dt_col: str = "dt") -> DataFrame:
    """Bounds on the raw partition string, in whichever day form it is stored."""
    if days.start is None and days.end is None:
        return events
    return events.where(day_between(dt_col, days.start, days.end))


def market_id() -> F.Column:
    return composite_id("eventvariable_country", "eventvariable_wechatid", null_safe=True)


def event_funnel(events: DataFrame, p: FunnelParams) -> DataFrame:
    """Totals and funnel per (day, market, language); only groups with at
    least one level-1 user are kept (NULL language or day never qualify)."""
    if p.domain is None:
        raise ValueError("FunnelParams.domain is required")
    e = day_window(events, p.days).where(F.col("domain") == F.lit(p.domain))
    e = e.select(parse_day("dt").alias("time_date"), market_id().alias("W_ID"),
                 F.col("eventvariable_language").alias("language"),
                 "visituserid", "eventname")
    lvl = level_of("eventname", p.levels)
    out = funnel(e, FUNNEL_KEYS, "visituserid", lvl, p.pv_names, p.uv_names,
                 in_funnel=F.col("eventname").isin(list(p.levels)))
    return out.where(F.col("language").isNotNull() & F.col("time_date").isNotNull()
                     & (F.col(p.uv_names[0]) > 0))


def total_exposures(events: DataFrame, p: ExposureParams = ExposureParams()) -> DataFrame:
    """Exposures and distinct users per (day, market, language), over one
    domain and the day range where given."""
    e = day_window(events, p.days)
    if p.domain is not None:
        e = e.where(F.col("domain") == F.lit(p.domain))
    e = e.select(parse_day("dt").alias("time_date"), market_id().alias("W_ID"),
                 F.col("eventvariable_language").alias("language"), "visituserid")
    return exposure_by(e, FUNNEL_KEYS, "visituserid", approx=p.approx_users)


def source_exposure(events: DataFrame, config: DataFrame,
                    p: ExposureParams = ExposureParams()) -> DataFrame:
    """Exposures per mapped source and list/title name."""
    e = day_window(events, p.days)
    if p.domain is not None:
        e = e.where(F.col("domain") == F.lit(p.domain))
    mapping = active_mapping(config, p.mapping_var)
    e = e.join(mapping, F.col("eventname") == F.col("event_name"), "inner")
    lst = first_nonempty_json("eventvariable", "listName", "title")
    e = e.select(parse_day("dt").alias("time_date"), market_id().alias("W_ID"),
                 "eventname", "visituserid", "source_name", lst.alias("list_name"))
    e = e.withColumn("source_name_List",
                     F.when(F.col("list_name").isNotNull(),
                            F.concat(F.col("source_name"), F.lit("."), F.col("list_name")))
                     .otherwise(F.col("source_name")))
    return exposure_by(e, EXPOSURE_KEYS, "visituserid", approx=p.approx_users)
