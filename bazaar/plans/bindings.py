"""Registered queries: the marts and operators run over the driver tables.

Each entry takes (spark, table_dir) and returns a DataFrame.  The SQL
twin of each entry is in ``bazaar.plans.oracle`` (see ``ORACLE``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import to_money
from ..functions.casts import REVENUE_CAST_LAYER, apply_cast_layer
from ..operators.join import active_values, not_in_list
from ..operators.window import latest_per_key, user_sequence
from ..params import (AdjustmentParams, AttributionParams, DayRange, ExposureParams,
                      FunnelParams, LedgerMartParams, OrderMartParams)
from ..sources import derived as dv
from ..session import scratch_path
from ..sources.config import SEED_ROWS, config_frame, create_config_table, preview
from ..sources.tables import Tables
from . import oracle as sql
from .event_funnel import event_funnel, source_exposure, total_exposures
from .ledger_mart import ledger_mart
from .order_mart import order_mart, settlement_pivot
from .order_source import order_source
from .revenue_adjustment import final_revenues, revenue_adjustment

# Config rows the bindings switch on (the driver's events use their own
# event names, so the seeded event names would match nothing).
BINDING_CONFIG = [
    ("evt_map", "view", "Browse", "TRUE"),
    ("evt_map", "click", "Tap", "TRUE"),
    ("evt_map", "signup", "Join", "TRUE"),
    ("evt_map", "purchase", "Buy", "FALSE"),
    ("scene_list", "DONE_ORDER", "done", "TRUE"),
    ("scene_list", "SELF_RUN", "self", "TRUE"),
    ("scene_list", "TAKEOUT", "takeout", "FALSE"),
]

ORDER_PARAMS = OrderMartParams(drink_prefix="A", gst_rates={"NATION_7": 1.2, "NATION_2": 1.0})
LEDGER_PARAMS = LedgerMartParams(gst_rates={"NATION_7": 1.2, "NATION_2": 1.0})
FUNNEL_PARAMS = FunnelParams(domain="app", levels={"view": 1, "click": 2, "purchase": 5})
FIVE_LEVELS = {"view0": 1, "view1": 1, "click0": 2, "click1": 3, "signup0": 4, "signup1": 4, "purchase0": 5, "purchase1": 5}
TOLERANCE_MS = 12 * 3_600_000
ATTR_PARAMS = AttributionParams(mapping_var="evt_map", order_event="purchase",
                                tolerance_ms=TOLERANCE_MS)
ORDER_DAY = "1998-01-31"
LEDGER_DAY = "1998-03-02"
FUNNEL_DAY = "20240115"
START_MONTH = 199901
FUNNEL_DAYS = ("20240105", "20240112")
ATTR_START = "20240110"


def revenue_ties() -> list:
    """Versions of one time: the later summary, note and the larger amount wins."""
    return [F.col("summary_id"), F.col("note_type"), F.col("revenue").try_cast("double")]


def _cfg(spark: SparkSession) -> DataFrame:
    return config_frame(spark, BINDING_CONFIG)


def q_order_mart(spark: SparkSession, d: str, days: DayRange = DayRange()) -> DataFrame:
    t = Tables(spark, d)
    p = OrderMartParams(**{**ORDER_PARAMS.__dict__, "days": days})
    return order_mart(dv.group_orders(t), dv.settlement(t), dv.tickets(t), dv.items(t),
                      dv.merchant_extra(t), dv.categories(t), dv.user_attr(t), p)


def q_order_mart_day(spark: SparkSession, d: str) -> DataFrame:
    return q_order_mart(spark, d, DayRange(ORDER_DAY, ORDER_DAY))


def q_ledger_pivot(spark: SparkSession, d: str) -> DataFrame:
    piv = settlement_pivot(dv.settlement(Tables(spark, d)), ORDER_PARAMS)
    return piv.select("order_id", "country",
                      *[to_money(c).alias(c) for c in
                        ["liability_pay", "liability_use", "liability_no_settled",
                         "liability_settled", "liability_refund"]],
                      "pay_count")


def q_ledger_mart(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return ledger_mart(dv.settlement(t), dv.card_fees(t), LEDGER_PARAMS)


def q_event_funnel(spark: SparkSession, d: str) -> DataFrame:
    return event_funnel(dv.app_events(Tables(spark, d)), FUNNEL_PARAMS)


def q_event_funnel_days(spark: SparkSession, d: str) -> DataFrame:
    p = FunnelParams(**{**FUNNEL_PARAMS.__dict__, "days": DayRange(*FUNNEL_DAYS)})
    return event_funnel(dv.app_events(Tables(spark, d)), p)


def q_event_funnel_day(spark: SparkSession, d: str) -> DataFrame:
    p = FunnelParams(**{**FUNNEL_PARAMS.__dict__, "days": DayRange(FUNNEL_DAY, FUNNEL_DAY)})
    return event_funnel(dv.app_events(Tables(spark, d)), p)


def q_ledger_mart_day(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    p = LedgerMartParams(**{**LEDGER_PARAMS.__dict__, "days": DayRange(LEDGER_DAY, LEDGER_DAY)})
    return ledger_mart(dv.settlement(t), dv.card_fees(t), p)


def q_total_exposures(spark: SparkSession, d: str) -> DataFrame:
    return total_exposures(dv.app_events(Tables(spark, d)))


def q_total_exposures_days(spark: SparkSession, d: str) -> DataFrame:
    """One domain, a day range over days stored in both forms."""
    return total_exposures(dv.edge_events(Tables(spark, d)), ExposureParams(domain="app", days=DayRange(*FUNNEL_DAYS)))


def q_event_funnel_levels(spark: SparkSession, d: str) -> DataFrame:
    """All five levels, several names on a level, days stored in both forms."""
    p = FunnelParams(domain="app", levels=FIVE_LEVELS, days=DayRange(*FUNNEL_DAYS))
    return event_funnel(dv.edge_events(Tables(spark, d)), p)


def q_order_mart_edges(spark: SparkSession, d: str) -> DataFrame:
    """Orders without user or status, under two countries, with other ledger
    types, with near-miss ticket keys and repeated JSON keys."""
    t = Tables(spark, d)
    return order_mart(dv.edge_orders(t), dv.edge_settlement(t), dv.edge_tickets(t), dv.items(t), dv.merchant_extra(t),
                      dv.categories(t), dv.user_attr(t), ORDER_PARAMS)


def q_config_lifecycle(spark: SparkSession, d: str) -> DataFrame:
    """The config table's life: drop, create as ORC with comments, insert, all
    of it once more, and the rows read back with their events' counts."""
    place = scratch_path(spark, f"config-{uuid.uuid4().hex}")
    for _ in range(2):
        config = create_config_table(spark, "bazaar_config_lifecycle", [*SEED_ROWS, *BINDING_CONFIG], location=place)
    told = dv.app_events(Tables(spark, d)).groupBy("eventname").agg(F.count(F.lit(1)).alias("n"))
    return (config.join(told, F.col("value1") == F.col("eventname"), "left")
            .select("variable_name", "value1", "value2", "value3", F.coalesce("n", F.lit(0)).alias("events"),
                    (F.col("value3") == "TRUE").alias("active")))


def q_revenue_casts(spark: SparkSession, d: str) -> DataFrame:
    """All 119 typed columns; decimals leave as the text of their six places."""
    typed = apply_cast_layer(dv.full_revenues(Tables(spark, d)), REVENUE_CAST_LAYER, strict=True)
    return typed.withColumns({c: F.col(c).cast("string") for c in REVENUE_CAST_LAYER["decimal(34,6)"]})


def q_revenue_ids(spark: SparkSession, d: str) -> DataFrame:
    """The composite ids of every kept revenue."""
    t = Tables(spark, d)
    r = final_revenues(dv.revenues(t), dv.deliverers(t), dv.areas(t), _cfg(spark), AdjustmentParams(scene_var="scene_list"),
                       tie_break=revenue_ties())
    return r.select("id", "country", "d_id", "r_id", "o_id", "w_id", "DR_id", "source")


def q_scene_exclusion_lists(spark: SparkSession, d: str) -> DataFrame:
    """``NOT IN`` a list, the list with a NULL, and an empty list."""
    rv = dv.revenues(Tables(spark, d)).select("id", "country", "business_scene")
    listed = active_values(_cfg(spark), "scene_list")
    lists = {"listed": listed, "with_null": listed.union(spark.createDataFrame([(None,)], "value1 string")),
             "empty": active_values(_cfg(spark), "no such list")}
    out = None
    for name, values in lists.items():
        part = not_in_list(rv, "business_scene", values, "value1").withColumn("list", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def q_source_exposure(spark: SparkSession, d: str) -> DataFrame:
    return source_exposure(dv.app_events(Tables(spark, d)), _cfg(spark),
                           ExposureParams(mapping_var="evt_map"))


def q_source_exposure_from_day(spark: SparkSession, d: str) -> DataFrame:
    return source_exposure(dv.app_events(Tables(spark, d)), _cfg(spark),
                           ExposureParams(mapping_var="evt_map", domain="app", days=DayRange(ATTR_START)))


def q_order_source_hour(spark: SparkSession, d: str) -> DataFrame:
    """With the specified tolerance of one hour."""
    p = AttributionParams(**{**ATTR_PARAMS.__dict__, "tolerance_ms": AttributionParams.tolerance_ms})
    return order_source(dv.app_events(Tables(spark, d)), _cfg(spark), p)


def q_order_source(spark: SparkSession, d: str) -> DataFrame:
    return order_source(dv.app_events(Tables(spark, d)), _cfg(spark), ATTR_PARAMS)


def q_order_source_from_day(spark: SparkSession, d: str) -> DataFrame:
    p = AttributionParams(**{**ATTR_PARAMS.__dict__, "days": DayRange(ATTR_START)})
    return order_source(dv.app_events(Tables(spark, d)), _cfg(spark), p)


def q_revenue_adjustment(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return revenue_adjustment(dv.revenues(t), dv.deliverers(t), dv.areas(t), _cfg(spark),
                              AdjustmentParams(scene_var="scene_list", area_key="m_area_id"),
                              tie_break=revenue_ties())


def q_revenue_adjustment_by_id(spark: SparkSession, d: str) -> DataFrame:
    """Areas matched on the deliverer's id, as specified."""
    t = Tables(spark, d)
    return revenue_adjustment(dv.revenues(t), dv.deliverers(t), dv.areas(t), _cfg(spark),
                              AdjustmentParams(scene_var="scene_list"),
                              tie_break=revenue_ties())


def q_revenue_adjustment_from_month(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return revenue_adjustment(dv.revenues(t), dv.deliverers(t), dv.areas(t), _cfg(spark),
                              AdjustmentParams(scene_var="scene_list", area_key="m_area_id",
                                               start_month=START_MONTH),
                              tie_break=revenue_ties())


def q_latest_version(spark: SparkSession, d: str) -> DataFrame:
    li = Tables(spark, d).lineitem
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()],
                          [F.col("l_partkey").desc(), F.col("l_suppkey").desc(),
                           F.col("l_extendedprice").desc()])


def q_user_sequence(spark: SparkSession, d: str) -> DataFrame:
    o = (Tables(spark, d).orders
         .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                 F.to_date("o_orderdate").alias("__day")))
    x = user_sequence(o, "o_custkey", "o_orderdate", "o_orderkey", "__day",
                      rank_out="order_rank", next_out="next_order_date",
                      match=F.col("o_orderstatus") == "F", match_out="next_f_date")
    return x.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "order_rank",
                    "next_order_date", "next_f_date",
                    F.datediff("next_order_date", "__day").alias("next_order_date_diff"))


def q_scene_exclusion(spark: SparkSession, d: str) -> DataFrame:
    rv = dv.revenues(Tables(spark, d)).select("id", "country", "business_scene", "desc_info")
    return not_in_list(rv, "business_scene", active_values(_cfg(spark), "scene_list"), "value1")


def q_funnel_preview(spark: SparkSession, d: str) -> DataFrame:
    return preview(q_event_funnel(spark, d), 10, ["time_date", "W_ID", "language"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "order_mart": q_order_mart,
    "order_mart_day": q_order_mart_day,
    "order_mart_edges": q_order_mart_edges,
    "ledger_pivot": q_ledger_pivot,
    "ledger_mart": q_ledger_mart,
    "event_funnel": q_event_funnel,
    "event_funnel_days": q_event_funnel_days,
    "event_funnel_day": q_event_funnel_day,
    "ledger_mart_day": q_ledger_mart_day,
    "event_funnel_levels": q_event_funnel_levels,
    "total_exposures": q_total_exposures,
    "total_exposures_days": q_total_exposures_days,
    "source_exposure": q_source_exposure,
    "source_exposure_from_day": q_source_exposure_from_day,
    "order_source": q_order_source,
    "order_source_hour": q_order_source_hour,
    "order_source_from_day": q_order_source_from_day,
    "revenue_adjustment": q_revenue_adjustment,
    "revenue_adjustment_by_id": q_revenue_adjustment_by_id,
    "revenue_adjustment_from_month": q_revenue_adjustment_from_month,
    "latest_version": q_latest_version,
    "user_sequence": q_user_sequence,
    "revenue_ids": q_revenue_ids,
    "revenue_casts": q_revenue_casts,
    "scene_exclusion": q_scene_exclusion,
    "scene_exclusion_lists": q_scene_exclusion_lists,
    "config_lifecycle": q_config_lifecycle,
    "funnel_preview": q_funnel_preview,
}


def _attr_read_from() -> str:
    from ..params import lookback_day
    return lookback_day(ATTR_START, TOLERANCE_MS).strftime("%Y%m%d")


ORACLE: dict[str, str] = {
    "order_mart": sql.order_mart_sql(),
    "order_mart_day": sql.order_mart_sql(ORDER_DAY),
    "order_mart_edges": sql.order_mart_sql(edges=True),
    "ledger_pivot": sql.ledger_pivot_sql(),
    "ledger_mart": sql.ledger_mart_sql(),
    "event_funnel": sql.event_funnel_sql(),
    "event_funnel_days": sql.event_funnel_sql(*FUNNEL_DAYS),
    "event_funnel_day": sql.event_funnel_sql(FUNNEL_DAY, FUNNEL_DAY),
    "ledger_mart_day": sql.ledger_mart_sql(LEDGER_DAY),
    "event_funnel_levels": sql.event_funnel_sql(*FUNNEL_DAYS, FIVE_LEVELS),
    "total_exposures": sql.total_exposures_sql(),
    "total_exposures_days": sql.total_exposures_sql(*FUNNEL_DAYS),
    "source_exposure": sql.source_exposure_sql(),
    "source_exposure_from_day": sql.source_exposure_sql(ATTR_START, "app"),
    "order_source": sql.order_source_sql(TOLERANCE_MS),
    "order_source_hour": sql.order_source_sql(AttributionParams.tolerance_ms),
    "order_source_from_day": sql.order_source_sql(TOLERANCE_MS, ATTR_START, _attr_read_from()),
    "revenue_adjustment": sql.revenue_adjustment_sql(),
    "revenue_adjustment_by_id": sql.revenue_adjustment_sql(area_key="id"),
    "revenue_adjustment_from_month": sql.revenue_adjustment_sql(START_MONTH),
    "latest_version": sql.latest_version_sql(),
    "user_sequence": sql.user_sequence_sql(),
    "revenue_ids": sql.revenue_ids_sql(),
    "revenue_casts": sql.revenue_casts_sql(),
    "scene_exclusion": sql.scene_exclusion_sql(),
    "scene_exclusion_lists": sql.scene_exclusion_lists_sql(),
    "config_lifecycle": sql.config_lifecycle_sql([*SEED_ROWS, *BINDING_CONFIG]),
    "funnel_preview": sql.funnel_preview_sql(),
}
