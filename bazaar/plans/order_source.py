"""Last-touch attribution: for each order event, the latest earlier mapped
source event of the same visitor within a tolerance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day_between, first_nonempty_json
from ..operators.asof import last_touch
from ..operators.join import active_mapping
from ..params import AttributionParams, lookback_day

# The output columns, in order.
CONTRACT = ["visituserid", "order_creation_time", "time_local", "eventvariable_orderid",
            "W_ID", "dt", "Order_Source_List", "Order_Source"]


def order_source(events: DataFrame, config: DataFrame,
                 p: AttributionParams = AttributionParams()) -> DataFrame:
    e = events
    if p.domain is not None:
        e = e.where(F.col("domain") == F.lit(p.domain))
    out_start = p.days.start_date
    if out_start is not None:
        read_from = out_start
        if p.lookback:
            # sources up to one tolerance before the first output day
            read_from = lookback_day(out_start, p.tolerance_ms)
        e = e.where(day_between("dt", start=read_from))
    if p.days.end is not None:
        e = e.where(day_between("dt", end=p.days.end))

    mapping = active_mapping(config, p.mapping_var)
    is_order = (F.col("eventvariable_orderid").startswith(p.order_prefix)
                & (F.col("eventname") == F.lit(p.order_event)))
    e = e.join(mapping, F.col("eventname") == F.col("event_name"), "left")
    e = e.where(F.coalesce(is_order, F.lit(False)) | F.col("event_name").isNotNull())
    e = e.select(
        "visituserid", F.col("time").alias("order_creation_time"), "time_local",
        "eventvariable_orderid", "dt",
        F.concat(F.coalesce("eventvariable_country", F.lit("")),
                 F.coalesce("eventvariable_wechatid", F.lit(""))).alias("W_ID"),
        F.coalesce(is_order, F.lit(False)).alias("__is_order"),
        "source_name",
        first_nonempty_json("eventvariable", "listName", "title").alias("list_name"),
    )
    ms = F.col("order_creation_time").try_cast("bigint")
    is_source = ~F.col("__is_order")
    if not p.group_null_visitors:
        is_source = is_source & F.col("visituserid").isNotNull()
    m = last_touch(e, "visituserid", ms, is_target=F.col("__is_order"),
                   is_source=is_source, payload=["source_name", "list_name"],
                   tolerance_ms=p.tolerance_ms,
                   tie_break=[F.col("source_name"), F.col("list_name")], out="touch",
                   chunks=p.chunks)
    src = F.col("touch.source_name")
    lst = F.col("touch.list_name")
    found = F.col("touch").isNotNull() & src.isNotNull()
    m = m.withColumns({
        "Order_Source_List": F.when(found & lst.isNotNull() & (lst != F.lit("")),
                                    F.concat(src, F.lit("."), lst))
                              .when(found, src).otherwise(F.lit(p.not_found)),
        "Order_Source": F.when(found, src).otherwise(F.lit(p.not_found)),
    })
    if out_start is not None and p.lookback:
        m = m.where(day_between("dt", start=out_start))
    m = m.select(*CONTRACT)
    return m if p.limit is None else m.orderBy("visituserid", "order_creation_time", "eventvariable_orderid").limit(p.limit)
