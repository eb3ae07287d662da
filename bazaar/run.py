"""Command-line runner: one mart over catalog tables or Parquet paths.

    python -m bazaar.run order_mart \\
        --input orders=db.orders --input settlement=db.settlement ... \\
        --day 2025-11-19 --out /shared/marts/order_mart

Inputs are named by the mart's parameters (see ``INPUTS``); each value is a
catalog table name or a path ending in ``.parquet``/``.orc`` or a folder.
Without ``--out`` the first rows are shown; with it the mart is written by
day (dynamic partition overwrite) or, for marts without a day column, as
one overwritten dataset.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .params import (AdjustmentParams, AttributionParams, DayRange, ExposureParams,
                     FunnelParams, LedgerMartParams, OrderMartParams, as_date)
from .plans.event_funnel import event_funnel, source_exposure, total_exposures
from .plans.ledger_mart import ledger_mart
from .plans.order_mart import order_mart
from .plans.order_source import order_source
from .plans.revenue_adjustment import revenue_adjustment
from .sources.config import create_config_table, preview
from .sources.sink import write_by_day
from .sources.tables import is_path

INPUTS = {
    "order_mart": ["orders", "settlement", "tickets", "items", "merchant_extra", "categories",
                   "user_attr"],
    "ledger_mart": ["settlement", "card_fee"],
    "event_funnel": ["events"],
    "total_exposures": ["events"],
    "source_exposure": ["events", "config"],
    "order_source": ["events", "config"],
    "revenue_adjustment": ["revenues", "deliverers", "areas", "config"],
    "preview": ["table"],
}
DAY_COLUMN = {"order_mart": "created_at_local", "ledger_mart": "created_at_local",
              "event_funnel": "time_date", "total_exposures": "time_date", "source_exposure": "time_date", "order_source": "dt"}


def load(spark: SparkSession, ref: str) -> DataFrame:
    if ref.endswith(".orc"):
        return spark.read.orc(ref)
    if ref.endswith(".parquet") or is_path(ref):
        return spark.read.parquet(ref)
    return spark.table(ref)


def build(spark: SparkSession, mart: str, inputs: dict[str, str], a) -> DataFrame:
    missing = [n for n in INPUTS.get(mart, []) if n not in inputs]
    if missing:
        raise SystemExit(f"{mart} needs --input for {missing}")
    src = {n: load(spark, inputs[n]) for n in INPUTS[mart]}
    days = DayRange(a.day or a.start, a.day or a.end)
    if mart == "order_mart":
        return order_mart(**src, p=OrderMartParams(days=days))
    if mart == "ledger_mart":
        return ledger_mart(src["settlement"], src["card_fee"], LedgerMartParams(days=days))
    if mart == "event_funnel":
        return event_funnel(src["events"], FunnelParams(domain=a.domain, days=days))
    exposure = ExposureParams(days=days, domain=a.domain, mapping_var=a.mapping_var)
    if mart == "total_exposures":
        return total_exposures(src["events"], exposure)
    if mart == "source_exposure":
        return source_exposure(src["events"], src["config"], exposure)
    if mart == "order_source":
        return order_source(src["events"], src["config"],
                            AttributionParams(days=days, tolerance_ms=a.tolerance_ms, domain=a.domain,
                                              mapping_var=a.mapping_var))
    if mart == "revenue_adjustment":
        return revenue_adjustment(
            src["revenues"], src["deliverers"], src["areas"], src["config"],
            AdjustmentParams(start_month=a.start_month, scene_var=a.scene_var, area_key=a.area_key,
                             on_repeated_key=a.on_repeated_key),
            tie_break=a.tie_break.split(",") if a.tie_break else None)
    if mart == "preview":
        return preview(src["table"], a.rows)
    raise SystemExit(f"unknown mart {mart}")


def day_text(day: str, kind: str) -> str:
    """A day as its partition folder names it: ISO for a date column, as given for text."""
    return day if kind == "string" else as_date(day).isoformat()


def main(argv=None, spark: SparkSession | None = None) -> DataFrame | None:
    ap = argparse.ArgumentParser(prog="bazaar.run")
    ap.add_argument("mart", choices=sorted([*INPUTS, "config_table"]))
    ap.add_argument("--input", action="append", default=[], metavar="NAME=TABLE_OR_PATH")
    ap.add_argument("--day"), ap.add_argument("--start"), ap.add_argument("--end")
    ap.add_argument("--start-month", type=int)
    ap.add_argument("--domain")
    ap.add_argument("--tolerance-ms", type=int, default=3_600_000)
    ap.add_argument("--mapping-var", default=ExposureParams.mapping_var, help="config variable of the event mapping")
    ap.add_argument("--scene-var", default=AdjustmentParams.scene_var, help="config variable of the excluded scenes")
    ap.add_argument("--area-key", default=AdjustmentParams.area_key, help="deliverer column matched to the area id")
    ap.add_argument("--on-repeated-key", choices=["one", "error"], default=AdjustmentParams.on_repeated_key)
    ap.add_argument("--tie-break", help="columns, comma separated, that order versions of one time (default: all)")
    ap.add_argument("--table", help="config_table: table name to (re)create")
    ap.add_argument("--out", help="output path (written by day where the mart has a day)")
    ap.add_argument("--tasks-per-day", type=int, help="writer tasks (files at most) for each day")
    ap.add_argument("--rows", type=int, default=20)
    a = ap.parse_args(argv)
    if spark is None:
        from .session import build_session
        spark = build_session()
    if a.mart == "config_table":
        return create_config_table(spark, a.table or "mapping_config")
    inputs = dict(kv.split("=", 1) for kv in a.input)
    df = build(spark, a.mart, inputs, a)
    if not a.out:
        df.show(a.rows, truncate=False)
        return df
    if a.mart in DAY_COLUMN:
        # a single-day run answers for its day: if it has no rows any more, it goes
        days = [day_text(a.day, df.schema[DAY_COLUMN[a.mart]].dataType.simpleString())] if a.day else None
        write_by_day(df, a.out, DAY_COLUMN[a.mart], days=days, tasks_per_day=a.tasks_per_day)
    else:
        df.write.mode("overwrite").parquet(a.out)
    return df


if __name__ == "__main__":
    main()
