"""Ledger mart: one row per settlement record, money in units, JSON money
fields, card-fee lookup and the revenue decomposition.

No aggregation and no window, so the day filter is applied on the
record's timestamp before anything else and reaches the Parquet scan as a
pushed range filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import cents_to_money, composite_id, json_field, json_fields, value_map
from ..operators.join import lookup
from ..params import LedgerMartParams

# The output columns, in order.
CONTRACT = [
    "order_id", "country", "wechat_id", "company_id", "merchant_to_company",
    "company_to_merchant", "order_amount", "service_cash", "merchant_liability", "tax", "tax2",
    "revenue", "unearned_revenue", "product_cost", "status", "commission_type",
    "created_at_local", "C_ID", "M_ID", "record_type", "id", "created_at_local_time",
    "pay_types", "revenue_card_fees", "days_from_pay", "fp", "up", "dw_subtotal",
    "dw_commission", "tip", "dw_discount", "dw_subsidy", "dw_mliability", "GST_RATE",
    "revenue_commission", "revenue_subsidy_ticket", "discount", "revenue_other",
    "revenue_subsidy_order", "revenue_ft", "has_order", "is_write_off", "orders_write_off",
    "created_at", "refund_type", "merchant_id",
]

_SCALED = ["merchant_to_company", "company_to_merchant", "order_amount", "service_cash",
           "merchant_liability", "tax", "tax2", "revenue", "unearned_revenue", "product_cost"]
# JSON key -> output column
_JSON = {"fp": "fp", "up": "up", "subtotal": "dw_subtotal", "commission": "dw_commission",
         "tip": "tip", "discount": "dw_discount", "subsidy": "dw_subsidy",
         "mliability": "dw_mliability"}


def card_fee_rates(card_fee: DataFrame) -> DataFrame:
    """Rate table: key text -> fee rate (bad text -> NULL rate)."""
    return card_fee.select(F.col("w_id").alias("payment_match_key"),
                           F.col("cardfee").try_cast("double").alias("fee_rate"))


def ledger_mart(settlement: DataFrame, card_fee: DataFrame,
                p: LedgerMartParams = LedgerMartParams()) -> DataFrame:
    s = settlement.where(F.col("order_type") == F.lit(p.order_type))
    day = F.to_date("created_at_local")
    if p.days.start_date is not None:
        s = s.where(day >= F.lit(p.days.start_date))
    if p.days.end_date is not None:
        s = s.where(day <= F.lit(p.days.end_date))
    gst = value_map("country", p.gst_rates, p.gst_default).cast("double")
    s = s.withColumn("__meta", json_fields("metadata"))
    raw = s.select(
        "id", "order_id", "country", "wechat_id", "company_id", "status", "commission_type",
        "record_type", "created_at", "merchant_id",
        day.alias("created_at_local"),
        F.col("created_at_local").try_cast("timestamp_ntz").alias("created_at_local_time"),
        "pay_type", "pay_code",
        composite_id("country", "pay_type", null_safe=True).alias("pay_types"),
        composite_id("country", "merchant_id").alias("M_ID"),
        composite_id("country", "city_id").alias("C_ID"),
        gst.alias("GST_RATE"),
        *[cents_to_money(c).alias(c) for c in _SCALED],
        *[(json_field("__meta", k).try_cast("double") / 100.0).alias(out) for k, out in _JSON.items()],
    )
    x = lookup(raw, card_fee_rates(card_fee), [("pay_types", "payment_match_key")])
    x = x.withColumns({
        "revenue_card_fees": F.coalesce(-F.col("order_amount") * F.col("fee_rate"), F.lit(0.0)),
        "revenue_subsidy_order": F.when(F.col("record_type") == F.lit("PAY"), F.col("revenue"))
                                  .otherwise(F.lit(0.0)),
        "revenue_commission": F.col("dw_commission") / F.col("GST_RATE"),
        "revenue_subsidy_ticket": -F.col("dw_subsidy") / F.col("GST_RATE"),
        "discount": F.col("dw_discount") / F.col("GST_RATE"),
    })
    x = x.withColumns({
        "revenue_other": (F.col("revenue") - F.col("revenue_commission")
                          - F.col("revenue_subsidy_ticket") - F.col("revenue_subsidy_order")),
        "revenue_ft": F.col("revenue") + F.col("revenue_card_fees"),
        "days_from_pay": F.lit(None).cast("int"),
        "has_order": F.lit(None).cast("boolean"),
        "is_write_off": F.coalesce(F.col("record_type").isin(list(p.write_off_types)), F.lit(False)),
        "orders_write_off": F.lit(0),
        "refund_type": F.lit(None).cast("string"),
    })
    return x.select(*CONTRACT)
