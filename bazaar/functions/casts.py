"""Typed cast layer (the 119-cast projection of the revenue mart).

A cast layer is a ``{target type: [columns]}`` dict.  Casting uses
``try_cast`` so bad text becomes NULL (Hive semantics) instead of failing
the job under ANSI mode.  Columns not present in the input are skipped,
and columns not listed pass through unchanged.  Catalyst prunes casts of
columns that nobody reads later.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_cast_layer(df: DataFrame, layer: Mapping[str, Sequence[str]],
                     strict: bool = False) -> DataFrame:
    """Cast the listed columns in place; keep column order."""
    target = {}
    for typ, cols in layer.items():
        for c in cols:
            target[c] = typ
    present = set(df.columns)
    if strict:
        missing = sorted(set(target) - present)
        if missing:
            raise ValueError(f"cast layer names missing columns: {missing}")
    out = []
    for c in df.columns:
        if c in target:
            out.append(F.col(f"`{c}`").try_cast(target[c]).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


# The typed columns of the revenue record, by type and in source
# order within a type.  created_at and updated_at pass through uncast.
REVENUE_CAST_LAYER = {
    "string": [
        "id", "deliverer_id", "desc", "desc_order", "desc_info", "restaurant_type", "deliverer_note_type",
        "settlement_info", "revenue_job_id", "order_sn", "business_scene", "expect_date_local", "country",
    ],
    "bigint": [
        "wechat_id", "order_id", "restaurant_id", "member_id", "pay_type", "transfer_type", "profit_type",
        "restaurant_status", "deliverer_status", "company_id", "summary_id", "note_type",
    ],
    "double": [
        "dtr", "dtc", "ctd", "rtc", "ctr", "income", "revenue", "tax", "itc", "fp", "ds", "dt", "rp", "up",
        "rt", "rtgst", "rtpst", "ut", "utgst", "utpst", "zt", "yt", "ot", "shipping_distance", "np", "alipay",
        "moneris", "wechatpay", "dc", "rc", "sc", "rl", "gst", "fc", "td", "cd", "cr", "tr", "ra", "pr", "pd",
        "sca", "st", "rcp", "rct", "r_fc", "r_gs", "r_gst", "r_pst", "r_cr", "r_tr", "r_ra", "r_pbt", "r_fee",
        "r_fgst", "urevenue", "urevenue_gst", "stripe", "applepay", "googlepay", "braintree_credit_card",
        "braintree_apple_pay", "other_payable_r", "other_income_d", "origin_alipay", "iot_alipay",
        "citcon_alipay", "iot_wechatpay", "citcon_wechatpay", "dynamic_shipping_cost", "bf", "bftgst", "bftpst",
        "noah_alipay", "noah_wechatpay", "braintree_venmo", "braintree_paypal", "rds", "pst", "advance", "bdf",
        "dst", "at", "advertising_income", "unearned_advertising", "ar_adv", "rf", "rft", "refund_amount",
    ],
    "timestamp_ntz": [
        "created_at_local", "updated_at_local",
    ],
    "decimal(34,6)": [
        "rcr", "rebate_liability",
    ],
    "int": [
        "month",
    ],
}
