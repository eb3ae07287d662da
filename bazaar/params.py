"""Typed parameters of the marts.

Every name, rate, tolerance and label the marts use is a parameter; the
defaults are the values the marts are specified with.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written for results to match).
# Settlement record types, in ledger order.
RECORD_TYPES = {
    "pay": "PAY",
    "use": "USE",
    "no_settled": "EXPIRE_NO_SETTLED",
    "settled": "EXPIRE_SETTLED",
    "refund": "REFUND",
}
# Write-off record types of the ledger mart.
WRITE_OFF_TYPES = ("USE", "EXPIRE_NO_SETTLED", "EXPIRE_SETTLED")
# Country -> GST divisor; any other country divides by 1.0.
GST_RATES = {"GB": 1.2, "AU": 1.0}
GST_DEFAULT = 1.0
# Order status -> label; any other status is labelled "其他".
STATUS_LABELS = {1: "待支付", 9: "完成", 10: "已退款"}
STATUS_OTHER = "其他"
# Merchant category prefix of drink shops.
DRINK_PREFIX = "1-9-1"
# Funnel: event name -> level, and the output column names per level.
FUNNEL_LEVELS = {
    "DReviewHomePageView": 1,
    "DPHomepageView": 1,
    "DReviewMerchantItemView": 2,
    "DPGoodspPageView": 3,
    "DPorderConfirmPageView": 4,
    "DPOrderCreated": 5,
}
FUNNEL_PV = ("DPHomepage_PV", "DPMerchan_PV", "DPGoods_PV", "DPConfirmPage_PV", "DPOrderCreated_PV")
FUNNEL_UV = ("DPHomepage_UV", "DPMerchan_UV", "DPGoods_UV", "DPConfirmPage_UV", "DPOrderCreated_UV")
# Attribution: the order event and its order-number prefix.
ORDER_EVENT = "DPOrderCreated"
ORDER_PREFIX = "LG"
NOT_FOUND = "Not Found"
# Config variables.
EVENT_MAPPING_VAR = "dianping_event_mapping"
SCENE_LIST_VAR = "business_scene_order"
# Revenue descriptions counted as membership income.
MEMBER_DESCRIPTIONS = ("prime unrevenue", "prime revenue", "会员", "prime expect income")
# Revenue descriptions excluded: any containing "pos" (case-folded) or "电动车".
EXCLUDED_DESC_FOLDED = "pos"
EXCLUDED_DESC_RAW = "电动车"
# ---------------------------------------------------------------------------


def as_date(d) -> _dt.date | None:
    """Accept date, 'yyyy-MM-dd' or 'yyyyMMdd'."""
    if d is None or isinstance(d, _dt.date):
        return d
    s = str(d).strip().replace("-", "")
    return _dt.date(int(s[:4]), int(s[4:6]), int(s[6:8]))


def lookback_day(start, tolerance_ms: int) -> _dt.date:
    """First day holding events up to ``tolerance_ms`` before ``start``."""
    t0 = _dt.datetime.combine(as_date(start), _dt.time())
    return (t0 - _dt.timedelta(milliseconds=tolerance_ms)).date()


@dataclass(frozen=True)
class DayRange:
    """Inclusive day range; ``None`` ends are open."""
    start: object = None
    end: object = None

    @property
    def start_date(self):
        return as_date(self.start)

    @property
    def end_date(self):
        return as_date(self.end)


@dataclass(frozen=True)
class OrderMartParams:
    order_type: str = "GROUP"
    excluded_status: int = 20
    record_types: dict = field(default_factory=lambda: dict(RECORD_TYPES))
    gst_rates: dict = field(default_factory=lambda: dict(GST_RATES))
    gst_default: float = GST_DEFAULT
    drink_prefix: str = DRINK_PREFIX
    status_labels: dict = field(default_factory=lambda: dict(STATUS_LABELS))
    status_other: str = STATUS_OTHER
    days: DayRange = DayRange()          # output filter, applied after the windows
    ticket_grain: str = "ticket"         # "ticket" (one term per ticket) | "order"
    join_on_country: bool = False        # pivot joined on (order, country) instead of order
    # Into how many chunks the orders are cut for the user sequence (None: the
    # session's shuffle partitions).
    sequence_chunks: int | None = None
    # True: sum the ledger per (order, country, record type, refund day) before
    # it is laid out by order, for ledgers in which few orders hold most rows.
    preaggregate_ledger: bool = False
    # With a day range: window only the history of users with an order in
    # the range, and aggregate the ledger / items only for the range's
    # orders.  Exact for the rows returned; False computes everything.
    prune_to_range: bool = True


@dataclass(frozen=True)
class LedgerMartParams:
    order_type: str = "GROUP"
    gst_rates: dict = field(default_factory=lambda: dict(GST_RATES))
    gst_default: float = GST_DEFAULT
    write_off_types: tuple = WRITE_OFF_TYPES
    days: DayRange = DayRange()


@dataclass(frozen=True)
class FunnelParams:
    domain: str | None = None            # required by the funnel; no default
    days: DayRange = DayRange()
    levels: dict = field(default_factory=lambda: dict(FUNNEL_LEVELS))
    pv_names: tuple = FUNNEL_PV
    uv_names: tuple = FUNNEL_UV


@dataclass(frozen=True)
class ExposureParams:
    days: DayRange = DayRange()
    mapping_var: str = EVENT_MAPPING_VAR
    domain: str | None = None
    approx_users: bool = False


@dataclass(frozen=True)
class AttributionParams:
    days: DayRange = DayRange()
    mapping_var: str = EVENT_MAPPING_VAR
    order_event: str = ORDER_EVENT
    order_prefix: str = ORDER_PREFIX
    tolerance_ms: int = 3_600_000
    not_found: str = NOT_FOUND
    # Read sources one tolerance before the first output day, so orders
    # just after midnight keep their attribution.  False = cut at the day.
    lookback: bool = True
    domain: str | None = None
    # First rows by visitor, time and order number, or None for all.
    limit: int | None = None
    # Into how many chunks the events are cut for the match (None: the
    # session's shuffle partitions).
    chunks: int | None = None
    # True: rows without a visitor id form one visitor, as in SQL windows.
    # False: an order without a visitor id is never attributed.
    group_null_visitors: bool = True


@dataclass(frozen=True)
class AdjustmentParams:
    start_month: int | None = None
    scene_var: str = SCENE_LIST_VAR
    area_key: str = "id"                 # deliverer column matched to area id
    member_descriptions: tuple = MEMBER_DESCRIPTIONS
    excluded_desc_folded: str = EXCLUDED_DESC_FOLDED
    excluded_desc_raw: str = EXCLUDED_DESC_RAW
    source_tag: str = "dw_revenues"
    # Non-zero test of the measures: None = exact (x != 0); a value = |x| > eps,
    # for doubles left with rounding noise by the chain of subtractions.
    nonzero_epsilon: float | None = None
    # First rows by id and country, or None for all.
    limit: int | None = None
    # A deliverer or area found twice under its key: "one" of them is used, or
    # the job ends with an "error".
    on_repeated_key: str = "one"
