"""Mart tests on small hand-made frames in the source schemas, one edge row
per hazard (see FIXTURES.md part B).  Expected values are worked out by
hand in the comments."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bazaar.params import (AdjustmentParams, AttributionParams, DayRange, ExposureParams,
                           FunnelParams, LedgerMartParams, OrderMartParams)
from bazaar.plans.event_funnel import event_funnel, source_exposure
from bazaar.plans.ledger_mart import ledger_mart
from bazaar.plans.order_mart import order_mart
from bazaar.plans.order_source import order_source
from bazaar.plans.revenue_adjustment import revenue_adjustment
from bazaar.sources.config import config_frame, create_config_table, preview

ORDERS = ("order_id bigint, order_sn string, type string, status int, country string, "
          "wechat_id bigint, city_id bigint, merchant_id bigint, pay_type string, pay_code string, "
          "item_quantity int, user_id bigint, created_at_local timestamp_ntz, pay_amount bigint, "
          "total bigint, subtotal bigint, fee bigint, tax bigint, discount bigint")
SETTLEMENT = ("id bigint, order_id bigint, order_type string, record_type string, country string, "
              "wechat_id bigint, city_id bigint, company_id bigint, merchant_id bigint, status int, "
              "commission_type string, pay_type string, pay_code string, created_at timestamp_ntz, "
              "created_at_local timestamp_ntz, merchant_to_company bigint, company_to_merchant bigint, "
              "order_amount bigint, service_cash bigint, merchant_liability bigint, tax bigint, "
              "tax2 bigint, revenue bigint, unearned_revenue bigint, product_cost bigint, metadata string")
T = dt.datetime


def _order(oid, user, ts, status=9, typ="GROUP", subtotal=1000, tax=200, merchant=100, qty=2):
    return (oid, f"LG{oid}", typ, status, "GB", 1, 2, merchant, "card", "c1", qty, user, ts,
            1200, 1200, subtotal, 10, tax, 0)


def _ledger(lid, oid, rtype, liab, ts, revenue=0, meta="{}", country="GB"):
    return (lid, oid, "GROUP", rtype, country, 1, 2, 3, 100, 1, "x", "card", "c1", ts, ts,
            0, 0, abs(liab), 0, liab, 0, 0, revenue, 0, 0, meta)


@pytest.fixture(scope="module")
def order_inputs(spark):
    orders = spark.createDataFrame([
        _order(1, 10, T(2025, 11, 19, 10)),                                   # main case
        _order(2, 10, T(2025, 11, 19, 10), status=1, subtotal=0, merchant=200),  # same ts, no ledger
        _order(3, 10, T(2025, 11, 21), status=10, subtotal=None),            # refunds, 2 tickets
        _order(4, None, T(2025, 11, 19), status=20),                          # excluded status
        _order(5, 11, T(2025, 11, 19), typ="OTHER"),                          # excluded type
        _order(6, 11, T(2025, 11, 19), status=None),                          # NULL status drops
        _order(7, 12, T(2025, 11, 19), status=5, subtotal=500, tax=-500),     # 1 + rate = 0
    ], ORDERS)
    settlement = spark.createDataFrame([
        _ledger(1, 1, "PAY", 1200, T(2025, 11, 19), revenue=100,
                meta='{"commission": 120, "subsidy": 50}'),
        _ledger(2, 1, "USE", -600, T(2025, 11, 20)),
        _ledger(3, 1, "REFUND", -300, T(2025, 11, 25)),
        _ledger(4, 3, "REFUND", -100, T(2025, 11, 22), meta="not json"),
        _ledger(5, 7, "PAY", 500, T(2025, 11, 19)),
    ], SETTLEMENT)
    tickets = spark.createDataFrame([("1", "2025-11-30"), ("3", "2025-11-20"), ("3", "2025-11-21")],
                                    "order_id string, expire_date string")
    items = spark.createDataFrame([("1", 5), ("1", 7), ("bad", 9)], "order_id string, item_id bigint")
    extra = spark.createDataFrame([("100", 1000), ("200", 2000)],
                                  "merchant_id string, review_merchant_id bigint")
    cats = spark.createDataFrame([(1000, "2-1"), (2000, "1-9-10"), (2000, "5-5")],
                                 "merchant_id bigint, bing_category string")
    users = spark.createDataFrame([(10, "2025-11-20 00:00:00")],
                                  "user_tid bigint, first_order_order_time string")
    return orders, settlement, tickets, items, extra, cats, users


@pytest.mark.parametrize("params", [{}, {"sequence_chunks": 1}, {"sequence_chunks": 9, "preaggregate_ledger": True}])
def test_order_mart_edge_rows(spark, order_inputs, params):
    out = order_mart(*order_inputs, OrderMartParams(**params))
    got = {r["order_id"]: r for r in out.collect()}
    assert sorted(got) == [1, 2, 3, 7]
    o1, o2, o3, o7 = got[1], got[2], got[3], got[7]
    # o1: tax rate 0.2; PAY 12.00/1.2 = 10; USE -6/1.2 = -5; REFUND -3/1.2 = -2.5;
    # the ticket expires after the refund day, so nothing expired.
    assert o1["tax_rate"] == pytest.approx(0.2)
    assert (o1["Amount"], o1["Amount_USE"], o1["Amount_REFUND"]) == (10.0, -5.0, -2.5)
    assert (o1["Amount_REFUND_expire"], o1["Amount_REFUND_by_user"]) == (0.0, -2.5)
    assert (o1["Amount_left"], o1["has_amount_left"]) == (2.5, True)
    assert (o1["item_Use"], o1["item_refund"], o1["item_left"]) == (-1.0, -0.5, 3.5)
    assert (o1["pay_count"], o1["item_id"], o1["is_drink"]) == (1, 7, False)
    # revenue 1.00; commission 1.20/1.2 = 1; ticket subsidy -0.50/1.2; order subsidy 1.00
    assert o1["revenue"] == 1.0 and o1["revenue_commission"] == 1.0
    assert o1["revenue_subsidy"] == pytest.approx(1.0 - 0.416667)
    assert o1["revenue_others"] == pytest.approx(1.0 - 1.0 + 0.416667 - 1.0)
    # o1 and o2 share a timestamp: same dense rank; lead follows order id.
    assert (o1["order_rank"], o2["order_rank"], o3["order_rank"]) == (1, 1, 2)
    assert (o1["next_order_date"], o1["next_order_date_diff"]) == (dt.date(2025, 11, 19), 0)
    assert (o2["next_order_date"], o2["next_order_date_diff"]) == (dt.date(2025, 11, 21), 2)
    assert o3["next_order_date"] is None
    # o2's merchant is a drink shop ('1-9-10' also matches the prefix)
    assert o2["is_drink"] is True
    assert (o1["Days_To_Next_Non_Drink"], o2["Days_To_Next_Non_Drink"],
            o3["Days_To_Next_Non_Drink"]) == (2, 2, None)
    # first delivery order 2025-11-20 is later than both rank-1 orders
    assert (o1["user_type"], o3["user_type"]) == ("New", "Returning")
    assert (o1["new_b4_delivery"], o1["new_to_delivery"]) == (True, True)
    assert (o3["new_b4_delivery"], o3["new_to_delivery"]) == (False, False)
    # o2: no ledger rows at all
    assert (o2["Amount"], o2["pay_count"], o2["revenue"], o2["status_CHN"]) == (0.0, None, None, "待支付")
    # o3: both tickets expired by 11-22 -> the refund counts once per ticket
    assert (o3["Amount_REFUND"], o3["Amount_REFUND_expire"], o3["Amount_REFUND_by_user"]) == \
        (-1.0, -2.0, 1.0)
    assert (o3["Amount_left"], o3["has_amount_left"], o3["status_CHN"]) == (-1.0, False, "已退款")
    assert o3["item_Use"] == 0.0 and o3["tax_rate"] == 0.0
    # o7: 1 + tax_rate = 0 -> NULL -> 0; no first delivery order -> new_to NULL
    assert (o7["Amount"], o7["status_CHN"]) == (0.0, "其他")
    assert (o7["new_b4_delivery"], o7["new_to_delivery"]) == (True, None)
    assert out.columns[0] == "order_id" and len(out.columns) == 55


def test_order_mart_ticket_grain_and_day_filter(spark, order_inputs):
    out = order_mart(*order_inputs, OrderMartParams(ticket_grain="order",
                                                    days=DayRange("2025-11-21", "2025-11-21")))
    r = out.collect()
    assert [x["order_id"] for x in r] == [3]
    # one term per order: the expired refund counts once; the rank still
    # sees the full history (rank 2)
    assert (r[0]["Amount_REFUND_expire"], r[0]["order_rank"]) == (-1.0, 2)


def test_ledger_mart_json_and_card_fee(spark):
    meta_ok = '{"fp": 250, "commission": "120", "subsidy": 60, "tip": "n/a", "discount": 24}'
    s = spark.createDataFrame([
        _ledger(1, 1, "PAY", 1200, T(2025, 11, 20), revenue=300, meta=meta_ok, country="GB"),
        _ledger(2, 2, "USE", 500, T(2025, 11, 20), revenue=100, meta="oops", country="AU"),
        _ledger(3, 3, "REFUND", -100, T(2025, 11, 21), revenue=0, meta="", country="CA"),
    ], SETTLEMENT)
    fees = spark.createDataFrame([("GBcard", "0.02"), ("AUcard", "bad")], "w_id string, cardfee string")
    out = ledger_mart(s, fees, LedgerMartParams())
    got = {r["id"]: r for r in out.collect()}
    g, a, c = got[1], got[2], got[3]
    assert (g["GST_RATE"], a["GST_RATE"], c["GST_RATE"]) == (1.2, 1.0, 1.0)
    assert (g["fp"], g["dw_commission"], g["tip"]) == (2.5, 1.2, None)
    assert g["revenue_commission"] == pytest.approx(1.0)
    assert g["revenue_card_fees"] == pytest.approx(-12.0 * 0.02)
    assert g["revenue_other"] == pytest.approx(3.0 - 1.0 + 0.5 - 3.0)
    # bad JSON: money fields NULL, so revenue_other is NULL (not coalesced)
    assert a["dw_commission"] is None and a["revenue_other"] is None
    # bad fee text and unmapped key: card fee 0
    assert a["revenue_card_fees"] == 0.0 and c["revenue_card_fees"] == 0.0
    assert (g["is_write_off"], a["is_write_off"], c["is_write_off"]) == (False, True, False)
    assert g["pay_types"] == "GBcard" and g["M_ID"] == "GB100"
    assert len(out.columns) == 46
    day = ledger_mart(s, fees, LedgerMartParams(days=DayRange("2025-11-21", "2025-11-21")))
    assert [r["id"] for r in day.collect()] == [3]


EVENTS = ("dt string, domain string, eventname string, visituserid string, time string, "
          "time_local string, eventvariable string, eventvariable_country string, "
          "eventvariable_wechatid string, eventvariable_language string, eventvariable_orderid string")


def _ev(dt_, name, user, ms=0, var="{}", lang="en", oid=None, domain="app", country="CA", w="7"):
    return (dt_, domain, name, user, str(ms), "", var, country, w, lang, oid)


def test_event_funnel_groups_and_levels(spark):
    ev = spark.createDataFrame([
        _ev("20251126", "DPHomepageView", "u1"),
        _ev("20251126", "DReviewHomePageView", "u1"),
        _ev("20251126", "DPOrderCreated", "u2"),          # level 5 only: UV 1..5 all count u2
        _ev("20251126", "OtherEvent", "u3"),              # exposure only
        _ev("20251126", "DPHomepageView", None),          # NULL user: PV yes, UV no
        _ev("2025-11-26", "DPGoodspPageView", "u4"),      # dashed day, same group
        _ev("20251126", "DPHomepageView", "u5", lang=None),   # NULL language group dropped
        _ev("20251127", "OtherEvent", "u1"),              # group without funnel events dropped
        _ev("20251126", "DPHomepageView", "u6", domain="web"),  # other domain ignored
        _ev("bad", "DPHomepageView", "u7"),               # bad day dropped
    ], EVENTS)
    out = event_funnel(ev, FunnelParams(domain="app"))
    r = out.collect()
    assert len(r) == 1
    r = r[0]
    assert (r["time_date"], r["W_ID"], r["language"]) == (dt.date(2025, 11, 26), "CA7", "en")
    assert (r["exposure_times"], r["exposure_users"]) == (6, 4)
    assert (r["DPHomepage_PV"], r["DPGoods_PV"], r["DPOrderCreated_PV"]) == (3, 1, 1)
    assert (r["DPHomepage_UV"], r["DPMerchan_UV"], r["DPGoods_UV"], r["DPOrderCreated_UV"]) == (3, 2, 2, 1)
    with pytest.raises(ValueError):
        event_funnel(ev, FunnelParams())


def test_source_exposure_list_names(spark):
    cfg = config_frame(spark) .union(config_frame(spark, [
        ("dianping_event_mapping", "Off", "x", "FALSE")]))
    ev = spark.createDataFrame([
        _ev("20251126", "DPHomepageView", "u1", var='{"listName": "L"}'),
        _ev("20251126", "DPHomepageView", "u2", var='{"listName": "", "title": "T"}'),
        _ev("20251126", "DPHomepageView", "u2", var='{"title": "T"}'),
        _ev("20251126", "DPHomepageView", None, var='{}'),
        _ev("20251126", "Off", "u1"),                       # inactive mapping row
    ], EVENTS)
    out = source_exposure(ev, cfg, ExposureParams())
    got = {(r["list_name"], r["source_name_List"]): (r["exposure_times"], r["exposure_users"])
           for r in out.collect()}
    assert got == {("L", "老团购.L"): (1, 1), ("T", "老团购.T"): (2, 1), (None, "老团购"): (1, 0)}


def test_order_source_attribution_edges(spark):
    h = 3_600_000
    d0 = 1_764_115_200_000      # 2025-11-26 00:00:00 UTC in ms
    ev = spark.createDataFrame([
        _ev("20251126", "DPHomepageView", "a", d0 + 1000, '{"listName": "L"}'),
        _ev("20251126", "DPOrderCreated", "a", d0 + 1000 + h, oid="LG1"),     # exactly 1 h
        _ev("20251126", "DPHomepageView", "b", d0 + 1000),
        _ev("20251126", "DPOrderCreated", "b", d0 + 1001 + h, oid="LG2"),     # 1 h + 1 ms
        _ev("20251126", "V2SearchView", "c", d0 + 5000, '{"title": ""}'),
        _ev("20251126", "DPOrderCreated", "c", d0 + 5000, oid="LG3"),         # same ms
        _ev("20251126", "DPOrderCreated", "d", d0 + 9000, oid="XX4"),         # no prefix: dropped
        _ev("20251125", "DPHomepageView", "e", d0 - 60_000),                  # day before
        _ev("20251126", "DPOrderCreated", "e", d0 + 60_000, oid="LG5"),
    ], EVENTS)
    cfg = config_frame(spark)
    p = AttributionParams(days=DayRange("20251126"))
    got = {r["eventvariable_orderid"]: (r["Order_Source"], r["Order_Source_List"])
           for r in order_source(ev, cfg, p).collect()}
    assert got == {"LG1": ("老团购", "老团购.L"), "LG2": ("Not Found", "Not Found"),
                   "LG3": ("搜索", "搜索"), "LG5": ("老团购", "老团购")}
    cut = AttributionParams(days=DayRange("20251126"), lookback=False)
    got2 = {r["eventvariable_orderid"]: r["Order_Source"] for r in order_source(ev, cfg, cut).collect()}
    assert got2["LG5"] == "Not Found"


REVENUE = ("id string, country string, created_at timestamp_ntz, created_at_local string, "
           "updated_at timestamp_ntz, month string, deliverer_id string, restaurant_id string, "
           "restaurant_type string, restaurant_status string, deliverer_status string, "
           "wechat_id string, order_id string, business_scene string, desc_info string, "
           "revenue string, fc string, td string, tr string, cd string, cr string, ra string, "
           "pr string, advertising_income string, rcr string, rebate_liability string")


def _rev(i, country="CA", ts=T(2025, 11, 20), scene="TAKEOUT", desc="delivery", revenue="10",
         fc="1", rtype="Shop", rid=None, did="5", wid="7", month="202511", pr="0", adv="0"):
    return (i, country, ts, "2025-11-20 08:00:00", ts, month, did, rid, rtype, "1", "0", wid,
            "100", scene, desc, revenue, fc, "0", "0", "0", "0", "0", pr, adv, "0.5", "1.25")


def test_revenue_adjustment_rules(spark):
    rv = spark.createDataFrame([
        _rev("a", ts=T(2025, 11, 20), revenue="10"),
        _rev("a", ts=T(2025, 11, 21), revenue="20"),                   # later version wins
        _rev("a", country="GB", revenue="30", did="9"),                # same id, other country
        _rev("b", scene=None),                                         # NULL scene: dropped
        _rev("c", scene="DONE_ORDER"),                                 # excluded scene
        _rev("d", desc="POS fee"), _rev("e", desc="deposit"), _rev("f", desc=None),
        _rev("g", desc="会员", rtype="Restaurant", rid="0042"),          # restaurant branch
        _rev("h", revenue="1", fc="1"),                                # all measures 0: dropped
        _rev("i", revenue="x", fc="0", adv="3"),                       # bad number -> NULL UE
        _rev("j", month="202510"),                                     # before start month
        _rev("k", rtype="Restaurant", rid="kiosk-7"),
    ], REVENUE)
    deliverers = spark.createDataFrame([(5, "CA", 77), (9, "GB", None)],
                                       "id bigint, country string, m_area_id bigint")
    areas = spark.createDataFrame([(77, "CA", 7)], "id bigint, country string, wechat_id bigint")
    cfg = config_frame(spark)
    p = AdjustmentParams(start_month=202511, area_key="m_area_id")
    got = {(r["id"], r["country"]): r for r in revenue_adjustment(rv, deliverers, areas, cfg, p).collect()}
    assert sorted(got) == [("a", "CA"), ("a", "GB"), ("g", "CA"), ("i", "CA"), ("k", "CA")]
    a = got[("a", "CA")]
    assert (a["C_adjustment"], a["UE"], a["B_adjustment"]) == (20.0, 19.0, -1.0)
    assert a["DR_id"] == "CAA77"                     # validated area branch
    assert got[("a", "GB")]["DR_id"] == "GBAW7"      # market fallback
    g = got[("g", "CA")]
    assert (g["DR_id"], g["r_id"], g["IsMember"]) == ("CA0042", "CA0042", True)  # as stored
    assert got[("k", "CA")]["DR_id"] == "CAkiosk-7"  # no number, still an id
    assert got[("i", "CA")]["UE"] is None and got[("i", "CA")]["advertising_income"] == 3.0
    assert len(revenue_adjustment(rv, deliverers, areas, cfg, p).columns) == 15
    # literal area key: deliverer id 5 is not an area id, so no validation
    lit = revenue_adjustment(rv, deliverers, areas, cfg, AdjustmentParams(start_month=202511))
    assert {r["DR_id"] for r in lit.where(F.col("id") == "a").collect()} == {"CAAW7", "GBAW7"}


def test_config_table_create_and_preview(spark):
    t = create_config_table(spark, "bazaar_test_config")
    assert t.count() == 14
    assert [f.name for f in t.schema] == ["variable_name", "value1", "value2", "value3"]
    fmt = spark.sql("DESCRIBE TABLE EXTENDED bazaar_test_config").where("col_name = 'Provider'").first()
    assert fmt["data_type"].lower() == "orc"
    assert preview(t, 10, "value1").count() == 10


@pytest.mark.parametrize("chunks", [None, 7])
def test_order_mart_copies_of_an_order_point_at_each_other(spark, order_inputs, chunks):
    """Order 1 under two countries in the ledger and its user twice in the
    attribute table: four copies.  All but the last see another copy of
    order 1 as the next, a non-drink order of the same day."""
    orders, settlement, *rest, users = order_inputs
    extra = spark.createDataFrame([_ledger(9, 1, "USE", -10, T(2025, 11, 20), country="AU")], settlement.schema)
    twice = users.unionByName(users.select("user_tid", F.lit("2025-11-25 00:00:00").alias("first_order_order_time")))
    out = order_mart(orders, settlement.unionByName(extra), *rest, twice, OrderMartParams(sequence_chunks=chunks)).collect()
    first = [r for r in out if r["order_id"] == 1]
    assert sorted(r["Days_To_Next_Non_Drink"] for r in first) == [0, 0, 0, 2]
    assert sorted(r["next_order_date_diff"] for r in first) == [0, 0, 0, 0]     # order 2 has the same time
    drink = [r for r in out if r["order_id"] == 2]                              # two copies, of a drink shop
    assert sorted(r["next_order_date_diff"] for r in drink) == [0, 2]
    assert [r["Days_To_Next_Non_Drink"] for r in drink] == [2, 2]
    assert {r["order_rank"] for r in first + drink} == {1}


def test_order_mart_ticket_keys_are_text(spark, order_inputs):
    """Tickets match an order by the text of its id: 003 and " 3" are no tickets of order 3."""
    orders, settlement, tickets, *rest = order_inputs
    odd = spark.createDataFrame([("003", "2025-11-01"), (" 3", "2025-11-01"), ("3.0", "2025-11-01"), ("x", "2025-11-01"),
                                 (None, "2025-11-01"), ("3", None), ("3", "bad")], tickets.schema)
    plain, more = (order_mart(orders, settlement, t, *rest).where("order_id = 3").first()["Amount_REFUND_expire"]
                   for t in (tickets, tickets.unionByName(odd)))
    assert plain == more == -2.0


def test_order_mart_refunds_count_once_per_base_row(spark, order_inputs):
    """Two base rows of one order id double its expired refunds, as the join to the base orders does."""
    orders, *rest = order_inputs
    twice = orders.unionByName(orders.where("order_id = 3").withColumn("country", F.lit("AU")))
    got = [r["Amount_REFUND_expire"] for r in order_mart(twice, *rest).where("order_id = 3").collect()]
    assert got == [-4.0, -4.0]


def test_order_mart_lays_out_every_input_once_by_order(spark, order_inputs):
    """Ledger, tickets and base ids share one exchange on the order id, the items and the base rows have one each."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = order_mart(*order_inputs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    by_order = [x for x in text.split("\n") if "Exchange hashpartitioning(order_id" in x]
    assert len(by_order) == 3 and all(x.count("#", 0, x.index(",")) == 1 for x in by_order), by_order
    assert "hashpartitioning(cast(order_id" not in text


def test_order_mart_money_is_exact_below_a_millionth(spark, order_inputs):
    """Fractions of cents in the JSON add up exactly; the rate divides the sum."""
    orders, settlement, *rest = order_inputs
    many = [_ledger(100 + i, 2, "USE", 0, T(2025, 11, 20), meta='{"commission": %s, "subsidy": "%s"}' % c)
            for i, c in enumerate([("0.00001", "0.0000001"), ("0.00002", "1e-7"), ("120000000.5", "-3"),
                                   ("-120000000.5", "n/a"), ('"NaN"', "3"), ("99999999999999999999", "")])]
    out = order_mart(orders, settlement.unionByName(spark.createDataFrame(many, settlement.schema)), *rest)
    r = out.where("order_id = 2").first()
    assert r["revenue_commission"] == 0.00003 / 100.0 / 1.2
    assert r["revenue_subsidy"] == -(0.0000002 / 100.0 / 1.2)


def test_order_mart_default_is_the_literal_order(spark, order_inputs):
    """Order 1 under two countries in the ledger, with the default parameters, over all days and for one."""
    orders, settlement, *rest = order_inputs
    extra = spark.createDataFrame([_ledger(9, 1, "USE", -10, T(2025, 11, 20), country="AU")], settlement.schema)
    mart = order_mart(orders, settlement.unionByName(extra), *rest).where("order_id = 1")
    assert sorted(r["Days_To_Next_Non_Drink"] for r in mart.collect()) == [0, 2]
    day = str(mart.first()["created_at_local"])
    one = order_mart(orders, settlement.unionByName(extra), *rest, OrderMartParams(days=DayRange(day, day)))
    assert sorted(r["Days_To_Next_Non_Drink"] for r in one.where("order_id = 1").collect()) == [0, 2]


def test_order_source_null_visitors(spark):
    d0 = 1_764_115_200_000
    ev = spark.createDataFrame([
        _ev("20251126", "DPHomepageView", None, d0),
        _ev("20251126", "DPOrderCreated", None, d0 + 10, oid="LG1"),
    ], EVENTS)
    cfg = config_frame(spark)
    grouped = order_source(ev, cfg, AttributionParams()).collect()
    apart = order_source(ev, cfg, AttributionParams(group_null_visitors=False)).collect()
    assert [r["Order_Source"] for r in grouped] == ["老团购"]      # NULL visitors form one partition
    assert [r["Order_Source"] for r in apart] == ["Not Found"]


def test_revenue_nonzero_epsilon(spark):
    # 0.3 - 0.1 - 0.2 is 5.55e-17 in doubles: exact test keeps it, epsilon drops it
    rv = spark.createDataFrame([_rev("z", revenue="0.3", fc="0.1")], REVENUE) \
        .withColumn("td", F.lit("0.2"))
    deliverers = spark.createDataFrame([], "id bigint, country string, m_area_id bigint")
    areas = spark.createDataFrame([], "id bigint, country string, wechat_id bigint")
    cfg = config_frame(spark)
    exact = revenue_adjustment(rv, deliverers, areas, cfg, AdjustmentParams())
    eps = revenue_adjustment(rv, deliverers, areas, cfg, AdjustmentParams(nonzero_epsilon=1e-9))
    assert exact.count() == 1 and eps.count() == 0


def test_order_mart_join_on_country(spark, order_inputs):
    orders, settlement, *rest = order_inputs
    extra = spark.createDataFrame([_ledger(9, 1, "USE", -10, T(2025, 11, 20), country="AU")],
                                  settlement.schema)
    inputs = (orders, settlement.unionByName(extra), *rest)
    loose = order_mart(*inputs, OrderMartParams()).where("order_id = 1").count()
    strict = order_mart(*inputs, OrderMartParams(join_on_country=True)).where("order_id = 1")
    assert loose == 2                                  # HZ-12 fan-out kept by default
    assert strict.count() == 1 and strict.first()["Amount_USE"] == -5.0


def test_exposure_approx_users(spark):
    from bazaar.operators.aggregate import exposure_by
    df = spark.createDataFrame([("k", f"u{i % 50}") for i in range(500)], "k string, u string")
    r = exposure_by(df, ["k"], "u", approx=True).first()
    assert r["exposure_times"] == 500 and abs(r["exposure_users"] - 50) <= 3


@pytest.mark.parametrize("days", [DayRange("2025-11-19", "2025-11-19"), DayRange("2025-11-21", None),
                                  DayRange(None, "2025-11-20")])
def test_order_mart_range_pruning_is_exact(spark, order_inputs, days):
    pruned = order_mart(*order_inputs, OrderMartParams(days=days))
    full = order_mart(*order_inputs, OrderMartParams(days=days, prune_to_range=False))
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(pruned) == key(full) and len(key(full)) > 0


def test_cast_layer_types_all_columns(spark):
    """The whole record: 119 columns, among them ``desc`` and ``at``, each with its type."""
    from bazaar.functions.casts import REVENUE_CAST_LAYER, apply_cast_layer
    names = [c for cs in REVENUE_CAST_LAYER.values() for c in cs]
    assert len(names) == len(set(names)) == 119 and {"desc", "at"} <= set(names)
    good = {"string": "a", "bigint": "12", "double": "1.5", "timestamp_ntz": "2025-11-20 01:02:03", "decimal(34,6)": "0.1234565",
            "int": "202511"}
    kind = {c: t for t, cs in REVENUE_CAST_LAYER.items() for c in cs}
    df = spark.createDataFrame([tuple(good[kind[c]] for c in names), tuple("bad" for c in names), tuple(None for c in names)],
                               ", ".join(f"`{c}` string" for c in names))
    out = apply_cast_layer(df, REVENUE_CAST_LAYER, strict=True)
    assert {f.name: f.dataType.simpleString() for f in out.schema} == kind
    a, b, c = out.collect()
    assert str(a["rcr"]) == "0.123457" and a["desc"] == "a" and a["at"] == 1.5 and a["month"] == 202511
    assert b["rcr"] is None and b["at"] is None and b["created_at_local"] is None and b["desc"] == "bad"
    assert all(v is None for v in c)
    with pytest.raises(ValueError, match="missing columns"):
        apply_cast_layer(df.drop("at"), REVENUE_CAST_LAYER, strict=True)


def test_adjustment_survives_repeated_and_null_deliverers(spark):
    """A deliverer and an area found twice leave one row a revenue; rows without a deliverer are kept."""
    rv = spark.createDataFrame([_rev("a", did="1"), _rev("b", did=None), _rev("c", did="9")], REVENUE)
    deliverers = spark.createDataFrame([(1, "CA", 70), (1, "CA", 71)], "id bigint, country string, m_area_id bigint")
    areas = spark.createDataFrame([(1, "CA", 7), (1, "CA", 7)], "id bigint, country string, wechat_id bigint")
    cfg = config_frame(spark)
    out = {r["id"]: r["DR_id"] for r in revenue_adjustment(rv, deliverers, areas, cfg).collect()}
    assert sorted(out) == ["a", "b", "c"] and out["a"] == "CAA71" and out["b"] == out["c"] == "CAAW7"
    strict = revenue_adjustment(rv, deliverers, areas, cfg, AdjustmentParams(on_repeated_key="error"))
    with pytest.raises(Exception, match="found more than once"):
        strict.collect()


def test_adjustment_ties_do_not_depend_on_the_plan(spark):
    """Versions of one time: the same one is kept however rows are dealt."""
    rv = spark.createDataFrame([_rev("a", desc=f"d{i}") for i in range(40)], REVENUE)
    none = spark.createDataFrame([], "id bigint, country string, m_area_id bigint")
    areas = spark.createDataFrame([], "id bigint, country string, wechat_id bigint")
    kept = {revenue_adjustment(rv.repartition(n), none, areas, config_frame(spark)).first()["desc_info"] for n in (1, 3, 7)}
    assert kept == {"d9"}
