"""Reference-shaped inputs derived from the driver's TPC-H-style tables.

The marts take the marketplace schemas (orders, settlement ledger, app
events, revenues, ...).  These functions build those frames from the
driver tables with Spark, so every mart runs over whole tables and its
work grows with them.  Each derivation is mirrored in SQL by
``bazaar.plans.oracle`` for the DuckDB check.

Mapping in short:
  orders      <- orders + customer + nation   (country = customer nation)
  settlement  <- lineitem + derived orders    (record type from return flag / line status)
  tickets     <- orders                        (two tickets for urgent orders)
  items       <- lineitem;  merchant_extra <- nation;  categories <- region
  user_attr   <- first signup event per user, shifted 26 years back
  app events  <- events + customer + nation
  revenues    <- lineitem + supplier + nation; deliverers <- supplier; areas <- nation
  card fees   <- distinct (nation, segment) of customer

The ``edge_*`` inputs are the same rows with the cases that real data has and
the plain ones lack: missing users and statuses, orders under two countries,
other ledger types, ticket keys that only look like an order's, days in two
forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import REVENUE_CAST_LAYER
from ..functions.columns import epoch_millis
from .tables import Tables


def cents(c: Column) -> Column:
    """Price -> integer cents, half up (a plain codegen expression; Spark's
    ``round`` on doubles goes through BigDecimal per call)."""
    return F.floor(c * F.lit(100.0) + F.lit(0.5)).cast("bigint")


def _customer_market(t: Tables) -> DataFrame:
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    return (t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left"))


def group_orders(t: Tables) -> DataFrame:
    o = t.orders.join(_customer_market(t), F.col("o_custkey") == F.col("c_custkey"), "left")
    sub = cents(F.col("o_totalprice"))
    prio = F.col("o_orderpriority")
    status = (F.when(F.col("o_orderstatus") == "O", 1)
              .when(F.col("o_orderstatus") == "F", 9)
              .when(F.col("o_orderstatus") == "P",
                    F.when(prio == "1-URGENT", 20).otherwise(10)))
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit("LG"), F.col("o_orderkey").cast("string")).alias("order_sn"),
        F.when(prio == "5-LOW", "DELIVERY").otherwise("GROUP").alias("type"),
        status.cast("int").alias("status"),
        F.col("n_name").alias("country"),
        F.col("c_nationkey").cast("bigint").alias("wechat_id"),
        F.col("n_regionkey").cast("bigint").alias("city_id"),
        F.col("c_nationkey").cast("bigint").alias("merchant_id"),
        F.col("c_mktsegment").alias("pay_type"),
        prio.alias("pay_code"),
        F.substring(prio, 1, 1).cast("int").alias("item_quantity"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("created_at_local"),
        sub.alias("pay_amount"), sub.alias("total"), sub.alias("subtotal"),
        (F.col("c_nationkey").cast("bigint") * 10).alias("fee"),
        F.expr("(CAST(FLOOR(o_totalprice * 100.0 + 0.5) AS BIGINT) * n_regionkey) div 20").alias("tax"),
        F.when(prio == "2-HIGH", F.expr("CAST(FLOOR(o_totalprice * 100.0 + 0.5) AS BIGINT) div 20"))
         .otherwise(F.lit(0).cast("bigint")).alias("discount"),
    )


def record_type() -> Column:
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return (F.when(rf == "R", "REFUND")
            .when(rf == "N", F.when(ls == "O", "PAY").otherwise("USE"))
            .when(ls == "F", "EXPIRE_SETTLED").otherwise("EXPIRE_NO_SETTLED"))


def settlement(t: Tables) -> DataFrame:
    o = group_orders(t).select("order_id", "country", "wechat_id", "city_id", "merchant_id",
                               "pay_type", "pay_code")
    x = t.lineitem.join(o, F.col("l_orderkey") == F.col("order_id"), "inner")
    ep = F.col("l_extendedprice")
    amount = cents(ep)
    rev = cents(ep * F.col("l_discount"))
    taxc = cents(ep * F.col("l_tax"))
    rt = record_type()
    liab = F.when(rt == "REFUND", -amount).otherwise(amount)
    s = lambda c: c.cast("string")
    meta = F.concat(
        F.lit('{"fp":'), s(amount), F.lit(',"up":'), s(F.col("l_partkey")),
        F.lit(',"subtotal":'), s(amount), F.lit(',"commission":'), s(rev),
        F.lit(',"tip":'), F.when(F.col("l_returnflag") == "A", F.lit('"n/a"'))
                           .otherwise(s(F.col("l_linenumber"))),
        F.lit(',"discount":'), s(rev),
        F.when(F.col("l_linenumber") == 1, F.lit(""))
         .otherwise(F.concat(F.lit(',"subsidy":'), s(taxc))),
        F.lit(',"mliability":'), s(liab), F.lit("}"))
    meta = F.when(F.col("l_linenumber") == 7, F.lit("not json")).otherwise(meta)
    return x.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.lit("GROUP").alias("order_type"),
        rt.alias("record_type"),
        "country", "wechat_id", "city_id",
        F.col("city_id").alias("company_id"),
        "merchant_id",
        F.col("l_linenumber").alias("status"),
        F.col("l_linestatus").alias("commission_type"),
        "pay_type", "pay_code",
        F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("created_at_local"),
        rev.alias("merchant_to_company"),
        (amount - rev).alias("company_to_merchant"),
        amount.alias("order_amount"),
        taxc.alias("service_cash"),
        liab.alias("merchant_liability"),
        taxc.alias("tax"),
        F.lit(0).cast("bigint").alias("tax2"),
        rev.alias("revenue"),
        (amount - rev).alias("unearned_revenue"),
        cents(F.col("l_quantity")).alias("product_cost"),
        meta.alias("metadata"),
    )


def tickets(t: Tables) -> DataFrame:
    o = t.orders.where(F.col("o_orderpriority") != "3-MEDIUM")
    first = o.select(F.col("o_orderkey").cast("string").alias("order_id"),
                     F.date_format("o_orderdate", "yyyy-MM-dd").alias("expire_date"))
    second = (o.where(F.col("o_orderpriority") == "1-URGENT")
              .select(F.col("o_orderkey").cast("string").alias("order_id"),
                      F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "yyyy-MM-dd")
                      .alias("expire_date")))
    return first.unionByName(second)


def items(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").cast("string").alias("order_id"),
                             F.col("l_partkey").alias("item_id"))


def merchant_extra(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").cast("string").alias("merchant_id"),
                           F.col("n_regionkey").cast("bigint").alias("review_merchant_id"))


def categories(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_regionkey").cast("bigint").alias("merchant_id"),
                           F.col("r_name").alias("bing_category"))


def user_attr(t: Tables) -> DataFrame:
    return (t.events.where(F.col("event_type") == "signup")
            .groupBy("user_id")
            .agg((F.min("ts") - F.expr("INTERVAL 26 YEARS")).cast("string")
                 .alias("first_order_order_time"))
            .select(F.col("user_id").alias("user_tid"), "first_order_order_time"))


def app_events(t: Tables) -> DataFrame:
    e = t.events.join(_customer_market(t), F.col("user_id") == F.col("c_custkey"), "left")
    k = F.get_json_object("props", "$.k")
    et = F.col("event_type")
    ev = (F.when(et == "view", F.concat(F.lit('{"listName":"list'), k, F.lit('"}')))
          .when(et == "click", F.concat(F.lit('{"listName":"","title":"title'), k, F.lit('"}')))
          .when(et == "purchase", F.lit('{"title":""}'))
          .otherwise(F.col("props")))
    oid = F.when(et == "purchase",
                 F.concat(F.when(k.try_cast("int") < 10, F.lit("XX")).otherwise(F.lit("LG")),
                          F.col("event_id").cast("string")))
    return e.select(
        F.date_format("ts", "yyyyMMdd").alias("dt"),
        F.when(et == "error", "web").otherwise("app").alias("domain"),
        et.alias("eventname"),
        F.when(F.col("user_id") != 0, F.col("user_id").cast("string")).alias("visituserid"),
        epoch_millis("ts").cast("string").alias("time"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time_local"),
        ev.alias("eventvariable"),
        F.col("n_name").alias("eventvariable_country"),
        F.col("n_regionkey").cast("string").alias("eventvariable_wechatid"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("eventvariable_language"),
        oid.alias("eventvariable_orderid"),
    )


def revenues(t: Tables) -> DataFrame:
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    sup = (t.supplier.select("s_suppkey", "s_nationkey")
           .join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left"))
    x = t.lineitem.join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    s = lambda c: c.cast("string")
    ln, rf, ls = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    ep = F.col("l_extendedprice")
    desc = (F.when(ln == 1, "prime revenue").when(ln == 2, "POS fee").when(ln == 3, "会员")
            .when(ln == 4, F.lit(None).cast("string")).when(ln == 5, "deposit refund")
            .otherwise("delivery"))
    scene = (F.when(rf == "A", "DONE_ORDER").when(rf == "N", "TAKEOUT")
             .when(ls == "O", "GROUP_BUY"))
    return x.select(
        F.concat(s(F.col("l_orderkey")), F.lit("-"), s(ln)).alias("id"),
        F.col("n_name").alias("country"),
        F.col("l_shipdate").alias("created_at"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("created_at_local"),
        F.col("l_shipdate").alias("updated_at"),
        F.date_format("l_shipdate", "yyyyMM").alias("month"),
        s(F.col("l_suppkey")).alias("deliverer_id"),
        F.when(ls == "O", s(F.col("l_partkey"))).alias("restaurant_id"),
        F.when(rf == "N", "Restaurant").otherwise("Shop").alias("restaurant_type"),
        F.when((rf == "R") & (ln == 1), "-1").otherwise("1").alias("restaurant_status"),
        F.when(ln == 6, "x").otherwise("0").alias("deliverer_status"),
        s(F.col("n_regionkey")).alias("wechat_id"),
        s(F.col("l_orderkey")).alias("order_id"),
        scene.alias("business_scene"),
        desc.alias("desc_info"),
        s(ep).alias("revenue"),
        s(ep * F.col("l_discount")).alias("fc"),
        s(ep * F.col("l_tax")).alias("td"),
        F.lit("0").alias("tr"),
        F.when(ls == "F", s(F.col("l_quantity"))).otherwise("0").alias("cd"),
        F.when(ln == 5, "bad").otherwise("0").alias("cr"),
        F.lit("0").alias("ra"),
        F.when(ls == "F", s(F.col("l_discount"))).otherwise("0").alias("pr"),
        F.when(rf == "R", s(F.col("l_quantity"))).otherwise("0").alias("advertising_income"),
        s(F.col("l_tax")).alias("rcr"),
        s(F.col("l_discount")).alias("rebate_liability"),
        s(F.col("l_suppkey")).alias("summary_id"),
        s(F.col("l_partkey")).alias("note_type"),
    )


def deliverers(t: Tables) -> DataFrame:
    n = t.nation.select("n_nationkey", "n_name")
    return (t.supplier.join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select(F.col("s_suppkey").alias("id"), F.col("n_name").alias("country"),
                    F.when(F.col("s_acctbal") > 0, F.col("s_nationkey").cast("bigint"))
                    .alias("m_area_id")))


def areas(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"),
                           F.col("n_name").alias("country"),
                           F.col("n_regionkey").cast("bigint").alias("wechat_id"))


def card_fees(t: Tables) -> DataFrame:
    c = _customer_market(t).where(F.col("c_mktsegment") != "MACHINERY")
    return (c.select(F.concat("n_name", "c_mktsegment").alias("w_id"),
                     F.when(F.col("n_regionkey") == 4, F.lit("n/a"))
                     .otherwise(F.concat(F.lit("0.0"), (F.col("n_regionkey") + 1).cast("string")))
                     .alias("cardfee"))
            .distinct())


# ------------------------------------------------------------ edge inputs
def edge_orders(t: Tables) -> DataFrame:
    """Every 7th order has no user, every 11th no status."""
    key = F.col("order_id")
    return group_orders(t).withColumns({"user_id": F.when(key % 7 != 0, F.col("user_id")),
                                        "status": F.when(key % 11 != 0, F.col("status"))})


def edge_settlement(t: Tables) -> DataFrame:
    """Line 3 is booked in another country, line 6 of another type, and the
    JSON of line 2 names its commission twice and has fractions of a cent."""
    line = F.col("status")  # the line number
    twice = F.regexp_replace("metadata", '"commission":', '"commission":"0.0000125","commission":')
    return settlement(t).withColumns({
        "country": F.when(line == 3, F.lit("NATION_7")).otherwise(F.col("country")),
        "order_type": F.when(line == 6, F.lit("DELIVERY")).otherwise(F.col("order_type")),
        "metadata": F.when(line == 2, twice).otherwise(F.col("metadata"))})


def edge_tickets(t: Tables) -> DataFrame:
    """Further tickets whose keys are the number of an order, but not its text."""
    return tickets(t).unionByName(tickets(t).withColumn("order_id", F.concat(F.lit("00"), "order_id")))


def edge_events(t: Tables) -> DataFrame:
    """Even days are dashed, and every event name comes in two."""
    day = F.col("dt")
    second = F.pmod(F.substring("time", -1, 1).cast("int"), F.lit(2))
    dashed = F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2))
    return app_events(t).withColumns({
        "dt": F.when(F.substring(day, 7, 2).cast("int") % 2 == 0, dashed).otherwise(day),
        "eventname": F.concat("eventname", second.cast("string"))})


def revenue_texts(dialect: str) -> dict[str, str]:
    """SQL text of every typed column of the revenue record, as text: numbers,
    times, NULLs and text that is none, from the key, customer and day of an
    order.  ``dialect``: "spark" or "duckdb"."""
    text = "STRING" if dialect == "spark" else "VARCHAR"
    when = "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')" if dialect == "spark" else \
        "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"
    out = {}
    for kind, names in REVENUE_CAST_LAYER.items():
        for j, name in enumerate(names, 2):
            number = f"CAST(o_custkey % {j + 5} - {j % 3} AS {text})"
            good = {"string": f"concat('{name} ', CAST(o_custkey AS {text}))", "bigint": number,
                    "double": f"concat({number}, '.', CAST(o_orderkey % 100 AS {text}))",
                    "decimal(34,6)": f"concat({number}, '.000', CAST(o_orderkey % 10000 AS {text}))",
                    "timestamp_ntz": when, "int": f"CAST(year(o_orderdate) * 100 + month(o_orderdate) AS {text})"}[kind]
            out[name] = (f"CASE (o_orderkey + {j}) % 9 WHEN 0 THEN NULL WHEN 1 THEN 'bad' WHEN 2 THEN '' ELSE {good} END")
    return out


def full_revenues(t: Tables) -> DataFrame:
    """The whole revenue record (119 columns of text) for every order."""
    return t.orders.select(*[F.expr(e).alias(c) for c, e in revenue_texts("spark").items()])
