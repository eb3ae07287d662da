"""Order mart: one row per order with ledger amounts, item shares and the
user's order sequence.

Inputs use the source schemas (see FIXTURES.md):
orders, settlement, tickets, items, merchant_extra, categories, user_attr.

Plan outline (Exchanges in brackets):
  user sequence on base orders     [range of user, time, id], [chunk]; summary of two rows a chunk
  day filter                       right after it: ranks need full history, nothing else does
  ledger rows and ticket days      one union [order_id]: expired refunds, sums per country and order
  items max per order              [order_id]; partial agg
  left-join ledger, items          base [order_id]
  drink flag per merchant, user attributes: lookups, broadcast if small
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (cents_to_money, composite_id, decimal_text, json_pick, net_of_rate, round_double,
                                 safe_ratio, scale_cents, sum_cents, to_double, to_money,
                                 value_map)
from ..operators.aggregate import amount_type, pivot_sum_by_type
from ..operators.join import lookup
from ..operators.window import user_sequence
from ..params import OrderMartParams

# The output columns, in order.
CONTRACT = [
    "order_id", "order_sn", "status", "country", "wechat_id", "city_id", "merchant_id",
    "pay_type", "pay_code", "item_quantity", "user_id", "created_at_local",
    "created_at_local_time", "dw_pay_amount", "dw_total", "dw_subtotal", "dw_fee", "dw_tax",
    "dw_discount", "M_ID", "C_ID", "tax_rate", "Amount", "Amount_USE", "Amount_NO_SETTLED",
    "Amount_SETTLED", "Amount_REFUND", "Amount_REFUND_expire", "Amount_REFUND_by_user",
    "Amount_left", "item_Use", "item_No_settled", "item_Settled", "item_refund",
    "item_refund_expire", "item_refund_by_user", "item_left", "pay_count", "order_rank",
    "next_order_date", "user_type", "revenue", "revenue_commission", "revenue_subsidy",
    "next_order_date_diff", "item_id", "status_CHN", "revenue_others", "revenue_card_fees",
    "has_amount_left", "new_b4_delivery", "new_to_delivery", "revenue_for_commission",
    "is_drink", "Days_To_Next_Non_Drink",
]

_MONEY_IN = ["pay_amount", "total", "subtotal", "fee", "tax", "discount"]


def base_orders(orders: DataFrame, p: OrderMartParams) -> DataFrame:
    o = orders.where((F.col("type") == F.lit(p.order_type))
                     & (F.col("status") != F.lit(p.excluded_status)))
    return o.select(
        "order_id", "order_sn", "status", "country", "wechat_id", "city_id", "merchant_id",
        "pay_type", "pay_code", "item_quantity", "user_id",
        F.to_date("created_at_local").alias("created_at_local"),
        F.col("created_at_local").alias("created_at_local_time"),
        *[cents_to_money(c).alias(f"dw_{c}") for c in _MONEY_IN],
        composite_id("country", "merchant_id").alias("M_ID"),
        composite_id("country", "city_id").alias("C_ID"),
    )


def gst_rate(country: str, p) -> F.Column:
    return value_map(country, p.gst_rates, p.gst_default).cast("double")


def ledger_terms(settlement: DataFrame, p: OrderMartParams) -> DataFrame:
    """What the sums need of each ledger row; ``refund_day`` on refunds only.

    Whole cents stay bigint until they are summed (see ``in_cents``); other
    types, and sums taken before, are decimal units.
    """
    s = (settlement.where((F.col("order_type") == F.lit(p.order_type)) & F.col("order_id").isNotNull())
         .withColumn("__meta", json_pick("metadata", "commission", "subsidy")))
    refund = F.col("record_type") == F.lit(p.record_types["refund"])
    whole = not p.preaggregate_ledger and all(
        isinstance(s.schema[c].dataType, T.IntegralType) for c in ("merchant_liability", "revenue"))

    def money(c):
        return F.col(c).cast("bigint") if whole else scale_cents(c)
    terms = s.select("order_id", "country", "record_type", F.lit(1).cast("bigint").alias("rows"),
                     money("merchant_liability").alias("liability"), money("revenue").alias("revenue"),
                     decimal_text("__meta.commission").alias("commission"),
                     decimal_text("__meta.subsidy").alias("subsidy"),
                     F.when(refund, F.to_date("created_at")).alias("refund_day"))
    if p.preaggregate_ledger:
        keys = ["order_id", "country", "record_type", "refund_day"]
        terms = terms.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in terms.columns if c not in keys])
    return terms


def in_cents(terms: DataFrame) -> bool:
    return amount_type(terms, F.col("liability")) == "bigint"


def ledger_sums(terms: DataFrame, p: OrderMartParams, *extra: F.Column) -> DataFrame:
    """Ledger sums per (order, country) by record type, plus revenue parts.

    Numbers out of the JSON text are summed as exact decimals; the rate
    belongs to the group, so it divides each sum once.
    """
    rt = p.record_types
    total = sum_cents if in_cents(terms) else F.sum
    zero = F.lit(0).cast(amount_type(terms, F.col("revenue")))
    paid = F.col("record_type") == F.lit(rt["pay"])
    sums = pivot_sum_by_type(
        terms, ["order_id", "country"], "record_type",
        {f"liability_{k}": rt[k] for k in ("pay", "use", "no_settled", "settled", "refund")},
        F.col("liability"),
        extra=[F.coalesce(F.sum(F.when(paid, F.col("rows"))), F.lit(0)).alias("pay_count"),
               total(F.col("revenue")).alias("revenue_base_total"), F.sum("commission").alias("commission"),
               F.sum("subsidy").alias("subsidy"),
               total(F.when(paid, F.col("revenue")).otherwise(zero)).alias("revenue_subsidy_order_calculated"), *extra],
        total=total)

    def net(c):
        return F.coalesce(to_double(c), F.lit(0.0)) / 100.0 / gst_rate("country", p)
    return (sums.withColumns({"revenue_commission_calculated": net("commission"),
                              "revenue_subsidy_ticket_calculated": -net("subsidy")}).drop("commission", "subsidy"))


def settlement_pivot(settlement: DataFrame, p: OrderMartParams) -> DataFrame:
    return ledger_sums(ledger_terms(settlement, p), p)


def ticket_days(tickets: DataFrame, p: OrderMartParams) -> DataFrame:
    """(order_id bigint, expire_day) of the tickets that can match an order.

    Ticket keys are text and match an order whose id has that very text: the
    rows are laid out by the number, and the text must be the number's own
    (``007`` is no ticket of order 7).
    """
    t = tickets.select(F.col("order_id").try_cast("bigint").alias("order_id"), F.col("order_id").alias("key"),
                       F.col("expire_date").try_cast("date").alias("expire_day"))
    t = (t.where((F.col("order_id").cast("string") == F.col("key")) & F.col("expire_day").isNotNull())
         .select("order_id", "expire_day"))
    if p.ticket_grain == "order":
        return t.groupBy("order_id").agg(F.min("expire_day").alias("expire_day"))
    if p.ticket_grain != "ticket":
        raise ValueError("ticket_grain must be 'ticket' or 'order'")
    return t


def ledger_by_order(settlement: DataFrame, tickets: DataFrame, base: DataFrame, p: OrderMartParams,
                    range_orders: DataFrame | None = None) -> DataFrame:
    """``ledger_sums`` with ``liability_refund_expire``: the refund liability
    of the whole order, once for each of its tickets that had expired by the
    refund day and for each of the base rows of its id (NULL without refunds).

    Ledger rows, ticket days and base order ids share one layout by order:
    sorted by day, a running count of the ticket days gives every refund its
    expired tickets, without a join and whatever their number.  ``copy`` and
    ``copies`` number the countries of an order.
    """
    def kind(df, name):
        return df.withColumn("kind", F.lit(name))

    rows = kind(ledger_terms(settlement, p), "ledger")
    for more in (kind(ticket_days(tickets, p).withColumnRenamed("expire_day", "refund_day"), "ticket"),
                 kind(base.select("order_id").where(F.col("order_id").isNotNull()), "order")):
        rows = rows.unionByName(more, allowMissingColumns=True)
    if range_orders is not None:
        rows = rows.join(range_orders, "order_id", "left_semi")
    order = Window.partitionBy("order_id")
    by_day = (order.orderBy(F.col("refund_day").asc_nulls_first())
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    expired = F.count(F.when(F.col("kind") == "ticket", F.lit(1))).over(by_day)
    known = F.count(F.when(F.col("kind") == "order", F.lit(1))).over(order)
    refund = F.col("record_type") == F.lit(p.record_types["refund"])
    liability = scale_cents("liability") if in_cents(rows) else F.col("liability")
    laid = (rows.repartition("order_id").withColumn("times", (expired * known).cast("decimal(10,0)"))
            .where(F.col("kind") == "ledger")
            .withColumn("late", F.when(refund, F.coalesce(liability * F.col("times"), F.lit(0)))))
    sums = ledger_sums(laid, p, F.sum("late").alias("late"))
    return sums.withColumns({
        "liability_refund_expire": F.sum("late").over(order), "copies": F.count(F.lit(1)).over(order),
        "copy": F.row_number().over(order.orderBy("country"))}).drop("late")


def item_category(items: DataFrame, merchant_extra: DataFrame, categories: DataFrame,
                  p: OrderMartParams):
    """(max item id per order, drink flag per merchant).

    The flag is a property of the merchant, so it is computed once per
    merchant instead of once per (order, item) row.
    """
    per_order = (items.select(F.col("order_id").try_cast("bigint").alias("order_id"), "item_id")
                 .where(F.col("order_id").isNotNull())
                 .groupBy("order_id").agg(F.max("item_id").alias("item_id")))
    extra = merchant_extra.select(F.col("merchant_id").try_cast("bigint").alias("x_merchant_id"),
                                  "review_merchant_id")
    cats = categories.select(F.col("merchant_id").alias("c_merchant_id"), "bing_category")
    drink = (lookup(extra, cats, [("review_merchant_id", "c_merchant_id")])
             .groupBy("x_merchant_id")
             .agg(F.bool_or(F.coalesce(F.col("bing_category").startswith(p.drink_prefix),
                                       F.lit(False))).alias("m_is_drink")))
    return per_order, drink


def user_copies(user_attr: DataFrame) -> DataFrame:
    """First delivery time per user; a repeated user keeps its rows, numbered."""
    ua = user_attr.select("user_tid", F.col("first_order_order_time").try_cast("timestamp_ntz").alias("first_delivery_ts"))
    user = Window.partitionBy("user_tid")
    return ua.where(F.col("user_tid").isNotNull()).withColumns({
        "user_copies": F.count(F.lit(1)).over(user),
        "user_copy": F.row_number().over(user.orderBy("first_delivery_ts"))})


def order_mart(orders: DataFrame, settlement: DataFrame, tickets: DataFrame,
               items: DataFrame, merchant_extra: DataFrame, categories: DataFrame,
               user_attr: DataFrame, p: OrderMartParams = OrderMartParams()) -> DataFrame:
    base = every = base_orders(orders, p)
    per_order, drink = item_category(items, merchant_extra, categories, p)
    range_orders = None
    if p.prune_to_range and (p.days.start_date is not None or p.days.end_date is not None):
        # Sequence values depend only on the user's orders, so the history of
        # the range's users is enough (NULL users match null-safe); ledger, tickets
        # and items of the range's orders are.
        in_range = filter_days(base, "created_at_local", p.days)
        active = in_range.select(F.col("user_id").alias("__active_user")).distinct()
        base = base.join(active, base["user_id"].eqNullSafe(active["__active_user"]), "left_semi")
        range_orders = in_range.select("order_id").where(F.col("order_id").isNotNull())
        per_order = per_order.join(range_orders, "order_id", "left_semi")

    x = lookup(base, drink, [("merchant_id", "x_merchant_id")], spread_by="order_id")
    x = x.withColumn("is_drink", F.coalesce(F.col("m_is_drink"), F.lit(False))).drop("m_is_drink")
    # The sequence runs on the narrow base rows, before the joins that may fan
    # an order out (two countries in the ledger, a repeated user id).
    x = user_sequence(x, "user_id", "created_at_local_time", "order_id", "created_at_local",
                      rank_out="order_rank", next_out="next_order_date",
                      match=(F.col("is_drink") == F.lit(False)), match_out="next_non_drink",
                      chunks=p.sequence_chunks)
    x = filter_days(x, "created_at_local", p.days)
    x = lookup(x, user_copies(user_attr), [("user_id", "user_tid")], spread_by="order_id")
    first = F.col("order_rank") == 1
    later = F.col("first_delivery_ts") > F.col("created_at_local_time")
    x = x.withColumns({
        "new_b4_delivery": first & (F.col("first_delivery_ts").isNull() | later),
        "new_to_delivery": first & later,
        "last_of_user": F.coalesce(F.col("user_copy") == F.col("user_copies"), F.lit(True)),
    }).drop("first_delivery_ts", "user_copy", "user_copies")
    ledger = ledger_money(ledger_by_order(settlement, tickets, every, p, range_orders))
    if p.join_on_country:
        refunds = ledger.select("order_id", "liability_refund_expire").distinct()
        x = (x.join(ledger.drop("liability_refund_expire").withColumns({"copy": F.lit(1), "copies": F.lit(1)}),
                    ["order_id", "country"], "left").join(refunds, "order_id", "left"))
    else:
        x = x.join(ledger.drop("country"), "order_id", "left")
    # Amounts here, the rest after the items: each join's generated method stays
    # short enough for the JVM to compile (8000 bytes; interpreted beyond).
    tax_rate = safe_ratio("dw_tax", "dw_subtotal")
    x = x.withColumn("tax_rate", tax_rate)

    def amount(c):
        return F.coalesce(net_of_rate(c, "tax_rate"), F.lit(0.0))

    x = with_rounded(x, {
        "Amount": amount(F.col("liability_pay")),
        "Amount_USE": amount(F.col("liability_use")),
        "Amount_NO_SETTLED": amount(F.col("liability_no_settled")),
        "Amount_SETTLED": amount(F.col("liability_settled")),
        "Amount_REFUND": amount(F.col("liability_refund")),
        "Amount_REFUND_expire": amount(F.col("liability_refund_expire")),
        "Amount_REFUND_by_user": amount(F.col("liability_refund") - F.col("liability_refund_expire")),
    })
    x = with_rounded(x, {"Amount_left": (F.col("Amount") + F.col("Amount_NO_SETTLED") + F.col("Amount_SETTLED")
                                         + F.col("Amount_REFUND") + F.col("Amount_USE"))})
    x = x.join(per_order, "order_id", "left")
    # As specified, the sequence sees the copies of a fanned-out order: they
    # share their time and id, so each points at the next one (the order's own
    # day, also as the next non-drink day), and the last at the next order.
    last = F.coalesce(F.col("copy") == F.col("copies"), F.lit(True)) & F.col("last_of_user")
    own = F.col("created_at_local")
    x = x.withColumns({
        "next_order_date": F.when(last, F.col("next_order_date")).otherwise(own),
        "next_non_drink": F.when(last | F.col("is_drink"), F.col("next_non_drink"))
                           .otherwise(F.coalesce(own, F.col("next_non_drink")))})
    x = x.withColumns({
        "user_type": F.when(F.col("order_rank") == 1, F.lit("New")).otherwise(F.lit("Returning")),
        "next_order_date_diff": F.datediff("next_order_date", "created_at_local"),
        "Days_To_Next_Non_Drink": F.datediff("next_non_drink", "created_at_local"),
    })

    def share(c):
        return safe_ratio(c, "Amount") * F.col("item_quantity")

    x = with_rounded(x, {
        "item_Use": share("Amount_USE"),
        "item_No_settled": share("Amount_NO_SETTLED"),
        "item_Settled": share("Amount_SETTLED"),
        "item_refund": share("Amount_REFUND"),
        "item_refund_expire": share("Amount_REFUND_expire"),
        "item_refund_by_user": share("Amount_REFUND_by_user"),
    })
    x = x.withColumns({
        "has_amount_left": F.col("Amount_left") > 0,
        "revenue_card_fees": F.lit(0.0),
        "status_CHN": value_map("status", p.status_labels, p.status_other),
    })
    x = x.withColumn("item_left", F.col("item_quantity") - (
        F.col("item_Use") + F.col("item_No_settled") + F.col("item_Settled") + F.col("item_refund")))
    return x.select(*CONTRACT)


def ledger_money(ledger: DataFrame) -> DataFrame:
    """``ledger_by_order`` with the mart's revenue columns, and its sums as doubles.

    The refund sums stay decimals, since their difference is taken."""
    base, calculated = to_money("revenue_base_total"), F.col("revenue_commission_calculated")
    subsidy, order_subsidy = F.col("revenue_subsidy_ticket_calculated"), to_money("revenue_subsidy_order_calculated")
    return ledger.select(
        "order_id", "country", "copy", "copies", "pay_count", "liability_refund", "liability_refund_expire",
        *[to_money(c).alias(c) for c in ("liability_pay", "liability_use", "liability_no_settled", "liability_settled")],
        (base + F.lit(0.0)).alias("revenue"), base.alias("revenue_for_commission"),
        calculated.alias("revenue_commission"), (subsidy + order_subsidy).alias("revenue_subsidy"),
        (base - calculated - subsidy - order_subsidy).alias("revenue_others"))


def with_rounded(df: DataFrame, columns: dict) -> DataFrame:
    """``columns`` (doubles), rounded to cents."""
    return df.withColumns(columns).withColumns({c: round_double(c) for c in columns})


def filter_days(df: DataFrame, date_col: str, days) -> DataFrame:
    s, e = days.start_date, days.end_date
    if s is not None:
        df = df.where(F.col(date_col) >= F.lit(s))
    if e is not None:
        df = df.where(F.col(date_col) <= F.lit(e))
    return df
