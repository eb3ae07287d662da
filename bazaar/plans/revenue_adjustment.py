"""Revenue adjustments: scene exclusion list, area validation, latest
version per (id, country), typed cast layer and the unit-economics split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import REVENUE_CAST_LAYER, apply_cast_layer
from ..functions.columns import composite_id
from ..operators.join import active_values, lookup, not_in_list, unique_dimension
from ..operators.scan import quoted
from ..operators.window import latest_per_key
from ..params import AdjustmentParams

# The output columns, in order.
CONTRACT = ["id", "country", "created_at_local", "pr", "updated_at", "w_id", "r_id", "DR_id",
            "desc_info", "UE", "B_adjustment", "D_adjusment", "C_adjustment",
            "advertising_income", "IsMember"]


def validated_area(revenues: DataFrame, deliverers: DataFrame, areas: DataFrame,
                   p: AdjustmentParams) -> DataFrame:
    """Attach the deliverer's area and whether that area exists in the
    revenue's market (``is_area_validated``).  Every row stays one row: the
    lookup tables are made unique inside the plan, and rows without a
    deliverer, area or market are spread over the tasks instead of meeting
    under their NULL key."""
    d = unique_dimension(
        deliverers.select(F.col("id").cast("string").alias("d_id_key"), F.col("country").alias("d_country"),
                          F.col("m_area_id").alias("deliverer_m_area_id"), F.col(p.area_key).alias("d_area_key")),
        ["d_id_key", "d_country"], p.on_repeated_key)
    a = unique_dimension(
        areas.select(F.col("id").alias("a_id"), F.col("country").alias("a_country"),
                     F.col("wechat_id").alias("a_wechat_id")),
        ["a_id", "a_country", "a_wechat_id"], p.on_repeated_key)
    x = lookup(revenues, d, [(F.col("deliverer_id").cast("string"), "d_id_key"), ("country", "d_country")], spread_by="id")
    x = lookup(x, a, [("d_area_key", "a_id"), ("country", "a_country"),
                      (F.col("wechat_id").try_cast("bigint"), "a_wechat_id")],
               matched_flag="__area_hit", spread_by="id")
    return (x.withColumn("is_area_validated",
                         F.col("deliverer_m_area_id").isNotNull() & F.col("__area_hit"))
            .drop("__area_hit", "d_area_key"))


def version_order(revenues: DataFrame, tie_break: Sequence[str | F.Column] | None) -> list[F.Column]:
    """Order of versions that share a ``created_at``: ``tie_break``
    (descending), by default every column that can be sorted, so that the kept
    version does not depend on the plan."""
    if tie_break is not None:
        return [(F.col(c) if isinstance(c, str) else c).desc() for c in tie_break]
    sortable = [f.name for f in revenues.schema.fields if "map<" not in f.dataType.simpleString()]
    return [F.col(quoted(c)).desc() for c in sorted(sortable)]


def final_revenues(revenues: DataFrame, deliverers: DataFrame, areas: DataFrame, config: DataFrame,
                   p: AdjustmentParams = AdjustmentParams(),
                   tie_break: Sequence[str | F.Column] | None = None) -> DataFrame:
    """Newest version per (id, country) of the revenues outside the excluded
    scenes, typed by the cast layer, with the composite ids ``d_id``, ``r_id``,
    ``o_id``, ``w_id`` and ``DR_id``.

    The dedupe runs before the two lookups: they keep one row one row, so the
    same version wins and only kept rows are looked up.
    """
    r = revenues
    if p.start_month is not None:
        r = r.where(F.col("month").try_cast("int") >= F.lit(int(p.start_month)))
    r = not_in_list(r, "business_scene", active_values(config, p.scene_var), "value1")
    r = latest_per_key(r, ["id", "country"], [F.col("created_at").desc()], version_order(revenues, tie_break))
    r = validated_area(r, deliverers, areas, p)
    # Ids are built from the text as stored: leading zeros stay, and text that
    # is no number is still an id.
    return apply_cast_layer(r.withColumns({
        **{out: composite_id("country", of, null_safe=True) for out, of in (
            ("d_id", "deliverer_id"), ("r_id", "restaurant_id"), ("o_id", "order_id"), ("w_id", "wechat_id"))},
        "DR_id": F.when((F.col("restaurant_type") == F.lit("Restaurant"))
                        & F.col("restaurant_id").isNotNull(),
                        composite_id("country", "restaurant_id", null_safe=True))
                  .when(F.col("is_area_validated"),
                        composite_id("country", F.lit("A"), "deliverer_m_area_id", null_safe=True))
                  .otherwise(composite_id("country", F.lit("AW"), "wechat_id", null_safe=True)),
    }), REVENUE_CAST_LAYER).withColumn("source", F.lit(p.source_tag))


def revenue_adjustment(revenues: DataFrame, deliverers: DataFrame, areas: DataFrame,
                       config: DataFrame, p: AdjustmentParams = AdjustmentParams(),
                       tie_break: Sequence[str | F.Column] | None = None) -> DataFrame:
    """The unit-economics split of ``final_revenues`` (``tie_break``: see
    ``version_order``)."""
    t = final_revenues(revenues, deliverers, areas, config, p, tie_break)
    ue = (F.col("revenue") - F.col("fc") - F.col("td") - F.col("tr") - F.col("cd")
          - F.col("cr") - F.col("ra"))

    def nonzero(c):
        return c != 0 if p.nonzero_epsilon is None else F.abs(c) > F.lit(p.nonzero_epsilon)

    t = t.where((F.col("restaurant_status") >= 0) & (F.col("deliverer_status") >= 0)
                & ~F.lower(F.col("desc_info")).contains(p.excluded_desc_folded)
                & ~F.col("desc_info").contains(p.excluded_desc_raw)
                & (nonzero(ue) | nonzero(F.col("advertising_income")) | nonzero(F.col("pr"))))
    out = t.select(
        "id", "country", "created_at_local", "pr", "updated_at", "w_id", "r_id", "DR_id",
        "desc_info", ue.alias("UE"), (-F.col("fc") - F.col("ra")).alias("B_adjustment"),
        (-F.col("cd") - F.col("cr") - F.col("td") - F.col("tr")).alias("D_adjusment"),
        F.col("revenue").alias("C_adjustment"), "advertising_income",
        F.col("desc_info").isin(list(p.member_descriptions)).alias("IsMember"))
    return out if p.limit is None else out.orderBy("id", "country").limit(p.limit)
