"""The switchable config table: schema, seed rows, create/replace, preview."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CONFIG_SCHEMA = "variable_name string, value1 string, value2 string, value3 string"
CONFIG_COMMENTS = {
    "variable_name": "变量名称",
    "value1": "事件英文标识",
    "value2": "中文含义",
    "value3": "开关状态",
}

# The seed rows of the config table, in order.
SEED_ROWS = [
    ("dianping_event_mapping", "DPHomepageView", "老团购", "TRUE"),
    ("dianping_event_mapping", "DReviewHomePageView", "新点评", "TRUE"),
    ("dianping_event_mapping", "RestDetailsView", "外卖餐厅", "TRUE"),
    ("dianping_event_mapping", "OrderListPageView", "历史订单", "TRUE"),
    ("dianping_event_mapping", "V2SearchTabView", "搜索", "TRUE"),
    ("dianping_event_mapping", "V2SearchView", "搜索", "TRUE"),
    ("dianping_event_mapping", "V2HomeGoodsCompoClick", "外卖首页滑动组件", "TRUE"),
    ("dianping_event_mapping", "DReviewHomePageListClick", "点评首页榜单", "TRUE"),
    ("dianping_event_mapping", "DReviewHomePageBannerClick", "点评首页Banner", "TRUE"),
    ("dianping_event_mapping", "DReviewHomePageIconClick", "点评首页Icon", "TRUE"),
    ("business_scene_order", "DONE_ORDER", "完成订单", "TRUE"),
    ("business_scene_order", "PURCHASING_AGENT_DELIVERY_PAY", "送餐员代买", "TRUE"),
    ("business_scene_order", "PURCHASING_AGENT_PLATFORM_PAY", "平台代买", "TRUE"),
    ("business_scene_order", "SELF_RUN", "自营", "TRUE"),
]


def config_frame(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(SEED_ROWS if rows is None else rows, CONFIG_SCHEMA)


def create_config_table(spark: SparkSession, table: str, rows=None, location: str | None = None,
                        fmt: str = "orc") -> DataFrame:
    """DROP + CREATE (ORC, with column and table comments) + INSERT OVERWRITE of the rows
    (dropping a table with a location leaves its files: a rerun replaces them).

    ``location`` puts the table files in a shared folder (cluster setups);
    without it the session's warehouse is used.
    """
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    cols = ", ".join(f"{c} STRING COMMENT '{CONFIG_COMMENTS[c]}'" for c in CONFIG_COMMENTS)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {table} ({cols}) USING {fmt} "
              f"COMMENT 'switchable mappings and lists'{loc}")
    config_frame(spark, rows).write.insertInto(table, overwrite=True)
    return spark.table(table)


def preview(df: DataFrame, n: int = 10, order_by=None) -> DataFrame:
    """First ``n`` rows; pass ``order_by`` for a stable answer."""
    if order_by is not None:
        df = df.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    return df.limit(n)
