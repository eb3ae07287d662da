import os
import tempfile

from pyspark.sql import functions as F

from bazaar.params import AttributionParams, FunnelParams
from bazaar.plans.event_funnel import event_funnel
from bazaar.plans.order_source import order_source
from bazaar.sources.config import config_frame
from bazaar.sources.sink import write_by_day
from bazaar.streaming.daily import day_mart_stream

from .test_marts import EVENTS, _ev


def test_day_mart_stream_recomputes_touched_days(spark):
    root = tempfile.mkdtemp(prefix="bazaar-stream-")
    events, out, ckpt = (os.path.join(root, x) for x in ("events", "out", "ckpt"))
    p = FunnelParams(domain="app")
    mart = lambda ev: event_funnel(ev, p)

    day1 = spark.createDataFrame([_ev("20251126", "DPHomepageView", "u1"),
                                  _ev("20251126", "DPHomepageView", "u2")], EVENTS)
    day1.write.mode("append").partitionBy("dt").parquet(events)
    q = day_mart_stream(spark, events, mart, out, checkpoint=ckpt, name="t1")
    q.awaitTermination(120)
    r = spark.read.parquet(out).collect()
    assert [(x["DPHomepage_UV"], x["exposure_times"]) for x in r] == [(2, 2)]

    # a late file for the same day plus a new day: both days are recomputed
    more = spark.createDataFrame([_ev("20251126", "DPHomepageView", "u3"),
                                  _ev("20251127", "DPHomepageView", "u1")], EVENTS)
    more.write.mode("append").partitionBy("dt").parquet(events)
    q = day_mart_stream(spark, events, mart, out, checkpoint=ckpt, name="t2")
    q.awaitTermination(120)
    got = {str(x["time_date"]): x["DPHomepage_UV"] for x in spark.read.parquet(out).collect()}
    assert got == {"2025-11-26": 3, "2025-11-27": 1}


def test_day_without_rows_is_removed_and_others_stay(spark, tmp_path):
    out = str(tmp_path / "mart")
    rows = [("2025-11-26", 1), ("2025-11-26", 2), ("2025-11-27", 3), ("2025-11-28", 4)]
    df = spark.createDataFrame(rows, "day string, v int").withColumn("day", F.col("day").cast("date"))
    assert write_by_day(df, out, "day") == ["2025-11-26", "2025-11-27", "2025-11-28"]
    # the 26th and 27th are recomputed: the 27th has no rows any more; the 28th is not in the manifest
    again = df.where("v = 2")
    assert write_by_day(again, out, "day", days=["2025-11-26", "2025-11-27", "2025-12-24"]) == ["2025-11-26"]
    assert sorted((str(r.day), r.v) for r in spark.read.parquet(out).collect()) == [("2025-11-26", 2), ("2025-11-28", 4)]
    assert not os.path.exists(os.path.join(out, "day=2025-11-27"))
    # without a manifest nothing is removed; a run without any rows removes its days alone
    write_by_day(df.limit(0), out, "day")
    assert spark.read.parquet(out).count() == 2
    write_by_day(df.limit(0), out, "day", days=["2025-11-28"])
    assert [str(r.day) for r in spark.read.parquet(out).collect()] == ["2025-11-26"]


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    out = str(tmp_path / "mart")
    df = spark.range(4000).select(F.lit("20251126").alias("day"), "id", F.create_map(F.lit("k"), "id").alias("m")).coalesce(1)
    write_by_day(df, out, "day", tasks_per_day=8)
    files = [f for f in os.listdir(os.path.join(out, "day=20251126")) if f.startswith("part-")]
    assert 2 <= len(files) <= 8 and spark.read.parquet(out).count() == 4000
    write_by_day(df, out, "day", tasks_per_day=8)      # a rerun replaces the day
    assert spark.read.parquet(out).count() == 4000


def run_stream(spark, events, mart, out, ckpt, **more):
    day_mart_stream(spark, events, mart, out, checkpoint=ckpt, **more).awaitTermination(120)


def test_stream_reads_a_day_in_both_forms_and_drops_emptied_days(spark):
    root = tempfile.mkdtemp(prefix="bazaar-stream-")
    events, out, ckpt = (os.path.join(root, x) for x in ("events", "out", "ckpt"))
    mart = lambda ev: event_funnel(ev, FunnelParams(domain="app"))
    frame = lambda *r: spark.createDataFrame(list(r), EVENTS)
    frame(_ev("20251126", "DPHomepageView", "u1"), _ev("20251127", "DPHomepageView", "u1")).write.parquet(events)
    run_stream(spark, events, mart, out, ckpt, name="b1")
    frame(_ev("2025-11-26", "DPHomepageView", "u2"), _ev("bad", "DPHomepageView", "u9")).write.mode("append").parquet(events)
    run_stream(spark, events, mart, out, ckpt, name="b2")
    got = {str(x["time_date"]): x["DPHomepage_UV"] for x in spark.read.parquet(out).collect()}
    assert got == {"2025-11-26": 2, "2025-11-27": 1}
    # a mart that has no rows for a touched day any more
    picky = lambda ev: mart(ev).where("DPHomepage_UV > 3")
    frame(_ev("20251127", "DPHomepageView", "u7")).write.mode("append").parquet(events)
    run_stream(spark, events, picky, out, ckpt, name="b3")
    assert [str(x["time_date"]) for x in spark.read.parquet(out).collect()] == ["2025-11-26"]


def test_stream_with_lookback_recomputes_the_days_after(spark):
    root = tempfile.mkdtemp(prefix="bazaar-stream-")
    events, out, ckpt = (os.path.join(root, x) for x in ("events", "out", "ckpt"))
    cfg, midnight = config_frame(spark), 1_764_115_200_000      # 2025-11-26 00:00
    mart = lambda ev: order_source(ev, cfg, AttributionParams())
    spark.createDataFrame([_ev("20251126", "DPOrderCreated", "u1", midnight + 60_000, oid="LG1")], EVENTS).write.parquet(events)
    run_stream(spark, events, mart, out, ckpt, name="l1", out_day_col="dt", lookback_days=1)
    assert [r.Order_Source for r in spark.read.parquet(out).collect()] == ["Not Found"]
    # a late event of the day before changes the order after midnight
    late = [_ev("20251125", "DPHomepageView", "u1", midnight - 60_000)]
    spark.createDataFrame(late, EVENTS).write.mode("append").parquet(events)
    run_stream(spark, events, mart, out, ckpt, name="l2", out_day_col="dt", lookback_days=1)
    assert [r.Order_Source for r in spark.read.parquet(out).collect()] == ["老团购"]
