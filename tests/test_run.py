import os
import tempfile

from bazaar.run import main

from .test_marts import EVENTS, _ev


def test_runner_writes_funnel_by_day(spark):
    root = tempfile.mkdtemp(prefix="bazaar-run-")
    ev_path = os.path.join(root, "events.parquet")
    spark.createDataFrame([_ev("20251126", "DPHomepageView", "u1"),
                           _ev("20251127", "DPHomepageView", "u2")], EVENTS) \
        .write.mode("overwrite").parquet(ev_path)
    out = os.path.join(root, "funnel")
    main(["event_funnel", "--input", f"events={ev_path}", "--domain", "app",
          "--start", "20251127", "--out", out], spark=spark)
    got = spark.read.parquet(out).collect()
    assert [(str(r["time_date"]), r["DPHomepage_UV"]) for r in got] == [("2025-11-27", 1)]


def test_runner_creates_config_table(spark):
    t = main(["config_table", "--table", "bazaar_run_config"], spark=spark)
    assert t.count() == 14


def test_runner_passes_config_variables_domain_and_ties(spark, tmp_path):
    from .test_marts import REVENUE, _rev
    spark.createDataFrame([("my_map", "Seen", "Own", "TRUE"), ("my_scenes", "OUT", "x", "TRUE")],
                          "variable_name string, value1 string, value2 string, value3 string") \
        .write.saveAsTable("bazaar_run_vars", path=str(tmp_path / "vars"))
    ev = str(tmp_path / "events.parquet")
    spark.createDataFrame([_ev("20251126", "Seen", "u1"), _ev("20251126", "Seen", "u2", domain="web")], EVENTS).write.parquet(ev)
    args = ["--input", f"events={ev}", "--input", "config=bazaar_run_vars", "--domain", "app", "--mapping-var", "my_map"]
    got = main(["source_exposure", *args], spark=spark).collect()
    assert [(r["source_name"], r["exposure_times"]) for r in got] == [("Own", 1)]
    assert main(["total_exposures", "--input", f"events={ev}", "--domain", "web"], spark=spark).first()["exposure_users"] == 1
    paths = {}
    for name, data, schema in (("revenues", [_rev("a", desc="first"), _rev("a", desc="second"),
                                             _rev("b", scene="OUT")], REVENUE),
                               ("deliverers", [], "id bigint, country string, m_area_id bigint"),
                               ("areas", [], "id bigint, country string, wechat_id bigint")):
        paths[name] = str(tmp_path / f"{name}.parquet")
        spark.createDataFrame(data, schema).write.parquet(paths[name])
    args = [x for n, p in paths.items() for x in ("--input", f"{n}={p}")] + ["--input", "config=bazaar_run_vars"]
    got = main(["revenue_adjustment", *args, "--scene-var", "my_scenes", "--tie-break", "desc_info"], spark=spark).collect()
    assert [(r["id"], r["desc_info"]) for r in got] == [("a", "second")]


def test_runner_single_day_removes_an_emptied_day(spark, tmp_path):
    out, ev = str(tmp_path / "funnel"), str(tmp_path / "events.parquet")
    args = ["event_funnel", "--input", f"events={ev}", "--domain", "app", "--day", "20251126", "--out", out]
    spark.createDataFrame([_ev("20251126", "DPHomepageView", "u1")], EVENTS).write.parquet(ev)
    main(args, spark=spark)
    assert os.path.exists(os.path.join(out, "time_date=2025-11-26"))
    spark.createDataFrame([_ev("20251126", "Other", "u1")], EVENTS).write.mode("overwrite").parquet(ev)
    main(args, spark=spark)
    assert not os.path.exists(os.path.join(out, "time_date=2025-11-26"))
