import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from bazaar.functions import columns as C
from bazaar.functions.casts import apply_cast_layer


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("v")).collect()]


def test_scale_cents_exact(spark):
    v = one(spark, C.scale_cents("c"), [(12345,), (-5,), (None,)], "c bigint")
    assert v == [Decimal("123.45"), Decimal("-0.05"), None]


def test_safe_ratio_and_net_of_rate(spark):
    data = [(1.0, 0.0), (1.0, None), (3.0, 4.0)]
    assert one(spark, C.safe_ratio("n", "d"), data, "n double, d double") == [0.0, 0.0, 0.75]
    # 1 + rate == 0 gives NULL, never an error under ANSI
    assert one(spark, C.net_of_rate("n", "d"), [(5.0, -1.0), (6.0, 0.5)],
               "n double, d double") == [None, 4.0]


def test_round_half_up_on_decimal_text(spark):
    assert one(spark, C.round_half_up("x"), [(1.005,), (2.675,), (-1.005,)], "x double") == \
        [1.01, 2.68, -1.01]


def test_composite_id_null_rules(spark):
    data = [("GB", None), ("GB", 7), (None, None)]
    assert one(spark, C.composite_id("a", "b"), data, "a string, b bigint") == [None, "GB7", None]
    assert one(spark, C.composite_id("a", "b", null_safe=True), data, "a string, b bigint") == \
        ["GB", "GB7", ""]


def test_json_decimal_is_exact_and_tolerates_bad_input(spark):
    docs = [('{"k": 12}',), ('{"k": "x"}',), ('{"j": 1}',), ("not json",), ("",), (None,), ('{"k": "0.0000001234567"}',),
            ('{"k": "1e-7"}',), ('{"k": "NaN"}',), ('{"k": 12345678901234567}',), ('{"k": " 5 "}',), ('{"k": ""}',)]
    assert one(spark, C.json_decimal(C.json_fields("d"), "k"), docs, "d string") == [
        Decimal(12), None, None, None, None, None, Decimal("0.000000123457"), Decimal("1e-7"), None, None, Decimal(5), None]


DOCS = ['{"a":1,"a":2,"b":0}', '{"a":null,"a":2}', '{"a":2,"a":null}', '{"a":"x","b":"y"', '{"a":1', '{"a":1,"b":',
        '{"a":{"b":1,"c":[1,2]},"b":{}}', '{"a":[1,{"z":null}]}', '{"a":1.50,"b":1e3}', '{"a":true,"b":""}', '[{"a":1}]', '[1]',
        '"a"', "1", "", "  ", "null", None, "{'a':'q'}", "{a:1}", '{"a":"line\nbreak"}', '{"b":{"a":5}}', '{"a":1}{"a":2}',
        '{"a":1} x', 'x{"a":1}', '{"a" : " s ", "b" : "\u00e9"}', '{"a":NaN}', '{"a":01}', '{"A":1,"b":"B"}', '{"a":1,}',
        '{"":1,"a":3}', '{"a":"x","a":"y","a":null,"b":[],"b":1}', "{}"]


def test_json_fields_follow_get_json_object(spark):
    """Repeated keys, truncated text, nested values: as one path extraction per field, with one parse."""
    df = spark.createDataFrame([(d,) for d in DOCS], "d string")
    read = df.withColumn("j", C.json_fields("d"))
    got = read.select("d", C.json_field("j", "a").alias("a"), C.json_field("j", "b").alias("b"))
    want = df.select("d", F.get_json_object("d", "$.a").alias("a"), F.get_json_object("d", "$.b").alias("b"))
    assert got.collect() == want.collect()
    assert {r.a for r in got.where("d LIKE '%\"a\":1,\"a\":2%'").collect()} == {"1"}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_first_nonempty_json(spark):
    docs = [('{"listName": "L", "title": "T"}',), ('{"listName": "", "title": "T"}',),
            ('{"title": "T"}',), ('{"listName": ""}',), ('{}',)]
    assert one(spark, C.first_nonempty_json("d", "listName", "title"), docs, "d string") == \
        ["L", "T", "T", None, None]


def test_parse_day_both_formats(spark):
    data = [("20251126",), ("2025-11-26",), ("2025-13-40",), ("bad",), (None,)]
    assert one(spark, C.parse_day("d"), data, "d string") == \
        [dt.date(2025, 11, 26), dt.date(2025, 11, 26), None, None, None]


def test_epoch_millis_is_zone_free(spark):
    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert df.select(C.epoch_millis("t")).first()[0] == 1704067207179
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_value_map_default(spark):
    m = {1: "a", 9: "b"}
    assert one(spark, C.value_map("s", m, "other"), [(1,), (9,), (5,), (None,)], "s int") == \
        ["a", "b", "other", "other"]


def test_cast_layer_try_cast_and_passthrough(spark):
    df = spark.createDataFrame([("12", "x", "1.5", "keep")], "a string, b string, c string, d string")
    out = apply_cast_layer(df, {"bigint": ["a", "b"], "decimal(34,6)": ["c"], "int": ["missing"]})
    r = out.first()
    assert out.columns == ["a", "b", "c", "d"]
    assert (r["a"], r["b"], r["c"], r["d"]) == (12, None, Decimal("1.500000"), "keep")


def test_json_pick_equals_the_whole_parse(spark):
    docs = [None, "", "null", "not json", "{}", '{"k":1}', ' {"k":1}', '{"k":1,"k":2}', '{"k":null,"k":3}', '{"k":6,"\\u006b":5}',
            '[{"k":1}]', '{"k":{"k":1}}', '{"a":{"k":1}}', '{"k":[1,{"x":2}],"s":true}', '{"k":1} tail', '{"k":1,"s":',
            '{"s":"k","k":7}', '{k:1}', '{"k":NaN}', '{"k":1e5,"s":-0.10}', '{"K":1}', '{"k":"\u00e9","s":""}']
    df = spark.createDataFrame([(d,) for d in docs], "d string").withColumn("m", C.json_fields("d"))
    got = df.select(C.json_field("m", "k"), C.json_field("m", "s"), C.json_pick("d", "k", "s").alias("z")).select("*", "z.k", "z.s")
    assert [tuple(r[:2]) for r in got.collect()] == [tuple(r[3:]) for r in got.collect()]
    parsed = df.select(C.json_pick("d", "k", "s").alias("z"))._jdf.queryExecution().optimizedPlan().toString()
    assert "StructField(k,StringType" in parsed  # plain objects are read for these fields alone


def test_round_double_equals_round_half_up(spark):
    xs = [None, float("nan"), float("inf"), 0.0, -0.0, -0.001, 1.005, 2.675, -1.005, 0.005, 0.0049999999999999, 1e10 + 0.005,
          123456789012.345, 1e300] + [s * k / 1000 for k in range(0, 4000, 5) for s in (1, -1)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert df.select(C.round_double("x").alias("a"), C.round_half_up("x").alias("b")).where(
        "NOT (a <=> b) OR string(a) != string(b)").collect() == []


def test_sum_cents_is_exact_at_the_ends_of_bigint(spark):
    big, low = 2**63 - 1, -2**63
    df = spark.createDataFrame([(1, big), (1, big), (1, -5), (2, low), (2, low), (3, None), (4, -1), (4, None), (4, 101)], "g int, c bigint")
    got = df.groupBy("g").agg(C.sum_cents("c").alias("a"), F.sum(C.scale_cents("c")).alias("b"))
    assert got.schema["a"].dataType == got.schema["b"].dataType
    assert got.where("NOT (a <=> b)").count() == 0 and got.where("g = 1").first()["a"] == Decimal(2 * big - 5) / 100
