import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bazaar.operators.aggregate import exposure_by, funnel, pivot_sum_by_type
from bazaar.operators.asof import last_touch
from bazaar.operators.join import active_mapping, lookup, not_in_list, unique_dimension
from bazaar.operators.scan import CHUNK, chunked
from bazaar.operators.window import latest_per_key, user_sequence

from .conftest import rows


# ------------------------------------------------------------------ sequence
def _seq_data(seed, n=400):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        u = rnd.choice([None, 1, 2, 3, 3, 3, 3, 3])          # user 3 is hot
        if rnd.random() < 0.05:
            ts = None
        else:
            ts = base + dt.timedelta(hours=rnd.randrange(0, 24 * 20, 7))  # many ties
        out.append((u, ts, i, ts.date() if ts else None, rnd.random() < 0.5))
    return out


def _seq_brute(data):
    res = {}
    by_user = {}
    for r in data:
        by_user.setdefault(r[0], []).append(r)
    for rs in by_user.values():
        rs.sort(key=lambda r: (r[1] is not None, r[1] or dt.datetime.min, r[2]))
        distinct, rank, prev = 0, {}, object()
        for r in rs:
            if r[1] != prev:
                distinct += 1
                prev = r[1]
            rank[r[2]] = distinct
        for i, r in enumerate(rs):
            nxt = rs[i + 1][3] if i + 1 < len(rs) else None
            later = [x[3] for x in rs[i + 1:] if x[4] and x[3] is not None]
            res[r[2]] = (rank[r[2]], nxt, min(later) if later else None)
    return res


@pytest.mark.parametrize("chunks", [None, 1, 3, 40])
def test_user_sequence_matches_brute_force(spark, chunks):
    data = _seq_data(7)
    df = spark.createDataFrame(data, "u bigint, ts timestamp_ntz, id bigint, d date, m boolean")
    out = user_sequence(df, "u", "ts", "id", "d", "rk", "nx", match=F.col("m"), match_out="nm",
                        chunks=chunks)
    got = {r["id"]: (r["rk"], r["nx"], r["nm"]) for r in out.collect()}
    assert got == _seq_brute(data)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_user_sequence_with_one_hot_user_and_day(spark, tmp_path):
    """A third of all rows has no user and one day, some of it one instant:
    chunks stay even, the input is scanned once, results are those of brute force."""
    rnd = random.Random(3)
    day = dt.datetime(2024, 5, 5)
    data = []
    for i in range(3000):
        if i % 3 == 0:
            u, ts = None, day + dt.timedelta(seconds=rnd.choice([0, 0, rnd.randrange(86_400)]))
        else:
            u, ts = rnd.randrange(400), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(24 * 300))
        data.append((u, ts, i, ts.date(), rnd.random() < 0.2))
    path = str(tmp_path / "seq")
    spark.createDataFrame(data, "u bigint, ts timestamp_ntz, id bigint, d date, m boolean").write.parquet(path)
    df = spark.read.parquet(path)
    sizes = [r["count"] for r in chunked(df, ["u", "ts", "id"], 12).groupBy(CHUNK).count().collect()]
    assert len(sizes) >= 11 and max(sizes) < 2 * sum(sizes) / len(sizes)
    out = user_sequence(df, "u", "ts", "id", "d", "rk", "nx", match=F.col("m"), match_out="nm", chunks=12)
    assert {r["id"]: (r["rk"], r["nx"], r["nm"]) for r in out.collect()} == _seq_brute(data)
    text = final_plan(out)
    assert text.count("FileScan") == 1 and text.count("ReusedExchange") == 1
    # windows run where the chunks are: rows cross the network for the cut only
    assert text.count("+- Exchange rangepartitioning") == 1 and text.count("+- Exchange shufflepartitionidpassthrough") == 1
    assert "hashpartitioning(u" not in text


def test_user_sequence_edges(spark):
    schema = "u bigint, ts timestamp_ntz, id bigint, d date, m boolean"
    assert user_sequence(spark.createDataFrame([], schema), "u", "ts", "id", "d").count() == 0
    one = [(1, None, 1, None, True), (1, None, 2, None, None), (None, None, None, None, None)]
    out = user_sequence(spark.createDataFrame(one, schema), "u", "ts", "id", "d", "rk", "nx", match=F.col("m"),
                        match_out="nm", chunks=3)
    assert sorted((r.id or 0, r.rk, r.nx, r.nm) for r in out.collect()) == [(0, 1, None, None), (1, 1, None, None), (2, 1, None, None)]
    # one instant of one user over many chunks is one rank
    t = dt.datetime(2024, 1, 1)
    tied = spark.createDataFrame([(7, t, i, t.date(), i == 150) for i in range(200)] +
                                 [(7, t + dt.timedelta(1), 500, t.date() + dt.timedelta(1), False)], schema)
    got = {r.id: (r.rk, r.nx, r.nm) for r in user_sequence(tied, "u", "ts", "id", "d", "rk", "nx", F.col("m"), "nm", 16).collect()}
    assert {got[i][0] for i in range(200)} == {1} and got[500] == (2, None, None)
    assert got[199][1] == t.date() + dt.timedelta(1) and got[198][1] == t.date()
    assert {got[i][2] for i in range(150)} == {t.date()} and {got[i][2] for i in range(150, 200)} == {None}


# ------------------------------------------------------------------ as-of
def _touch_brute(data, tol):
    res = {}
    for r in data:
        if not r[3]:
            continue
        cands = [s for s in data if not s[3] and s[0] == r[0] and s[1] <= r[1]]
        if not cands:
            res[r[2]] = None
            continue
        best = max(cands, key=lambda s: (s[1], s[4] is not None, s[4] or "", s[5] is not None,
                                         s[5] or ""))
        res[r[2]] = (best[4], best[5]) if (tol is None or r[1] - best[1] <= tol) else None
    return res


@pytest.mark.parametrize("tol,chunks", [(3_600_000, None), (50, None), (None, None), (3_600_000, 1),
                                        (5_000, 60), (None, 60)])
def test_last_touch_matches_brute_force(spark, tol, chunks):
    rnd = random.Random(11)
    data = []
    for i in range(500):
        u = rnd.choice(["a", "b", "c", "c", "c", None])
        ms = rnd.randrange(0, 10_000_000, 997)
        tgt = rnd.random() < 0.3
        data.append((u, ms, i, tgt, None if tgt else rnd.choice(["S1", "S2"]),
                     None if tgt else rnd.choice([None, "L1", "L2"])))
    df = spark.createDataFrame(data, "u string, ms bigint, id int, tgt boolean, src string, lst string")
    out = last_touch(df, "u", F.col("ms"), F.col("tgt"), ~F.col("tgt"), ["src", "lst"], tol,
                     tie_break=[F.col("src"), F.col("lst")], chunks=chunks)
    got = {r["id"]: (None if r["touch"] is None else (r["touch"]["src"], r["touch"]["lst"]))
           for r in out.collect()}
    assert got == _touch_brute(data, tol)


def test_last_touch_tolerance_edges(spark):
    tol = 3_600_000
    data = [  # user, ms, id, is_target, source
        ("u1", 0, 1, False, "S"), ("u1", tol, 2, True, None),             # exactly tol: found
        ("u2", 0, 3, False, "S"), ("u2", tol + 1, 4, True, None),         # tol + 1: not found
        ("u3", 500, 5, True, None), ("u3", 500, 6, False, "S"),           # same ms: found
        ("u4", 100, 7, True, None), ("u4", 200, 8, False, "S"),           # source after: none
        ("u5", 100, 9, True, None),                                       # no source
    ]
    df = spark.createDataFrame(data, "u string, ms bigint, id int, t boolean, src string")
    out = last_touch(df, "u", F.col("ms"), F.col("t"), ~F.col("t"), ["src"], tol)
    got = {r["id"]: r["touch"]["src"] if r["touch"] else None for r in out.collect()}
    assert got == {2: "S", 4: None, 5: "S", 7: None, 9: None}


def test_last_touch_of_a_hot_null_visitor(spark):
    """A third of all events has no visitor, most of them within one tolerance."""
    rnd = random.Random(21)
    data = []
    for i in range(900):
        u = None if i % 3 == 0 else f"u{rnd.randrange(80)}"
        ms = rnd.randrange(0, 4_000) if u is None else rnd.randrange(0, 40_000_000, 997)
        tgt = rnd.random() < 0.3
        data.append((u, ms, i, tgt, None if tgt else rnd.choice(["S1", "S2"]), None if tgt else rnd.choice([None, "L1"])))
    df = spark.createDataFrame(data, "u string, ms bigint, id int, tgt boolean, src string, lst string")
    out = last_touch(df, "u", F.col("ms"), F.col("tgt"), ~F.col("tgt"), ["src", "lst"], 3_600_000,
                     tie_break=[F.col("src"), F.col("lst")], chunks=16)
    got = {r["id"]: (None if r["touch"] is None else (r["touch"]["src"], r["touch"]["lst"])) for r in out.collect()}
    assert got == _touch_brute(data, 3_600_000)
    text = final_plan(out)
    assert "Generate" not in text and text.count("Scan") == 1 and "ReusedExchange" in text
    sizes = [r["count"] for r in chunked(df, ["u", "ms", "id"], 9).groupBy(CHUNK).count().collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


# ------------------------------------------------------------------ funnel
LITERAL_FUNNEL = """
WITH fe AS (SELECT g, u, CASE e WHEN 'a' THEN 1 WHEN 'b' THEN 2 WHEN 'c' THEN 3 END AS lvl
            FROM ev WHERE e IN ('a', 'b', 'c')),
um AS (SELECT g, u, MAX(lvl) AS ml FROM fe GROUP BY g, u),
pv AS (SELECT g, COUNT(CASE WHEN lvl = 1 THEN 1 END) AS p1, COUNT(CASE WHEN lvl = 2 THEN 1 END) AS p2,
              COUNT(CASE WHEN lvl = 3 THEN 1 END) AS p3 FROM fe GROUP BY g),
uv AS (SELECT g, COUNT(DISTINCT CASE WHEN ml >= 1 THEN u END) AS u1,
              COUNT(DISTINCT CASE WHEN ml >= 2 THEN u END) AS u2,
              COUNT(DISTINCT CASE WHEN ml >= 3 THEN u END) AS u3 FROM um GROUP BY g),
tot AS (SELECT g, COUNT(*) AS n, COUNT(DISTINCT u) AS nu FROM ev GROUP BY g)
SELECT t.g, t.n, t.nu, COALESCE(pv.p1, 0) p1, COALESCE(pv.p2, 0) p2, COALESCE(pv.p3, 0) p3,
       COALESCE(uv.u1, 0) u1, COALESCE(uv.u2, 0) u2, COALESCE(uv.u3, 0) u3
FROM tot t LEFT JOIN pv ON t.g = pv.g LEFT JOIN uv ON t.g = uv.g
"""


def test_funnel_one_pass_equals_literal(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["g1", "g2", "g3", None]), rnd.choice(["x", "y", "z", None]),
             rnd.choice(["a", "b", "c", "other"])) for _ in range(2000)]
    df = spark.createDataFrame(data, "g string, u string, e string")
    df.createOrReplaceTempView("ev")
    lvl = F.when(F.col("e") == "a", 1).when(F.col("e") == "b", 2).when(F.col("e") == "c", 3)
    out = funnel(df, ["g"], "u", lvl, ["p1", "p2", "p3"], ["u1", "u2", "u3"],
                 times="n", users="nu")
    lit = spark.sql(LITERAL_FUNNEL)
    cols = ("g", "n", "nu", "p1", "p2", "p3", "u1", "u2", "u3")
    # The join form never matches a NULL group key (its funnel stays 0); the
    # one-pass form counts that group too, so the mart drops NULL groups.
    keyed = F.col("g").isNotNull()
    assert rows(out.where(keyed), *cols) == rows(lit.where(keyed), *cols)
    assert rows(out.where(~keyed), "n", "nu") == rows(lit.where(~keyed), "n", "nu")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_exposure_by_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, "u1"), (None, "u1"), ("k", None), ("k", "u2")],
                               "k string, u string")
    assert rows(exposure_by(df, ["k"], "u")) == sorted([(None, 2, 1), ("k", 2, 1)], key=repr)


def test_pivot_sum_by_type(spark):
    df = spark.createDataFrame([(1, "PAY", 5), (1, "USE", 2), (1, "PAY", 1), (2, "X", 9)],
                               "k int, t string, a bigint")
    out = pivot_sum_by_type(df, ["k"], "t", {"pay": "PAY", "use": "USE"}, F.col("a"),
                            counts={"n_pay": "PAY"})
    assert rows(out, "k", "pay", "use", "n_pay") == [(1, 6, 2, 2), (2, 0, 0, 0)]


# ------------------------------------------------------------------ dedupe
def test_latest_per_key_with_tie_break_and_group_limit(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("a", "GB", t, 1), ("a", "GB", t, 2), ("a", "AU", t, 3), ("b", "GB", t, 4),
         ("b", "GB", t + dt.timedelta(1), 5)], "id string, c string, ts timestamp_ntz, v int")
    out = latest_per_key(df, ["id", "c"], [F.col("ts").desc()], [F.col("v").desc()])
    assert rows(out, "id", "c", "v") == [("a", "AU", 3), ("a", "GB", 2), ("b", "GB", 5)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ NOT IN / mapping / lookup
def test_not_in_list_null_rules(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "s string")
    lst = spark.createDataFrame([("A",)], "v string")
    assert rows(not_in_list(df, "s", lst, "v")) == [("B",)]
    with_null = spark.createDataFrame([("A",), (None,)], "v string")
    assert rows(not_in_list(df, "s", with_null, "v")) == []
    empty = spark.createDataFrame([], "v string")
    assert rows(not_in_list(df, "s", empty, "v")) == sorted([("A",), ("B",), (None,)], key=repr)


def test_active_mapping_filters_and_validates(spark):
    cfg = spark.createDataFrame([("m", "e1", "S1", "TRUE"), ("m", "e2", "S2", "FALSE"),
                                 ("x", "e3", "S3", "TRUE")],
                                "variable_name string, value1 string, value2 string, value3 string")
    assert rows(active_mapping(cfg, "m")) == [("e1", "S1")]
    dup = cfg.union(spark.createDataFrame([("m", "e1", "S9", "TRUE")], cfg.schema))
    twice = active_mapping(dup, "m")            # building the plan runs nothing
    with pytest.raises(Exception, match="maps more than once: e1"):
        twice.collect()
    assert active_mapping(dup, "m", validate=False).count() == 2


def test_lookup_flag_and_bounded_broadcast(spark):
    df = spark.createDataFrame([(1,), (2,)], "k bigint")
    dim = spark.createDataFrame([("1", "one")], "dk string, name string")
    out = lookup(df, dim.select(F.col("dk").try_cast("bigint").alias("dk"), "name"),
                 [("k", "dk")], matched_flag="hit")
    assert rows(out, "k", "name", "hit") == [(1, "one", True), (2, None, False)]
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_lookup_spreads_rows_without_a_key(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(i, None if i % 2 else i % 10, "c") for i in range(400)], "id int, k bigint, c string")
        dim = spark.createDataFrame([(4, "c", "four"), (None, "c", "none")], "dk bigint, dc string, name string")
        out = lookup(df, dim, [("k", "dk"), ("c", "dc")], matched_flag="hit", spread_by="id")
        assert out.columns == ["id", "k", "c", "name", "hit"]
        assert {(r.k, r.name, r.hit) for r in out.collect()} == {
            (None, None, False), (0, None, False), (2, None, False), (4, "four", True), (6, None, False), (8, None, False)}
        assert out.count() == 400
        # the rows without a key do not meet in one task
        tasks = out.groupBy(F.spark_partition_id(), F.isnull("k")).count().where("`(k IS NULL)`").collect()
        assert len(tasks) > 1 and max(r["count"] for r in tasks) < 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unique_dimension_inside_the_plan(spark):
    dim = spark.createDataFrame([(1, "a", 5, None), (1, "a", 7, "x"), (2, "a", None, "y"), (None, "a", 1, "z")],
                                "id bigint, c string, v int, w string")
    one = unique_dimension(dim, ["id", "c"])
    assert one.columns == dim.columns
    assert rows(one) == sorted([(1, "a", 7, "x"), (2, "a", None, "y")], key=repr)
    assert rows(unique_dimension(dim.where("v IS NULL OR v <> 5"), ["id", "c"], "error")) == rows(one)
    repeated = unique_dimension(dim, ["id", "c"], "error")
    with pytest.raises(Exception, match='found more than once.*"id":1'):
        repeated.collect()
    assert rows(unique_dimension(dim.select("id", "c"), ["id", "c"])) == [(1, "a"), (2, "a")]


def test_day_bounds_keep_both_day_forms(spark):
    from bazaar.functions.columns import day_between
    days = [f"202511{d:02d}" for d in range(25, 30)] + [f"2025-11-{d:02d}" for d in range(25, 30)] + [None, "2025"]
    df = spark.createDataFrame([(d,) for d in days], "dt string")

    def kept(start=None, end=None):
        return sorted(r.dt for r in df.where(day_between("dt", start, end)).collect())
    assert kept("20251127") == sorted(d for d in days if d and len(d) > 4 and d[-2:] >= "27")
    assert kept("2025-11-27", "20251128") == ["2025-11-27", "2025-11-28", "20251127", "20251128"]
    assert kept(end="20251126") == ["2025", "2025-11-25", "2025-11-26", "20251125", "20251126"]


def test_config_table_rerun_replaces_rows(spark, tmp_path):
    from bazaar.sources.config import create_config_table
    for _ in range(2):
        out = create_config_table(spark, "cfg_rerun", location=str(tmp_path / "cfg"))
    assert out.count() == 14


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_not_in_list_with_and_without_broadcast(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
        lists = {"x": ([("a",)], ["b"]), "null": ([("a",), (None,)], []), "empty": ([], ["a", "b", None])}
        for rows, want in lists.values():
            got = [r.k for r in not_in_list(df, "k", spark.createDataFrame(rows, "v string"), "v").collect()]
            assert sorted(got, key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
