"""Hard negatives: bounds that hold, and results against brute force and the SQL."""

import os
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bazaar.llm import bit_codes
from bazaar.llm import hard_negatives as hard

SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, positives=5, negatives=10):
    """Results over (vec_id, vector or None, label) by scoring everything."""
    live = []
    for i, v, label in rows:
        if label is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        live.append((i, [int(np.floor(256.0 * float(x))) for x in v], label))
    out = Counter()
    late = float("inf")
    for a, (i, v, label) in enumerate(live):
        if i is None or i % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), late if j is None else j, m == label)
                         for b, (j, w, m) in enumerate(live) if b != a and len(w) == len(v)), key=lambda r: r[:2])
        for s, p, _ in [r for r in scored if r[2]][:positives]:
            fits = [r for r in scored if not r[2] and 30 * -s <= 100 * -r[0] <= 90 * -s][:negatives]
            for rank, (t, n, _) in enumerate(fits, 1):
                out[i, None if p == late else p, rank, None if n == late else n, -s, -t] += 1
    return out


def found(df):
    assert df.columns == COLUMNS
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("dim", [1, 3, 64, 100])
def test_intervals_hold_and_narrow(dim):
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(6, dim)) * 60
    x = np.floor(centres[rng.integers(0, 6, 500)] + rng.normal(size=(500, dim)) * 25)
    x[:3] = [[0.0] * dim, [1e8] * dim, [-5.0] * dim]
    q = np.vstack([x[:40], np.zeros((1, dim))])
    exact = q @ x.T
    widths = []
    for levels in (1, 2, 4):
        lower, upper = bit_codes.Codes.of(x, levels).bounds(q)
        assert (lower <= exact).all() and (exact <= upper).all()
        widths.append(np.median(upper - lower))
    assert widths[0] > widths[1] > widths[2] or dim == 1
    if dim == 64:  # one code alone already tells far from near
        lower, upper = bit_codes.Codes.of(x[3:], 4).bounds(q[3:4])
        kth = np.sort(exact[3, 3:])[-5]
        assert (upper[0] >= kth).mean() < 0.5


def test_popcounts_count_common_bits():
    rng = np.random.default_rng(1)
    for dim in (1, 63, 64, 65, 130):
        a, b = rng.random((7, dim)) < 0.5, rng.random((9, dim)) < 0.5
        assert (bit_codes.ones(bit_codes.packed(a), bit_codes.packed(b)) == a.astype(int) @ b.astype(int).T).all()


def tricky():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8)) * 0.4
    rows = [(int(i), [float(x) for x in centres[i % 12] + rng.normal(size=8) * 0.1], int(rng.integers(0, 3))) for i in range(420)]
    rows += [(100, rows[3][1], 0), (100, rows[3][1], 0), (200, rows[4][1], 1), (5, rows[5][1], 2), (5, rows[6][1], 2)]
    rows += [(None, rows[7][1], 0), (None, rows[7][1], 1), (None, rows[8][1], 2), (500, None, 1), (600, rows[9][1], None),
             (700, [], 1), (800, [0.1] * 7 + [None], 1), (900, [0.1] * 7 + [float("nan")], 1), (1000, [0.1] * 7 + [float("inf")], 1),
             (1100, [0.5, 0.5], 1), (1101, [0.5, 0.4], 1), (1102, [0.5, 0.2], 2), (1200, [0.0] * 8, 0), (1300, [-0.4] * 8, 0),
             (1400, [0.3], 9)]
    return rows + [(2000 + i, rows[2][1], 7) for i in range(150)]  # a third: one vector, one label


@pytest.mark.parametrize("shard", [7, 64, 4096])
def test_mining_matches_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(hard, "BLOCK_BYTES", 256 if shard == 64 else 8 << 20)
    rows = tricky()
    df = (spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
          .withColumn("row", F.lit(1)).withColumn("dim", F.lit("d")).withColumn("vec", F.lit(0)).repartition(4))
    ready = hard.usable(df, "vec_id", "label", "embedding")
    moved = hard.C.keep(ready.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
                                         .otherwise(F.col("label"))), "vectors")
    assert found(hard.mine(moved, moved.filter("vec_id % 100 = 0"), shard=shard)) == brute(rows)


def test_mining_on_empty_tables(spark):
    none = hard.C.keep(hard.usable(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"),
                                   "vec_id", "label", "embedding"), "vectors")
    assert hard.mine(none, none).count() == 0


def test_sql_matches_brute_force():
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[], label INT)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", tricky())
    assert Counter(con.execute(hard.ORACLE).fetchall()) == brute(tricky())


def test_huge_components_stay_in_64_bits():
    x = hard.integers(np.array([[1e300, -1e300, 3.0, 0.0]]))
    assert (x == [[2**30, -(2**30), 768, 0]]).all()
    table = pa.table({"vec_id": [1, 2], "row": [0, 1], "label": [0, 0], "vec": [[1e300, 1.0], [1.0, 2.0]]})
    s = hard.Shard(hard._shard(table).to_batches()[0], 0)
    assert s.score(np.array([2**30, 1]), np.array([0, 1])).tolist() == [int(s.x[0, 0]) * 2**30 + 256, 256 * 2**30 + 512]


@here
def test_op11_on_embeddings(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert found(hard.op11_bit_negatives(spark, SF)) == brute(rows)
