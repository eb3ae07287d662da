"""Hard-negative mining with rotated one-bit codes.

For every anchor the first ``positives`` other rows of its label are found,
then, for each of these, the first ``negatives`` rows of other labels whose
score lies within a share of the positive's score.  Scores are integer inner
products of the components floor(``SCALE`` x).

Rows lie in shards of about ``SHARD``; a shard is written once with its codes
(see ``bit_codes``).  A block of anchors meets every shard: the codes give
each score an interval, and only rows whose interval can still matter are
scored in integers.

* Positives: of the rows of the label, the best by the middle of the interval
  are scored; their k-th score is a bound, and rows whose interval ends below
  it are out.
* Negatives: rows whose interval misses the band are out; where k intervals
  lie within the band for certain, rows that end below the k-th of their lower
  ends are out.

Shards' first k are merged by a top-k, so results are exact.

Scale: a stated query set against all rows, in blocks.  Blocks of anchors
(``BLOCK_BYTES`` at most) are taken one after the other; each is broadcast to
the shards, so nothing is shuffled but the first k of each shard.  A label
that a third of all rows share is spread over all shards, as rows are dealt by
a hash of their row.

Cases: rows with a null label, a null vector or a null or non-finite
component take no part, nor do vectors without components; vectors meet those
of the same length only.  A row is any row but the anchor's own: rows of a
repeated vec_id are rows of their own, each an anchor of its own; a null
vec_id is no anchor, can be chosen, and comes after other ids of the same
score.  Ties of one id have the same columns.  Bands of a negative positive
score are empty.  Fewer rows than asked for: all.  Empty tables give empty
results; other columns do not matter.  Components so large that a score could
leave 64 bits count as the largest that cannot (2^28 for 64 components).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common as C
from .bit_codes import Codes

SCALE = 256.0
POSITIVES = 5
NEGATIVES = 10
BAND = (30, 90)  # percent of the positive's score
SHARD = 4096
BLOCK_BYTES = 8 << 20
STRIP = 64
NO_ID = np.iinfo(np.int64).max


def usable(df: DataFrame, id_column: str, label: str, column: str) -> DataFrame:
    """(row, vec_id, label, vec) of the rows that take part."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (df.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"),
                      F.col(f"`{column}`").cast("array<double>").alias("vec"))
            .filter(F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", fine))
            .withColumn("row", F.monotonically_increasing_id()))


def integers(x: np.ndarray) -> np.ndarray:
    """floor(``SCALE`` x), still as doubles, within the range that keeps scores in 64 bits."""
    most = float(int((2**62 // x.shape[1]) ** 0.5))
    return np.clip(np.floor(SCALE * x), -most, most)


def _shard(table: pa.Table) -> pa.Table:
    """A shard as one row: ascending ids (null last), labels, integer vectors, codes."""
    ids = np.asarray(table.column("vec_id").combine_chunks().fill_null(NO_ID), np.int64)
    row, label = (np.asarray(table.column(c), np.int64) for c in ("row", "label"))
    known = table.column("vec_id").combine_chunks().is_valid().to_numpy(zero_copy_only=False)
    order = np.lexsort((row, ids, ~known))
    x = integers(np.asarray(table.column("vec").combine_chunks().flatten(), np.float64).reshape(len(ids), -1)[order])
    codes = Codes.of(x)
    x = x.astype(np.int32 if np.abs(x).max() < 2**31 else np.int64)
    return pa.table({
        "dim": pa.array([x.shape[1]], pa.int32()), "n": pa.array([len(x)], pa.int32()), "ids": [ids[order].tobytes()],
        "known": [known[order].tobytes()], "rows": [row[order].tobytes()], "labels": [label[order].tobytes()],
        "vecs": [x.tobytes()], "centre": [codes.centre.tobytes()], "codes": [codes.codes.tobytes()],
        "align": [codes.align.tobytes()], "rest": [codes.rest.tobytes()]})


SHARDS = ("dim int, n int, ids binary, known binary, rows binary, labels binary, vecs binary, centre binary, codes binary, "
          "align binary, rest binary")


def shards(rows: DataFrame, each: int = SHARD) -> DataFrame:
    """The coded shards of ``rows`` (as written: row, vec_id, label, vec)."""
    many = max(1, -(-rows.count() // each))
    return C.keep(rows.withColumn("dim", F.size("vec")).groupBy("dim", F.pmod(F.xxhash64("row"), F.lit(many)).alias("shard"))
                  .applyInArrow(_shard, SHARDS), "coded")


class Shard:
    """A row of ``shards``, opened."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        def numbers(name, kind):
            return np.frombuffer(batch.column(name)[i].as_py(), kind)
        self.n, dim = batch.column("n")[i].as_py(), batch.column("dim")[i].as_py()
        self.ids, self.rows, self.labels = (numbers(c, np.int64) for c in ("ids", "rows", "labels"))
        self.known, vecs = numbers("known", bool), batch.column("vecs")[i].as_py()
        self.x = np.frombuffer(vecs, np.int32 if len(vecs) == 4 * self.n * dim else np.int64).reshape(self.n, dim)
        self.codes = Codes(numbers("centre", np.float64), numbers("codes", np.uint64).reshape(-1, self.n, -(-dim // 64)),
                           numbers("align", np.float64).reshape(-1, self.n), numbers("rest", np.float64))

    def score(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Integer inner products of the query with the rows ``at``."""
        return self.x[at].astype(np.int64) @ q


def first(score: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k first by descending score, then by place (places ascend by id)."""
    order = np.lexsort((at, -score))[:k]
    return score[order], at[order]


def nearest_same(s: Shard, q: np.ndarray, own: np.ndarray, label: np.ndarray, k: int) -> Iterator[tuple]:
    """(query, places, scores): the first ``k`` rows of the query's label but its own."""
    for lo in range(0, len(q), STRIP):
        part = slice(lo, lo + STRIP)
        lower, upper = s.codes.bounds(q[part].astype(np.float64))
        for i in range(len(lower)):
            at = np.flatnonzero((s.labels == label[lo + i]) & (s.rows != own[lo + i]))
            if len(at) > k:
                some = at[np.argpartition(-(lower[i, at] + upper[i, at]), k - 1)[:k]]
                at = at[upper[i, at] >= s.score(q[lo + i], some).min()]
            yield lo + i, *first(s.score(q[lo + i], at), at, k)


def in_band(s: Shard, q: np.ndarray, label: np.ndarray, wanted: list[np.ndarray], k: int, band=BAND) -> Iterator[tuple]:
    """(query, number of the positive, scores, places): the first ``k`` rows of
    other labels within the band of each of the query's positive scores."""
    for lo in range(0, len(q), STRIP):
        lower, upper = s.codes.bounds(q[lo:lo + STRIP].astype(np.float64))
        for i in range(len(lower)):
            other = np.flatnonzero(s.labels != label[lo + i])
            low, high = lower[i, other], upper[i, other]
            for nth, positive in enumerate(wanted[lo + i]):
                least, most = -(-band[0] * int(positive) // 100), band[1] * int(positive) // 100
                if least > most:
                    continue
                may = (high >= least) & (low <= most)
                sure = low[(low >= least) & (high <= most)]
                if len(sure) > k:
                    may &= high >= np.partition(sure, len(sure) - k)[len(sure) - k]
                at = other[may]
                score = s.score(q[lo + i], at)
                fits = (score >= least) & (score <= most)
                yield lo + i, nth, *first(score[fits], at[fits], k)


def _blocks(anchors: DataFrame, name: str, extra: dict[str, str]) -> DataFrame:
    """(dim, block, rows, labels, vecs, ...): anchors of one length, ``BLOCK_BYTES`` at most."""

    def build(table: pa.Table) -> pa.Table:
        x = np.asarray(table.column("vec").combine_chunks().flatten(), np.float64).reshape(len(table), -1)
        return pa.table({
            "dim": pa.array([x.shape[1]], pa.int32()), "block": table.column("block").slice(0, 1),
            "rows": [np.asarray(table.column("row"), np.int64).tobytes()],
            "labels": [np.asarray(table.column("label"), np.int64).tobytes()],
            "vecs": [integers(x).astype(np.int64).tobytes()],
            **{c: [table.column(c).to_pylist()] for c in extra}})

    sized = anchors.withColumn("dim", F.size("vec"))
    each = sized.groupBy("dim").agg(F.count("*").alias("n")).withColumn(
        "blocks", F.ceil(2 * 8 * F.col("dim") * F.col("n") / BLOCK_BYTES).cast("int"))  # half full on average
    schema = "dim int, block int, rows binary, labels binary, vecs binary" + "".join(f", {c} array<{t}>" for c, t in extra.items())
    return C.keep(sized.join(each, "dim").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
                  .groupBy("dim", "block").applyInArrow(build, schema), name)


def _search(coded: DataFrame, blocks: DataFrame, work, schema: str, name: str) -> DataFrame:
    """``work(shard, block row)`` for all pairs of equal length: block after
    block is broadcast (``BLOCK_BYTES`` for each length) to all shards."""
    names = [x.split()[0] for x in schema.split(", ")]

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                found = list(work(Shard(batch, i), batch, i))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=names)

    spark = coded.sparkSession
    path = os.path.join(scratch_path(spark, "corpus"), f"{name}-{uuid.uuid4().hex}")
    count = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    sent = blocks.select("dim", "block", *[F.col(c).alias(f"q_{c}") for c in blocks.columns if c not in ("dim", "block")])
    for b in range(count):
        pairs = coded.join(F.broadcast(sent.filter(F.col("block") == b)), "dim")
        pairs.mapInArrow(search, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _query(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, labels, vecs = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("q_rows", "q_labels", "q_vecs"))
    return rows, labels, vecs.reshape(len(rows), -1)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
         shard: int = SHARD) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): ``rows`` (row, vec_id, label, vec) as written, ``anchors``
    some of them."""
    coded = shards(rows, shard)

    def same(s: Shard, batch: pa.RecordBatch, i: int):
        own, label, q = _query(batch, i)
        for a, score, at in nearest_same(s, q, own, label, positives):
            yield np.full(len(at), own[a]), s.ids[at], s.known[at], s.rows[at], score

    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), F.col("known").desc(), "vec_id", "chosen")
    blocks = _blocks(anchors, "anchor-blocks", {})
    near = C.keep(_search(coded, blocks, same, "anchor long, vec_id long, known boolean, chosen long, score long", "same")
                  .withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= positives), "positives")
    wanted = near.groupBy("anchor").agg(F.transform(F.sort_array(F.collect_list(F.struct("nth", "score"))),
                                                    lambda x: x["score"]).alias("wanted"))

    def other(s: Shard, batch: pa.RecordBatch, i: int):
        own, label, q = _query(batch, i)
        scores = batch.column("q_wanted")[i].as_py()
        for a, nth, score, at in in_band(s, q, label, scores, negatives):
            yield np.full(len(at), own[a]), np.full(len(at), nth + 1), s.ids[at], s.known[at], score

    asked = _blocks(anchors.join(wanted.withColumnRenamed("anchor", "row"), "row"), "asked-blocks", {"wanted": "array<long>"})
    hard = Window.partitionBy("anchor", "nth").orderBy(F.col("score").desc(), F.col("known").desc(), "vec_id")
    found = (_search(coded, asked, other, "anchor long, nth long, vec_id long, known boolean, score long", "band")
             .withColumn("rank", F.row_number().over(hard)).filter(F.col("rank") <= negatives))
    named = near.join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor").select(
        "anchor", "nth", "anchor_id", F.when(F.col("known"), F.col("vec_id")).alias("positive_id"),
        F.col("score").alias("positive_score"))
    return found.join(named, ["anchor", "nth"]).select(
        "anchor_id", "positive_id", "rank", F.when(F.col("known"), F.col("vec_id")).alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def op11_bit_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(C.read(spark, sf_dir, "embeddings"), "vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = C.keep(rows.withColumn("label", moved), "vectors")
    return mine(rows, rows.filter(F.col("vec_id") % 100 == 0))


ORACLE = """
WITH v AS (
    SELECT row_number() OVER () AS row, vec_id,
           CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.row AS anchor, a.vec_id AS anchor_id, c.row AS chosen, c.vec_id, a.label = c.label AS same,
           CAST(list_sum(list_transform(list_zip(a.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v c ON a.row <> c.row AND len(a.vec) = len(c.vec)
    WHERE a.vec_id % 100 = 0),
p AS (
    SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, chosen) AS nth
    FROM s WHERE same QUALIFY nth <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.nth ORDER BY s.score DESC, s.vec_id NULLS LAST) AS INTEGER) AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
 AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""
