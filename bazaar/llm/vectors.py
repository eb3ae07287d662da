"""Vectors in shards for the search operators.

``usable`` drops vectors that take no part: null, without components, or
holding null or non-finite ones.  A row is a row: a vec_id that repeats has
all its vectors, as queries and as candidates, and only the query's own row is
no candidate of it.  A null vec_id can be found (after all other ids of the
same score) and asks nothing.  Vectors meet those of the same length only.

``shards`` writes every shard once with the index its operator builds for it.
``search`` takes the queries in blocks of bounded size and broadcasts one
after the other to the shards: a stated query set against all rows, in
blocks.  No vector is shuffled for a search, only each shard's results are.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common as C

BLOCK_BYTES = 8 << 20
NO_ID = np.iinfo(np.int64).max


def usable(df: DataFrame, id_column: str, column: str, zero: bool = True) -> DataFrame:
    """(row long, vec_id long, vec array<double>), written once; ``zero``: whether zero vectors take part."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    out = (df.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"),
                     F.col(f"`{column}`").cast("array<double>").alias("vec"))
           .filter(F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", fine)))
    if not zero:
        out = out.filter(F.exists("vec", lambda x: x != 0.0))
    return C.numbered(out, "row")


SHARD = "dim int, ids binary, known binary, rows binary, vecs binary, index binary"


def shards(vectors: DataFrame, each: int, build: Callable[[np.ndarray], bytes]) -> DataFrame:
    """Shards of about ``each`` vectors of one length, by a hash of the row:
    vectors in ascending order of id (null last), with ``build(vectors)``."""

    def pack(table: pa.Table) -> pa.Table:
        column = table.column("vec_id").combine_chunks()
        known = column.is_valid().to_numpy(zero_copy_only=False)
        ids, rows = np.asarray(column.fill_null(NO_ID), np.int64), np.asarray(table.column("row"), np.int64)
        order = np.lexsort((rows, ids, ~known))
        x = np.asarray(table.column("vec").combine_chunks().flatten(), np.float64).reshape(len(order), -1)[order]
        return pa.table({"dim": pa.array([x.shape[1]], pa.int32()), "ids": [ids[order].tobytes()],
                         "known": [known[order].tobytes()], "rows": [rows[order].tobytes()], "vecs": [x.tobytes()],
                         "index": [build(x)]})

    many = max(1, -(-vectors.count() // each))
    return C.keep(vectors.withColumn("dim", F.size("vec"))
                  .groupBy("dim", F.pmod(F.xxhash64("row"), F.lit(many)).alias("shard")).applyInArrow(pack, SHARD), "shards")


def blocks(queries: DataFrame, each: int) -> DataFrame:
    """Blocks of about ``each`` queries of one length, of about ``BLOCK_BYTES`` at most."""

    def pack(table: pa.Table) -> pa.Table:
        x = np.asarray(table.column("vec").combine_chunks().flatten(), np.float64)
        return pa.table({"dim": table.column("dim").slice(0, 1), "block": table.column("block").slice(0, 1),
                         "q_rows": [np.asarray(table.column("row"), np.int64).tobytes()], "q_vecs": [x.tobytes()]})

    sized = queries.filter("vec_id IS NOT NULL").withColumn("dim", F.size("vec"))
    n = F.col("n")
    many = sized.groupBy("dim").agg(F.count("*").alias("n")).select(
        "dim", F.greatest(F.ceil(n / each), F.ceil(8 * F.col("dim") * n / BLOCK_BYTES)).cast("int").alias("blocks"))
    return C.keep(sized.join(many, "dim").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
                  .groupBy("dim", "block").applyInArrow(pack, "dim int, block int, q_rows binary, q_vecs binary"), "query-blocks")


class Shard:
    """A row of ``shards`` joined with a block, opened: vectors ``x`` with their
    index, queries ``q`` and the place of each among the vectors (``own``, -1: in another shard)."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        def numbers(name, kind):
            return np.frombuffer(batch.column(name)[i].as_py(), kind)
        self.ids, self.known, self.rows = numbers("ids", np.int64), numbers("known", bool), numbers("rows", np.int64)
        self.x = numbers("vecs", np.float64).reshape(len(self.ids), -1)
        self.index = batch.column("index")[i].as_py()
        self.asked = numbers("q_rows", np.int64)
        self.q = numbers("q_vecs", np.float64).reshape(len(self.asked), -1)
        order = np.argsort(self.rows)
        place = np.minimum(np.searchsorted(self.rows[order], self.asked), len(order) - 1)
        self.own = np.where(self.rows[order][place] == self.asked, order[place], -1)


def search(coded: DataFrame, asked: DataFrame, work: Callable[[Shard], tuple[np.ndarray, np.ndarray]], kind: str) -> DataFrame:
    """(query, vec_id, known, score): ``work`` gives for every query of a block
    the places of what it finds in a shard (-1: none) and their scores."""
    schema = f"query long, vec_id long, known boolean, score {kind}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                s = Shard(batch, i)
                place, score = work(s)
                at = np.nonzero(place >= 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.asked[at[0]]), pa.array(s.ids[place[at]]), pa.array(s.known[place[at]]),
                     pa.array(score[at]).cast(pa.int64() if kind == "long" else pa.float64())],
                    names=["query", "vec_id", "known", "score"])

    spark = coded.sparkSession
    path = os.path.join(scratch_path(spark, "corpus"), f"found-{uuid.uuid4().hex}")
    for b in range((asked.agg(F.max("block")).first()[0] or 0) + 1):
        pairs = coded.join(F.broadcast(asked.filter(F.col("block") == b).drop("block")), "dim")
        pairs.mapInArrow(run, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def ranked(found: DataFrame, queries: DataFrame, order: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the first ``k`` of each query by ``order``, then by id."""
    best = Window.partitionBy("query").orderBy(order, F.col("known").desc(), "vec_id")
    named = queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).join(named, "query")
            .select("query_id", "rank", F.when(F.col("known"), F.col("vec_id")).alias("vec_id"), "score"))
