"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words.  A document's expected copies are
its source's target / size; the expected copies are prefix-summed over the
documents of the source, one random offset is added, and a document is
emitted once for each whole number its step crosses.  Documents are laid out
by size, so the copies taken are spread evenly over short and long ones and
the words taken come within about one longest document of the target.

Targets: sources in code-point order (null last) weigh ``WEIGHTS``,
repeating, and share ``SHARE`` of all words; a target stops at ``MOST`` times
its source's size and the excess is shared again by weight until none is
above (water level: the least level at which the shares add up).

Scale: the place of a document within its source is the number of documents
in smaller cells plus its rank in its own cell.  A cell is (source, size,
hash bucket); the hash bucket splits a size that many documents share, so no
window holds more than about ``CELL`` rows in expectation, whatever a
source's share of all rows.  Offsets and hashes are fixed by ``SEED``:
reruns agree.

Cases: null text has size 0; documents of size 0 are laid out like others and
take no words; null sources are one source; a source without words has target
0; repeated rows are separate documents; an empty table gives an empty one;
other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
CELL = 1000


def n_words(column: str):
    return F.coalesce(F.regexp_count(F.col(column), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """(source, place, documents, source_size, target): one row a source."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    every = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source, not a document
    placed = totals.withColumn("place", F.row_number().over(every) - 1)
    weighed = placed.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)),
                                                       (F.col("place") % len(WEIGHTS) + 1).cast("int")))
    cap = MOST * F.col("source_size")
    level = Window.orderBy(cap / F.col("weight"), "place")
    rest = level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    water = (weighed
             .withColumn("height", (SHARE * F.sum("source_size").over(all_rows) - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
                         / F.sum("weight").over(rest))
             .withColumn("open", F.col("height") < cap / F.col("weight"))
             .withColumn("water", F.first(F.when(F.col("open"), F.col("height")), ignorenulls=True).over(all_rows)))
    return water.select("source", "place", "documents", "source_size",
                        F.coalesce(F.least(F.col("weight") * F.col("water"), cap), F.lit(0.0)).alias("target"))


def copies(df: DataFrame, row: str, id_column: str = "doc_id", source: str = "source", column: str = "text") -> DataFrame:
    """(row, id, size, source_size, target, copies) for every row of ``df``."""
    sized = C.keep(df.select(F.col(row).alias("row"), F.col(id_column).alias("id"), F.col(source).cast("string").alias("source"),
                             n_words(column).alias("size")), "sizes")
    sources = C.keep(targets(sized), "targets")
    total = sources.agg(F.sum("documents")).first()[0] or 0
    spread = F.xxhash64(F.lit(C.SEED), "id", "row")
    celled = sized.join(sources, sized.source.eqNullSafe(sources.source)).drop("source").withColumn(
        "cell", F.pmod(spread, F.lit(int(total // CELL) + 1)))
    cells = C.keep(celled.groupBy("place", "size", "cell").agg(F.count("*").alias("n")), "cells")
    by_size = cells.groupBy("place", "size").agg(F.sum("n").alias("n")).select(
        "place", "size", (F.sum("n").over(Window.partitionBy("place").orderBy("size")) - F.col("n")).alias("shorter"))
    by_cell = cells.select("place", "size", "cell", (F.sum("n").over(Window.partitionBy("place", "size").orderBy("cell"))
                                                     - F.col("n")).alias("earlier"))
    base = C.keep(by_cell.join(by_size, ["place", "size"])
                  .select("place", "size", "cell", (F.col("shorter") + F.col("earlier")).alias("base")), "bases")
    nth = F.row_number().over(Window.partitionBy("place", "size", "cell").orderBy(spread, "row")) + F.col("base")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.pmod(F.xxhash64(F.lit(C.SEED + 7), "place"), F.lit(1 << 30)) / float(1 << 30)
    return (celled.join(base, ["place", "size", "cell"]).withColumn("nth", nth).withColumn("step", expected)
            .select("row", "id", "size", "source_size", "target",
                    F.least(F.floor(F.col("step") * F.col("nth") + offset)
                            - F.floor(F.col("step") * (F.col("nth") - 1) + offset), F.lit(int(MOST))).alias("copies")))


def mix_sources(df: DataFrame, id_column: str = "doc_id", source: str = "source", column: str = "text") -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it."""
    row, n = C.free_name(df, "mix_row"), C.free_name(df, "mix_copies")
    keyed = C.numbered(df, row)
    taken = (copies(keyed, row, id_column, source, column).filter("copies > 0")
             .select(F.col("row").alias(row), F.col("copies").alias(n)))
    return (keyed.join(taken, row).withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n).cast("int"))))
            .select(*[F.col(f"`{c}`") for c in df.columns]))


def op7_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ``copies`` reads the documents once, for a table of sizes that has the row numbers
    docs = C.read(spark, sf_dir, "documents").withColumn("mix_row", F.monotonically_increasing_id())
    return copies(docs, "mix_row").select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                                          (F.col("copies") * F.col("size")).alias("taken"))
