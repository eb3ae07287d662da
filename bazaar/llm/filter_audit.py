"""Interaction audit of filters on sorted posting lists.

Five filters judge every document by itself.  What a filter removes depends
on the filters before it: the audit tells, for every order of the filters
and every part of the corpus, what each step removes, what it finds already
removed, and what it costs in good and toxic documents.

``postings`` keeps, for every part and range of row ids, one sorted list of
failing ids for each filter (and of the documents marked good and toxic).
``sizes`` merges the lists of a range: a union over the filters already
applied, differences of the next filter's list against it.  A merge goes by
id ranges: it steps through the longer list in blocks and gallops (doubling
steps, then halving) in the other lists to the place of each block's ends, so
a stretch in which a list has no ids is skipped.  Sizes are added up over the
ranges; all orders come from the 80 (filters before, filter) pairs.

Scale: only (id, part, verdicts, text digest) leaves the texts.  Digests that
several rows share are found by an aggregation; those of the few hot ones (at
most ``HOT`` can hold a share of 1/``HOT`` of all rows) are broadcast, the others
joined, so no copy group meets in one task.  A range holds ``RANGE`` ids at
most, whatever its part's share of all rows.

Cases: null text is the empty text, a null part the empty string; rows with a
null id are copies of no other row and no other row is one of theirs; repeated
rows count each (rows of one id are not copies of a smaller id); labels given
twice for an id count if any of them is 1, labels of no row or with nulls
count nowhere; an empty table gives no parts and so no rows; further columns
do not matter.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from .text_counts import PIECE, Counted, flags

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # percent of words
MOST_CAPITALS = 3    # percent of code points
CAPITALS = flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
MARKS = flags("#$%&*|")
RANGE_BITS = 15
HOT = 1000
BLOCK = 512


# ------------------------------------------------------------- the lists

def verdicts(df: DataFrame, row: str, id_column: str, part: str, column: str) -> DataFrame:
    """(row, id, part, fails, digest): ``fails`` has bit 0 for A to bit 3 for D."""

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in C._pieces(whole, "text", PIECE):
                t = Counted(batch.column("text"))
                words = t.words()
                rules = [words < LEAST_WORDS, 100 * t.distinct_words() < LEAST_DISTINCT * words,
                         100 * t.chars(CAPITALS) > MOST_CAPITALS * t.code_points(), t.chars(MARKS) > 0]
                digest = [hashlib.sha256(t.data[i:j]).digest() for i, j in zip(t.offs[:-1], t.offs[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("id"), batch.column("part"),
                     pa.array(sum(r.astype(np.int32) << i for i, r in enumerate(rules))), pa.array(digest, pa.binary())],
                    names=["row", "id", "part", "fails", "digest"])

    return df.select(F.col(f"`{row}`").alias("row"), F.col(f"`{id_column}`").cast("long").alias("id"),
                     F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                     F.col(f"`{column}`").alias("text")).mapInArrow(
                         judge, "row long, id long, part string, fails int, digest binary")


def with_copies(judged: DataFrame) -> DataFrame:
    """``judged`` with bit 4 (E) of ``fails``: a smaller id has the same text."""
    known = judged.filter("id IS NOT NULL")
    same = C.keep(known.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("n"))
                  .filter("least < most").select("digest", "least", "n"), "audit-copies")
    total = judged.count()
    hot = same.filter(F.col("n") * HOT >= total).select("digest", F.col("least").alias("hot_least"))  # HOT rows at most
    rest = same.filter(F.col("n") * HOT < total).select("digest", "least")
    marked = judged.join(F.broadcast(hot), "digest", "left")
    # Rows of hot digests and rows without an id need no partner: they go round the shuffle join.
    done = marked.filter("hot_least IS NOT NULL OR id IS NULL").withColumn("least", F.col("hot_least"))
    open_ = marked.filter("hot_least IS NULL AND id IS NOT NULL").join(rest, "digest", "left")
    columns = ["row", "id", "part", "fails", "least"]
    copied = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    return done.select(*columns).union(open_.select(*columns)).select(
        "row", "id", "part", F.when(copied, F.col("fails") + 16).otherwise(F.col("fails")).alias("fails"))


def marks(labels: DataFrame) -> DataFrame:
    """(id, good, toxic): one row an id."""
    return (labels.select(F.col("doc_id").cast("long").alias("id"), "quality", "toxic").filter("id IS NOT NULL").groupBy("id")
            .agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
                 F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
            .filter("good OR toxic"))


LISTS = ["good", "toxic", *FILTERS]


def postings(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", part: str = "lang", column: str = "text") -> DataFrame:
    """(part, range, docs, good, toxic, A, ..., E): per part and id range the
    number of documents and the ascending row ids of each list.  Ids are those
    of the rows as written first, so rows without or with a repeated id count."""
    taken = {c.lower() for c in df.columns}
    row = "audit_row"
    while row in taken:
        row += "_"
    numbered = df.select(id_column, part, column).withColumn(row, F.monotonically_increasing_id())
    judged = C.keep(verdicts(numbered, row, id_column, part, column), "audit-verdicts")
    copied = with_copies(judged)
    unknown = F.lit(None).cast("boolean")
    bits = copied.filter("id IS NOT NULL").join(marks(labels), "id", "left").unionByName(
        copied.filter("id IS NULL").withColumns({"good": unknown, "toxic": unknown}))
    failing = {name: F.col("fails").bitwiseAND(1 << i) != 0 for i, name in enumerate(FILTERS)}
    chosen = {"good": F.col("good"), "toxic": F.col("toxic")} | failing
    return (bits.groupBy("part", F.shiftright("row", RANGE_BITS).alias("range"))
            .agg(F.count("*").alias("docs"),
                 *[F.sort_array(F.collect_list(F.when(chosen[name], F.col("row")))).alias(name) for name in LISTS]))


# ------------------------------------------------------------ the merges

def gallop(ids: np.ndarray, key: int, lo: int) -> int:
    """First place from ``lo`` on of an id of at least ``key``: steps double
    until one reaches it, then the last step is halved."""
    n, step = len(ids), 1
    if lo >= n or ids[lo] >= key:
        return lo
    while lo + step < n and ids[lo + step] < key:
        lo += step
        step *= 2
    return bisect_left(ids, key, lo + 1, min(n, lo + step))


def ranges(lists: list[np.ndarray], block: int = BLOCK) -> Iterator[list[np.ndarray]]:
    """The parts of all lists in id range after id range: each range ends
    with a block of the longest list, found in the others by galloping."""
    longest = max(lists, key=len)
    at = [0] * len(lists)
    for i in range(block, len(longest) + block, block):
        if i < len(longest):
            to = [gallop(x, longest[i], lo) for x, lo in zip(lists, at)]
        else:
            to = [len(x) for x in lists]
        yield [x[lo:hi] for x, lo, hi in zip(lists, at, to)]
        at = to


def union(lists: list[np.ndarray]) -> np.ndarray:
    """The ids in any of several ascending lists, ascending."""
    parts = []
    for pieces in ranges(lists):
        full = [x for x in pieces if len(x)]
        if len(full) == 1:
            parts.append(full[0])
        elif full:
            merged = np.sort(np.concatenate(full), kind="stable")
            parts.append(merged[np.append(True, merged[1:] != merged[:-1])])
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def difference(ids: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The ids that ``other`` lacks."""
    parts = []
    for mine, theirs in ranges([ids, other]):
        if len(theirs) and len(mine):
            at = np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)
            mine = mine[theirs[at] != mine]
        parts.append(mine)
    return np.concatenate(parts) if parts else ids[:0]


def merged(lists: dict[str, np.ndarray], good: np.ndarray, toxic: np.ndarray, names: str = FILTERS) -> list[tuple]:
    """(mask of the filters before, filter, failing, removed, good lost, toxic
    lost) for every filter and every set of the others."""
    before = {0: np.zeros(0, np.int64)}
    for mask in range(1, 1 << len(names)):
        before[mask] = union([lists[f] for i, f in enumerate(names) if mask >> i & 1])
    out = []
    for i, f in enumerate(names):
        for mask, gone in before.items():
            if not mask >> i & 1:
                removed = difference(lists[f], gone)
                out.append((mask, f, len(lists[f]), len(removed), len(removed) - len(difference(removed, good)),
                            len(removed) - len(difference(removed, toxic))))
    return out


SIZES = "part string, docs long, mask int, filter string, failing long, removed long, good_lost long, toxic_lost long"


def sizes(lists: DataFrame, names: str = FILTERS) -> DataFrame:
    """``merged`` for every range, added up for each part."""

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids = {name: np.asarray(batch.column(name)[i].values, np.int64) for name in LISTS}
                rows = merged(ids, ids["good"], ids["toxic"], names)
                columns = list(zip(*rows))
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("part")[i].as_py()] * n), pa.array([batch.column("docs")[i].as_py()] * n, pa.int64()),
                     pa.array(columns[0], pa.int32()), pa.array(columns[1]), *(pa.array(c, pa.int64()) for c in columns[2:])],
                    names=[x.split()[0] for x in SIZES.split(", ")])

    return (lists.select("part", "docs", *LISTS).mapInArrow(merge, SIZES).groupBy("part", "mask", "filter")
            .agg(*[F.sum(c).alias(c) for c in ("docs", "failing", "removed", "good_lost", "toxic_lost")]))


def audit(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", part: str = "lang", column: str = "text") -> DataFrame:
    """One row per part, order of the filters and step."""
    spark = df.sparkSession
    lists = C.keep(postings(df, labels, id_column, part, column), "audit-postings")
    found = C.keep(sizes(lists), "audit-sizes")  # 80 rows a part
    orders = ["".join(p) for p in permutations(FILTERS)]
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    steps = spark.createDataFrame(
        [(o, k + 1, o[k], sum(bit[f] for f in o[:k])) for o in orders for k in range(len(o))],
        "filter_order string, step int, filter string, mask int")  # 600 rows
    all_bits = (1 << len(FILTERS)) - 1
    alone = found.filter(F.col("mask") == all_bits - F.element_at(
        F.create_map(*[F.lit(x) for f, b in bit.items() for x in (f, b)]), F.col("filter"))).select(
            "part", "filter", F.col("removed").alias("unique_fails"))
    # The same ``removed`` stands at each order that applies the same filters before.
    n = len(FILTERS)
    orders_with = F.factorial(F.bit_count("mask")) * F.factorial(n - 1 - F.bit_count("mask"))
    shapley = found.groupBy("part", "filter").agg(F.sum(F.col("removed") * orders_with).alias("shapley"))
    placed = (found.join(F.broadcast(steps), ["filter", "mask"])
              .join(alone, ["part", "filter"]).join(shapley, ["part", "filter"]))
    gone = F.sum("removed").over(Window.partitionBy("part", "filter_order").orderBy("step")
                                 .rowsBetween(Window.unboundedPreceding, 0))
    return placed.select("part", "filter_order", "step", (F.col("docs") - gone).alias("kept"), "removed",
                         (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost",
                         "shapley")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
least_id AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
w AS (
    SELECT d.doc_id, part, d.text, regexp_extract_all(d.text, '[^\x20\x09-\x0D]+') AS words,
           coalesce(d.doc_id > l.least, false) AS copied
    FROM d JOIN least_id l ON d.text = l.text),
m AS (SELECT doc_id, coalesce(max(CAST(quality = 1 AS INT)), 0) AS good, coalesce(max(CAST(toxic = 1 AS INT)), 0) AS toxic
      FROM labels GROUP BY doc_id),
f AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CAST(len(words) < 200 AS INT)
           + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
           + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INT)
           + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
           + 16 * CAST(copied AS INT) AS fails
    FROM w LEFT JOIN m ON w.doc_id = m.doc_id),
p AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
parts AS (SELECT DISTINCT part FROM p),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
           [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM l a, l b, l c, l d, l e
    WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (
    SELECT filter_order, CAST(k AS INTEGER) AS step, bits[k] AS bit,
           CAST(coalesce(list_sum(bits[:k - 1]), 0) AS INTEGER) AS before
    FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
steps AS (
    SELECT parts.part, filter_order, step, bit,
           CAST(coalesce(sum(n) FILTER (fails & (before | bit) = 0), 0) AS BIGINT) AS kept,
           CAST(coalesce(sum(n) FILTER (fails & bit > 0 AND fails & before = 0), 0) AS BIGINT) AS removed,
           CAST(coalesce(sum(n) FILTER (fails & bit > 0 AND fails & before > 0), 0) AS BIGINT) AS redundant,
           CAST(coalesce(sum(n) FILTER (fails = bit), 0) AS BIGINT) AS unique_fails,
           CAST(coalesce(sum(p.good) FILTER (fails & bit > 0 AND fails & before = 0), 0) AS BIGINT) AS good_lost,
           CAST(coalesce(sum(p.toxic) FILTER (fails & bit > 0 AND fails & before = 0), 0) AS BIGINT) AS toxic_lost
    FROM parts CROSS JOIN s JOIN p ON p.part = parts.part
    GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM steps
"""
