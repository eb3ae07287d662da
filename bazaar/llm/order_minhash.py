"""MinHash near-dedup by Order MinHash.

A text is its sequence of shingles (``K`` words each), labelled with their
occurrence number.  For each of ``SKETCHES`` hash functions a sketch samples
the ``2`` least labelled shingles and keeps them in text order, so a sketch
in common needs common shingles in a common order (edit similarity, not just
set overlap).  Texts with a sketch in common are candidates; a candidate pair
is a link if the banded alignment of the two shingle sequences gives

    matches / (shingles of a + shingles of b - matches) >= 0.8.

Classes are the connected components of the links.

Scale: equal word sequences collapse first, so a group of exact copies is
one vertex.  A bucket (texts with one sketch in common) is not paired up:
every member is compared with the bucket's hub, the member whose sketches
are the most common, and components are taken.  Members of one bucket that
are still in different components are compared where they can reach 0.8 at
all: a text of x shingles needs 0.8 x of them in other texts too.  The loose
ones among them, those outside the largest component of a bucket, are
broadcast in blocks of ``BLOCK`` bytes, and the others are scanned: shared
shingles are counted for those with a bucket in common (``_open_links``), and
only a link that joins two components leaves a task.  So loose variants of one
text, which are close to each other and still no near copies, make no pairs
and no shuffle; what they cost is the scan for each block of them.  No link between two classes is
lost.  A sketch pair of similarity 0.8 shares each of 12 sketches with
probability 0.64: it is missed by all about 5 times in a million.

Cases: texts of 1 to K - 1 words have no shingles and match only equal word
sequences; null texts and texts without words are classes of their own;
repeated rows are exact copies of each other; an empty table gives an empty
result.  White space and other columns do not matter.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .components import components, merged

K = 5
SIMILARITY = 0.8
SKETCHES = 12
PIECE = 1 << 20
BLOCK = 8 << 20  # bytes of word names (4 a word) in a block of loose texts
_RNG = np.random.default_rng(C.SEED + 5)
FUNCTIONS = _RNG.integers(1, 2**62, SKETCHES).astype(C.U64) * C.U64(2) + C.U64(1)
STEP = _RNG.integers(1, 2**62, K).astype(C.U64) * C.U64(2) + C.U64(1)


def shingles(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(name, text index) of each run of ``K`` words of one text."""
    n = len(words) - K + 1
    if n <= 0:
        return np.zeros(0, C.U64), np.zeros(0, np.int64)
    x = np.zeros(n, C.U64)
    for t in range(K):
        x += words[t:t + n] * STEP[t]
    inside = text[:n] == text[K - 1:]
    return C.mix(x[inside]), text[:n][inside]


def labelled(names: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Names told apart by how often the same name came before in its text."""
    key = C.mix(names ^ C.mix(text.astype(C.U64) + C.U64(1)))
    order = np.argsort(key, kind="stable")
    s = key[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    at = np.arange(len(s))
    nth = np.empty(len(s), C.U64)
    nth[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(C.U64)
    return C.mix(names + nth * C.U64(0x9E3779B97F4A7C15))


def sketches(names: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text indices, sketch matrix) of the texts that have shingles."""
    if not len(names):
        return np.zeros(0, np.int64), np.zeros((0, SKETCHES), np.int64)
    x = labelled(names, text)
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    count = np.diff(np.append(first, len(x)))
    out = np.empty((len(first), SKETCHES), C.U64)
    for j, a in enumerate(FUNCTIONS):
        h = x * a
        one = np.flatnonzero(h == np.repeat(np.minimum.reduceat(h, first), count))
        h[one] = ~C.U64(0)
        two = np.flatnonzero(h == np.repeat(np.minimum.reduceat(h, first), count))  # of one shingle: that one again
        left, right = np.minimum(one, two), np.maximum(one, two)
        out[:, j] = C.mix(x[left] * C.U64(3) + x[right] * a + C.U64(j))
    return text[first], out.view(np.int64)


def _words(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    texts = C.Bytes(batch.column(column))
    starts, ends, text = C.word_spans(texts.data, texts.offs)
    return C.Roller(texts.data).names(starts, ends), text


SIGNED = "row long, a long, b long, n long, sketch array<long>"


def signatures(df: DataFrame, row: str, column: str) -> DataFrame:
    """Per row: two names of its whole word sequence, its number of words, its sketches."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in C._pieces(whole, column, PIECE):
                words, text = _words(batch, column)
                n = np.bincount(text, minlength=len(batch)).astype(np.int64)
                offs = np.concatenate([[0], np.cumsum(n)])
                place = (np.arange(len(words)) - offs[text]).astype(C.U64)
                names = []
                for salt in (1, 2):
                    total = np.concatenate([np.zeros(1, C.U64), np.cumsum(
                        C.mix(words + C.mix(place * C.U64(2) + C.U64(salt))), dtype=C.U64)])
                    names.append((total[offs[1:]] - total[offs[:-1]]).view(np.int64))
                found, sketch = sketches(*shingles(words, text))
                size = np.zeros(len(batch) + 1, np.int32)
                size[found + 1] = SKETCHES
                yield pa.RecordBatch.from_arrays(
                    [batch.column(row), pa.array(names[0]), pa.array(names[1]), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(np.cumsum(size, dtype=np.int32)), pa.array(sketch.ravel()))],
                    names=["row", "a", "b", "n", "sketch"])

    return df.select(row, column).mapInArrow(sign, SIGNED)


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence of two sequences within ``band`` diagonals
    of the main one: least ends of increasing chains over the equal places."""
    places: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    for i, x in enumerate(a):
        for j in places.get(x, ()):  # descending, so that a place of a is used once
            if abs(i - j) <= band:
                at = bisect_left(ends, j)
                if at == len(ends):
                    ends.append(j)
                else:
                    ends[at] = j
    return len(ends)


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether the banded alignment of two shingle sequences reaches ``least``."""
    total = len(a) + len(b)
    need = int(np.ceil(least * total / (1 + least) - 1e-9))  # matches for the ratio
    if min(len(a), len(b)) < need or not total:
        return False
    zero = np.zeros(max(len(a), len(b)), np.int64)
    if len(np.intersect1d(labelled(a, zero[:len(a)]), labelled(b, zero[:len(b)]), assume_unique=True)) < need:
        return False  # more than the alignment could reach
    m = min(len(a), len(b))
    differ = np.flatnonzero(a[:m] != b[:m])
    head = int(differ[0]) if len(differ) else m
    differ = np.flatnonzero(a[len(a) - m + head:][::-1] != b[len(b) - m + head:][::-1])
    tail = int(differ[0]) if len(differ) else m - head
    if head + tail >= need:
        return True
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    return head + tail + aligned(a.tolist(), b.tolist(), total - 2 * need) >= need


def _verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (a, b) whose word sequences (row, words) are similar."""
    joined = (pairs.join(words.select(F.col("row").alias("b"), F.col("words").alias("words_b")), "b")
              .join(words.select(F.col("row").alias("a"), F.col("words").alias("words_a")), "a"))

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sequence(x):
            w = C.mix(np.frombuffer(x.as_py(), np.uint32).astype(C.U64))
            return shingles(w, np.zeros(len(w), np.int64))[0]

        for batch in batches:
            keep = [similar(sequence(x), sequence(y)) for x, y in zip(batch.column("words_a"), batch.column("words_b"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.select("a", "b", "words_a", "words_b").mapInArrow(verify, "a long, b long")


def _word_table(df: DataFrame, row: str, column: str) -> DataFrame:
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in C._pieces(whole, column, PIECE):
                words, text = _words(batch, column)
                offs = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(batch)))])
                w = (words >> C.U64(32)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(row), pa.array([w[i:j].tobytes() for i, j in zip(offs, offs[1:])], pa.binary())],
                    names=["row", "words"])

    return df.select(row, column).mapInArrow(encode, "row long, words binary")


def _fits(n: str, m: str):
    """The longer of two texts of similarity 0.8 has at most 1.25 times the shingles."""
    return F.least(n, m) - (K - 1) >= SIMILARITY * (F.greatest(n, m) - (K - 1)) - 1e-9


def _own_shingles(words: DataFrame) -> DataFrame:
    """(row, own): how many labelled shingles of a text no other of the texts has.

    Names are sent in 40 bits: one that meets another's counts as shared, so
    ``own`` may be too low but never too high."""

    def names(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in C._pieces(whole, "words", PIECE):
                rows = np.asarray(batch.column("row"))
                name, text = _labelled_texts(batch.column("words"))
                yield pa.RecordBatch.from_arrays([pa.array(rows[text]), pa.array((name >> C.U64(24)).view(np.int64))], names=["row", "name"])

    return (words.mapInArrow(names, "row long, name long").groupBy("name")
            .agg(F.count("*").alias("texts"), F.min("row").alias("row")).filter("texts = 1")
            .groupBy("row").agg(F.count("*").alias("own")))


def _labelled_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(name, text index) of the labelled shingles of stored word sequences."""
    lists = [np.frombuffer(x.as_py(), np.uint32) for x in column]
    text = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    words = np.concatenate(lists) if lists else np.zeros(0, np.uint32)
    name, text = shingles(C.mix(words.astype(C.U64)), text)
    return labelled(name, text), text


def _sequence(words: bytes) -> np.ndarray:
    w = C.mix(np.frombuffer(words, np.uint32).astype(C.U64))
    return shingles(w, np.zeros(len(w), np.int64))[0]


class _Loose:
    """A block of loose texts: which have a bucket, and which a shingle."""

    def __init__(self, rows: list):
        self.row, self.root = (np.array([r[k] for r in rows], np.int64) for k in ("row", "root"))
        self.words = [bytes(r["words"]) for r in rows]
        name, text = _labelled_texts(pa.array(self.words, pa.binary()))
        self.size = np.bincount(text, minlength=len(rows))
        order = np.argsort(name, kind="stable")
        self.text, name = text[order], name[order]
        first = np.flatnonzero(np.append(True, name[1:] != name[:-1])) if len(name) else np.zeros(0, np.int64)
        self.names, self.first = name[first], np.append(first, len(name))
        buckets: dict[int, list[int]] = {}
        for i, r in enumerate(rows):
            for k in r["sketches"]:
                buckets.setdefault(k, []).append(i)
        self.buckets = {k: np.array(v) for k, v in buckets.items()}

    def near(self, names: np.ndarray, sketches: list[int]) -> np.ndarray:
        """Places of the loose texts of the same buckets that share enough of the labelled shingles ``names``."""
        here = [self.buckets[k] for k in sketches if k in self.buckets]
        if not here or not len(self.names):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        at = at[self.names[at] == names]
        both = np.bincount(np.concatenate([self.text[self.first[k]:self.first[k + 1]] for k in at] or [np.zeros(0, np.int64)]),
                           minlength=len(self.row))
        total = self.size + len(names)
        here = np.unique(np.concatenate(here))
        return here[both[here] >= np.ceil(SIMILARITY * total[here] / (1 + SIMILARITY) - 1e-9)]


def _links_to(loose: _Loose, batch: pa.RecordBatch, parent: dict[int, int]) -> Iterator[tuple[int, int]]:
    """Links between the loose texts and those of ``batch`` (row, root, loose,
    words, sketches), as long as they join two roots (``parent``)."""

    def top(r: int) -> int:
        parent.setdefault(r, r)
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    name, text = _labelled_texts(batch.column("words"))
    ends = np.append(0, np.cumsum(np.bincount(text, minlength=len(batch))))
    columns = (batch.column(c).to_pylist() for c in ("row", "root", "loose", "words", "sketches"))
    for j, (row, root, open_, words, sketches) in enumerate(zip(*columns)):
        mine = None
        for i in loose.near(name[ends[j]:ends[j + 1]], sketches).tolist():
            other, its = int(loose.row[i]), int(loose.root[i])
            # two loose texts meet from either side: once is enough
            if its == root or open_ and other >= row or top(its) == top(root):
                continue
            mine = _sequence(words) if mine is None else mine
            if similar(_sequence(loose.words[i]), mine):
                parent[top(its)] = top(root)
                yield other, row


def _open_links(placed: DataFrame, words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between members (sketch, row, n, root) of one bucket and
    of different components, enough to join what belongs together."""
    spark, size = placed.sparkSession, F.col("n") - (K - 1)
    words = C.keep(C.picked(words, "row", placed), "open-words")
    own = _own_shingles(words)
    live = C.keep(placed.join(own, "row", "left")
                  .filter(size - F.coalesce("own", F.lit(0)) >= F.ceil(SIMILARITY * size - 1e-6))
                  .select("sketch", "row", "n", "root"), "live")
    mains = (live.groupBy("sketch", "root").agg(F.sum("n").alias("size"))
             .groupBy("sketch").agg(F.max(F.struct("size", "root")).alias("top"), F.count("*").alias("roots"))
             .filter("roots > 1").select("sketch", F.col("top.root").alias("main")))
    # A row has a sketch for each of SKETCHES functions at most.
    rows = C.keep(live.join(mains, "sketch").groupBy("row", "n", "root")
                  .agg(F.collect_list("sketch").alias("sketches"), F.max(F.col("root") != F.col("main")).alias("loose")), "rows")
    # Written, since every block reads them twice: a join here would shuffle them as often.
    texts = C.keep(C.picked(words, "row", rows).join(rows, "row").select("row", "root", "loose", "words", "sketches"), "open-texts")
    total = rows.filter("loose").agg(F.sum(F.col("n") * 4)).first()[0] or 0
    path = C.scratch(spark, "open-links")
    blocks = max(1, -(-total // block))
    for k in range(blocks):
        part = texts.filter(F.col("loose") & (F.pmod(F.xxhash64("row"), F.lit(blocks)) == k)).collect()  # about ``block`` bytes
        held = spark.sparkContext.broadcast(_Loose(part))

        def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parent: dict[int, int] = {}
            for whole in batches:
                for batch in C._pieces(whole, "words", PIECE):
                    found = list(_links_to(held.value, batch, parent))
                    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

        texts.mapInArrow(scan, "a long, b long").write.mode("append").parquet(path)
        held.destroy()
    return spark.read.schema("a long, b long").parquet(path)


def classes(df: DataFrame, row: str, column: str = "text") -> DataFrame:
    """(row, root) for every row of ``df`` whose text has words: ``root`` is
    the least ``row`` value of its class of near duplicates.  ``row``: a
    column that is different and not null in every row and the same in every
    reading of ``df``."""
    signed = C.keep(signatures(df, row, column).filter("n > 0"), "signatures")
    key = ["a", "b", "n"]
    groups = C.keep(signed.groupBy(*key).agg(F.min("row").alias("first"), F.first("sketch").alias("sketch")), "texts")
    # Members of every bucket that has two, with the bucket's size.
    sampled = groups.select(F.col("first").alias("row"), "n", F.explode(F.array_distinct("sketch")).alias("sketch"))
    sizes = sampled.groupBy("sketch").agg(F.count("*").alias("members")).filter("members > 1")
    members = C.keep(sampled.join(sizes, "sketch"), "members")
    # Small tables are written, so that Spark knows their size and broadcasts them where they meet texts.
    typical = C.keep(members.groupBy("row").agg(F.sum("members").alias("common")), "typical")
    hubs = (members.join(typical, "row").groupBy("sketch").agg(F.max(F.struct("common", -F.col("row"), "n")).alias("hub"))
            .select("sketch", (-F.col("hub.col2")).alias("hub"), F.col("hub.n").alias("hub_n")))
    tested = C.keep(members.join(hubs, "sketch").filter("row != hub").filter(_fits("n", "hub_n"))
                    .select(F.col("hub").alias("a"), F.col("row").alias("b")).distinct(), "pairs")
    words = C.keep(_word_table(C.picked(df, row, typical), row, column), "words")
    links = C.keep(_verified(tested, words), "links")
    # Buckets whose members the links so far leave in different components.
    part = C.keep(components(links), "parts")
    placed = members.join(part.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    mixed = placed.groupBy("sketch").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most")
    left_open = C.keep(placed.join(mixed.select("sketch"), "sketch", "left_semi").select("sketch", "row", "n", "root"), "open")
    part = C.keep(merged(part, _open_links(left_open, words)), "parts")
    named = groups.select(*key, "first").join(part.withColumnRenamed("node", "first"), "first", "left").select(
        *key, F.coalesce("root", "first").alias("root"))
    return signed.select("row", *key).join(named, key).select(F.col("row").alias(row), "root")


def _named(rows: DataFrame, id_column: str) -> DataFrame:
    """Per row of ``rows`` (row, id, text; as written): the columns of
    ``near_duplicates`` and ``row``."""
    ids = C.keep(rows.select("row", "id").join(classes(rows, "row", "text"), "row", "left")
                 .select("row", "id", F.coalesce("root", "row").alias("root")), "ids")
    best = (ids.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("best"),
                                    F.count("*").alias("class_size")).filter("class_size > 1"))
    one = F.col("class_size").isNull()
    return ids.join(best, "root", "left").select(
        F.col("id").alias(id_column), F.when(one, F.col("id")).otherwise(F.col("best.id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        (one | (F.col("best.row") == F.col("row"))).alias("kept"), F.col("row"))


def near_duplicates(df: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """Per row of ``df``: its id, ``class_id`` (the least id of its class; its
    own if it is alone), ``class_size`` and ``kept`` (one row a class)."""
    narrow = df.select(F.col(id_column).alias("id"), F.col(column).alias("text"))
    return _named(C.numbered(narrow, "row"), id_column).drop("row")


def near_dedup(df: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """``df`` with one row of each class: the one of the least id."""
    row = C.free_name(df, "near_row")
    keyed = C.numbered(df, row)
    narrow = keyed.select(F.col(row).alias("row"), F.col(id_column).alias("id"), F.col(column).alias("text"))
    dropped = _named(narrow, "id").filter("not kept").select("row")
    return C.picked(keyed, row, dropped, inside=False).drop(row)


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.read(spark, sf_dir, "documents"))
