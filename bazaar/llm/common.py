"""Shared helpers of the corpus operators.

* ``read`` / ``keep``: read a table, write an intermediate to the shared
  checkpoint folder (the lineage cut of this package).
* ``Bytes``, ``word_spans``, ``Roller``: texts of an Arrow batch as one byte
  array, and vectorised rolling names (64-bit fingerprints) over it.
* ``to_blocks`` / ``exchange``: rows packed into blocks of a few MB, and one
  round in which every block asks the buckets of a distributed table about
  its own sorted distinct names.  A block sends a name once however often it
  holds it, so a name shared by a third of all rows costs a bucket one entry
  per block, and names are spread over buckets by value.
"""

from __future__ import annotations

import ctypes
import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

U64 = np.uint64
BLOCK_BYTES = 2 << 20
BATCH_BYTES = 4 << 20
SLICE = 1 << 16
SEED = 20240229
PICKED = 1 << 22  # longs of row numbers that are broadcast, 64 MB with their places


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of about ``BATCH_BYTES`` at most: a batch is held by the
    executor and by its Python worker at once, for every running task."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    size, unit = re.fullmatch(r"(\d+)\s*([kmg]?)b?", spark.conf.get(key).strip().lower()).groups()
    if int(size) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return os.path.join(scratch_path(spark, "corpus"), f"{name}-{uuid.uuid4().hex}")


def keep(df: DataFrame, name: str, by: str | None = None, **options: str) -> DataFrame:
    """Write to the shared checkpoint folder (in a folder for each value of
    the column ``by``) and read back: executors lost later do not cause
    recomputation of what led here."""
    spark = df.sparkSession
    bound_batches(spark)
    path = scratch(spark, name)
    writer = df.write.options(**options)
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number per row, written once and read from there: the
    same in every later reading, whatever executors come and go.  Tells apart
    repeated rows and rows with a null or repeated id."""
    return keep(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def picked(df: DataFrame, row: str, rows: DataFrame, inside: bool = True) -> DataFrame:
    """The rows of ``df`` whose number ``row`` is (``inside``) or is not among
    those of ``rows`` (a column ``row``; repeats do no harm).  The numbers are
    broadcast as a bit each, in longs for 64 rows of ``numbered``, so the texts
    of ``df`` do not move; beyond ``PICKED`` longs the engine chooses the join."""
    at, bits = free_name(df, "at"), free_name(df, "bits")
    bit = F.expr("shiftleft(1L, cast(row & 63 as int))")
    sets = keep(rows.select(F.shiftright("row", 6).alias(at), bit.alias(bits)).groupBy(at).agg(F.bit_or(bits).alias(bits)), "picked")
    found = df.withColumn(at, F.shiftright(row, 6)).join(
        F.broadcast(sets) if sets.count() <= PICKED else sets, at, "inner" if inside else "left")
    held = F.coalesce(F.getbit(F.col(bits), F.col(row).bitwiseAND(63).cast("int")), F.lit(0))
    return found.filter(held == int(inside)).drop(at, bits)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` clashes with it."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


# ---------------------------------------------------------------- texts

class Bytes:
    """The UTF-8 texts of a string array as one byte array (null: empty)."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
            if isinstance(column, pa.ChunkedArray):
                column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
        if column.null_count:
            column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
        column = column.cast(pa.large_binary())
        _, o, d = column.buffers()
        n = len(column)
        offs = np.frombuffer(o, np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = np.frombuffer(d, np.uint8) if d is not None and d.size else np.zeros(0, np.uint8)
        self.data = raw[offs[0]:offs[-1]]
        self.offs = offs - offs[0]
        self.lens = np.diff(self.offs)

    def __len__(self) -> int:
        return len(self.lens)

    def text(self, i: int) -> bytes:
        return self.data[self.offs[i]:self.offs[i + 1]].tobytes()


SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of the runs of ``[^\\x20\\x09-\\x0D]`` within each text."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    w = ~SPACE[data]
    first = np.empty(n, bool)
    first[0] = True
    np.logical_not(w[:-1], out=first[1:])
    cut = offs[1:-1]
    cut = cut[cut < n]
    first[cut] = True
    starts = np.flatnonzero(w & first)
    last = np.empty(n, bool)
    last[-1] = True
    np.logical_not(w[1:], out=last[:-1])
    last[cut[cut > 0] - 1] = True
    ends = np.flatnonzero(w & last) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: a bijection that spreads every input bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


_RNG = np.random.default_rng(SEED)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = U64(int(_RNG.integers(1, 2**60)) * 8 + 5)
_POWERS: list[np.ndarray] = [np.ones(1, U64)]


def powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n + 1:
        p = np.full(n + 1, BASE, U64)
        p[0] = 1
        _POWERS[0] = np.multiply.accumulate(p, out=p)
    return _POWERS[0]


class Roller:
    """Names of any substring of a byte array from one prefix sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.p, self.n = powers(n), n
        self.back = U64(pow(int(BASE), -n, 2**64))
        self.h = np.empty(n + 1, U64)
        self.h[0] = 0
        terms = BYTE_CODE[data]
        terms *= self.p[:n]
        np.cumsum(terms, out=self.h[1:])

    def names(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(start), U64)
        for i in range(0, len(start), SLICE):
            a, b = start[i:i + SLICE], end[i:i + SLICE]
            x = self.h[b]
            x -= self.h[a]
            x *= self.p[self.n - a]  # with ``back``: BASE to the power -a
            x *= self.back
            x += (b - a).astype(U64)
            out[i:i + SLICE] = mix(x)
        return out


def distinct_sample(df: DataFrame, column: str, each: int, label: str | None = None) -> DataFrame:
    """``column`` (and ``label``) of ``each`` different texts at most, for each
    label if given: those of the least hashes.  Copies of a text count once."""
    by, hashed = [label] if label else [], free_name(df, "hash")
    keyed = df.select(column, *by).withColumn(hashed, F.xxhash64(column))

    def below(most: dict) -> Column:
        if not label:
            return F.col(hashed) <= F.lit(most[None]).cast("long")
        pairs = [x for k, v in sorted(most.items()) for x in (F.lit(k), F.lit(v).cast("long"))]
        return F.col(hashed) <= F.create_map(*pairs)[F.col(label)]

    # about 2 * each hashes of a label go to the driver, which finds the bound from them
    most = {r[label] if label else None: min((1 << 63) - 1, int(2 * each / max(1, r["n"]) * 2.0 ** 64) - (1 << 63))
            for r in keyed.groupBy(*by).agg(F.approx_count_distinct(hashed).alias("n")).collect()}
    if not most:
        return keyed.drop(hashed)
    seen: dict = {k: [] for k in most}
    for r in keyed.filter(below(most)).select(*by, hashed).distinct().collect():
        seen[r[label] if label else None].append(r[hashed])
    bound = {k: sorted(x)[:each][-1] if x else most[k] for k, x in seen.items()}
    return keyed.filter(below(bound)).dropDuplicates([*by, hashed]).drop(hashed)


# ---------------------------------------------------------------- blocks

def release() -> None:
    """Give the freed memory of this Python worker back: workers are reused by
    every later stage, and what one block needed would else stay with them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; elsewhere freed memory stays
    if trim:
        trim(0)


def _pieces(batch: pa.RecordBatch, column: str, target: int) -> Iterator[pa.RecordBatch]:
    lens = Bytes(batch.column(column)).lens + 64
    ends = np.cumsum(lens)
    lo = 0
    while lo < len(lens):
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + target, side="right")))
        release()
        yield batch.slice(lo, hi - lo)
        lo = hi


def to_blocks(df: DataFrame, column: str, name: str, target: int = BLOCK_BYTES) -> DataFrame:
    """``df`` packed and written as rows (block long, batch binary): ``batch``
    is a compressed Arrow stream of consecutive rows with about ``target``
    bytes of ``column`` (one row at least)."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 1))
            table = pa.Table.from_batches(held).combine_chunks()
            with pa.ipc.new_stream(sink, table.schema, options=options) as w:
                w.write_table(table)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + seq], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                names=["block", "batch"])

        for batch in batches:
            for piece in _pieces(batch, column, target):
                held.append(piece)
                size += int(Bytes(piece.column(column)).lens.sum()) + 64 * len(piece)
                if size >= 0.75 * target:
                    yield flush()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield flush()

    return keep(df.mapInArrow(pack, "block long, batch binary"), name)


def open_block(payload: bytes) -> pa.Table:
    release()
    return pa.ipc.open_stream(payload).read_all().combine_chunks()


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as byte planes of their differences."""
    d = x.copy()
    d[1:] -= x[:-1]
    return d.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(b: bytes) -> np.ndarray:
    d = np.frombuffer(b, np.uint8).reshape(8, -1).T.copy().view(U64).ravel()
    return np.cumsum(d, dtype=U64)


def bucket_edges(names: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` equal ranges of the 64-bit space begins in sorted ``names``."""
    edges = np.array([(i << 64) // n for i in range(n)], U64)
    return np.append(np.searchsorted(names, edges), len(names))


def bucket_count(spark: SparkSession, blocks: DataFrame, per_byte: float, names_each: int = 1 << 20,
                 a_partition: int = 4) -> int:
    """Buckets of about ``names_each`` names for blocks whose texts hold
    ``per_byte`` names a stored byte; ``a_partition`` for each shuffle partition at least."""
    size = blocks.agg(F.sum(F.length("batch"))).first()[0] or 0
    return max(a_partition * parallelism(spark), int(size * per_byte / names_each) + 1)


def send(block: int, names: np.ndarray, n: int, extra: np.ndarray | None = None) -> pa.RecordBatch:
    """A block's ascending distinct names, one row for each bucket it has names in."""
    e = bucket_edges(names, n)
    full = np.flatnonzero(np.diff(e))
    cols = [pa.array(full, pa.int32()), pa.array(np.full(len(full), block), pa.int64()),
            pa.array([pack_sorted(names[e[k]:e[k + 1]]) for k in full], pa.binary()),
            pa.array([extra[e[k]:e[k + 1]].tobytes() if extra is not None else b"" for k in full], pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=["bucket", "block", "names", "extra"])


SENT = "bucket int, block long, names binary, extra binary"


def exchange(sent: DataFrame, answer: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """One bucket at a time: ``answer`` gets its rows from all blocks."""
    return sent.groupBy("bucket").applyInArrow(answer, schema)


def per_block(answers: DataFrame, name: str) -> DataFrame:
    """Answers (block, bucket, reply) gathered: one row a block, as many entries as buckets at most."""
    return answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "reply"))).alias(name))


def shared_names(table: pa.Table) -> pa.Table:
    """Answer of a bucket: a bit for each name sent, set if another block sent it too."""
    lists = [unpack_sorted(x.as_py()) for x in table.column("names")]
    every = np.sort(np.concatenate(lists))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    out = []
    for x in lists:
        at = np.minimum(np.searchsorted(twice, x), max(0, len(twice) - 1))
        hit = twice[at] == x if len(twice) else np.zeros(len(x), bool)
        out.append(np.packbits(hit).tobytes() if hit.any() else b"")
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                     "reply": pa.array(out, pa.binary())})


SHARED = "block long, bucket int, reply binary"


def spread(names: np.ndarray, n: int, replies: list[dict] | None, kind: str = "bits") -> np.ndarray:
    """A block's replies in the order of its ascending ``names``: bits, or
    numbers of the numpy type ``kind``."""
    out = np.zeros(len(names), bool if kind == "bits" else kind)
    e = bucket_edges(names, n)
    for r in replies or []:
        lo, hi = e[r["bucket"]], e[r["bucket"] + 1]
        if r["reply"]:
            out[lo:hi] = (np.unpackbits(np.frombuffer(r["reply"], np.uint8), count=hi - lo) if kind == "bits"
                          else np.frombuffer(r["reply"], kind))
    return out
