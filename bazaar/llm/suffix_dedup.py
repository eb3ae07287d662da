"""Suffix-array dedup: remove every byte covered by a string of ``length``
bytes that starts anywhere else, in another text or in the same one.

Difference-cover blockwise search.  With a cover D modulo v, any two text
positions i, j have a shift d < v such that i + d and j + d are both cover
positions.  So:

1. *Cover sample.*  The cover positions (7.7 % of all for 400 bytes: v = 183,
   |D| = 14) are named by their next ``length - v + 1`` bytes; one bucket of the
   name order at a time, names that occur twice are found.
2. *Long ties.*  A suffix can tie with another over ``length`` bytes only if
   a cover position less than v bytes on ties as well; every other suffix is
   settled there and never named.
3. *Suffix buckets.*  The remaining suffixes are compared, one bucket at a
   time, by the name of their first ``length`` bytes; equal names are repeats.

This is not the dealt construction to the letter: the cover sample is not
ranked and suffixes are not sorted, since equality over ``length`` bytes, all
that removal needs, does not ask for the order of unequal suffixes.  Names are
64-bit fingerprints in place of the strings (about N^2 / 2^65 false matches among
N names), so a bucket holds 8 bytes a suffix.  Texts stay in their blocks;
only names move, as sorted differences, and a bit for each comes back.

Cases: null text counts as empty; a text shorter than ``length`` keeps all;
strings are judged on the input, overlaps count and matches never cross
texts; repeated rows are separate texts and repeat each other; an empty
table gives an empty one; other columns stay as they are.  Bytes are cut
without regard to UTF-8 borders: a removed run may begin or end within a
character, so ``text`` drops the broken ends of characters, while the
digest columns of ``removed_digest`` count raw bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import common as C

LENGTH = 400


def difference_cover(limit: int) -> tuple[int, np.ndarray]:
    """Largest v = q*q + q + 1 <= ``limit`` (q prime) and a perfect cover of
    q + 1 residues: the exponents at which the powers of a generator of
    GF(q^3) fall into a plane.  (1, [0]) below 7."""
    for q in (p for p in range(int(limit ** 0.5) + 1, 1, -1) if all(p % d for d in range(2, p))):
        v = q * q + q + 1
        if v > limit:
            continue
        for a in range(q):
            for b in range(q):
                for c in range(1, q):
                    x, at = (0, 1, 0), [0]  # powers of t modulo t^3 = a t^2 + b t + c, as (t^2, t, 1)
                    for k in range(1, v):
                        if x[0] == 0:
                            at.append(k)
                        x = ((x[1] + a * x[0]) % q, (x[2] + b * x[0]) % q, c * x[0] % q)
                    if len(at) == q + 1 and len({(i - j) % v for i in at for j in at}) == v:
                        return v, np.array(at)
    return 1, np.array([0])


def _sample(texts: C.Bytes, v: int, cover: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Cover positions with ``width`` bytes ahead of them in their text, ascending, and their texts' starts."""
    room = np.maximum(texts.lens - width + 1, 0)
    periods = -(-room // v)
    text = np.repeat(np.arange(len(texts)), periods)
    nth = np.arange(len(text)) - (np.cumsum(periods) - periods)[text]
    within = ((nth * v)[:, None] + cover).ravel()
    text = np.repeat(text, len(cover))
    fits = within < room[text]
    starts = texts.offs[:-1][text[fits]]
    return starts + within[fits], starts


def _distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending distinct names, each position's place among them, and which occur twice here."""
    u, inverse, count = np.unique(names, return_inverse=True, return_counts=True)
    return u, inverse, count > 1


def _covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A mark for each of ``n`` positions that one of the ranges covers."""
    mark = np.zeros(n + 1, np.int32)
    for at, by in ((starts, 1), (ends, -1)):
        at, times = np.unique(at, return_counts=True)
        mark[at] += by * times.astype(np.int32)
    return np.cumsum(mark, out=mark)[:n] > 0


def _candidates(texts: C.Bytes, tied: np.ndarray, starts: np.ndarray, v: int, length: int) -> np.ndarray:
    """Positions with ``length`` bytes ahead and a tied cover position
    (``starts``: of its text) less than v bytes on."""
    n = len(texts.data)
    near = _covered(n, np.maximum(tied - v + 1, starts), tied + 1)
    lo, hi = texts.offs[:-1], texts.offs[1:]
    return np.flatnonzero(near & ~_covered(n, np.maximum(hi - length + 1, lo), hi))


class _Plan:
    """What every pass over a block needs; small and sent with the tasks."""

    def __init__(self, column: str, length: int, buckets: int):
        self.column, self.length, self.buckets = column, length, buckets
        self.v, self.cover = difference_cover(max(1, length // 2))
        self.width = length - self.v + 1

    def sample(self, table: pa.Table):
        texts = C.Bytes(table.column(self.column))
        roller = C.Roller(texts.data)
        at, starts = _sample(texts, self.v, self.cover, self.width)
        return texts, roller, at, starts, _distinct(roller.names(at, at + self.width))

    def suffixes(self, table: pa.Table, ranks: list[dict]):
        texts, roller, at, starts, (u, inverse, here) = self.sample(table)
        tied = (here | C.spread(u, self.buckets, ranks))[inverse]
        at = _candidates(texts, at[tied], starts[tied], self.v, self.length)
        return texts, at, _distinct(roller.names(at, at + self.length))

    def removed(self, table: pa.Table, ranks: list[dict], ties: list[dict]) -> tuple[C.Bytes, np.ndarray]:
        """The block's texts and a mark for each byte to remove."""
        texts, at, (u, inverse, here) = self.suffixes(table, ranks)
        at = at[(here | C.spread(u, self.buckets, ties))[inverse]]
        return texts, _covered(len(texts.data), at, at + self.length)


def _removal(df: DataFrame, column: str, length: int, finish, schema: T.StructType | str) -> DataFrame:
    """``finish(table, texts, removed)`` over every block of ``df``, with the bytes to remove."""
    spark = df.sparkSession
    blocks = C.to_blocks(df, column, "suffix-blocks")
    plan = _Plan(column, length, 0)
    plan.buckets = C.bucket_count(spark, blocks, 3 * len(plan.cover) / plan.v)

    def sample_names(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column("block"), batch.column("batch")):
                u, _, _ = plan.sample(C.open_block(payload.as_py()))[-1]
                yield C.send(block.as_py(), u, plan.buckets)

    def suffix_names(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload, ranks in zip(batch.column("block"), batch.column("batch"), batch.column("ranks")):
                u, _, _ = plan.suffixes(C.open_block(payload.as_py()), ranks.as_py())[-1]
                yield C.send(block.as_py(), u, plan.buckets)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, ranks, ties in zip(batch.column("batch"), batch.column("ranks"), batch.column("ties")):
                table = C.open_block(payload.as_py())
                yield from finish(table, *plan.removed(table, ranks.as_py(), ties.as_py())).to_batches()

    ranks = C.exchange(blocks.mapInArrow(sample_names, C.SENT), C.shared_names, C.SHARED)
    ranked = blocks.join(C.keep(C.per_block(ranks, "ranks"), "suffix-ranks"), "block", "left")
    ties = C.exchange(ranked.mapInArrow(suffix_names, C.SENT), C.shared_names, C.SHARED)
    return ranked.join(C.per_block(ties, "ties"), "block", "left").mapInArrow(cut, schema)


def suffix_dedup(df: DataFrame, column: str = "text", length: int = LENGTH, count: str | None = "n_chars") -> DataFrame:
    """``df`` with the repeated bytes cut out of ``column`` (null stays null);
    ``count``, where such a column exists, gets the new number of characters."""
    names = df.columns
    kind = df.schema[count].dataType if count in names else None

    def finish(table: pa.Table, texts: C.Bytes, removed: np.ndarray) -> pa.Table:
        out = []
        for i, valid in enumerate(table.column(column).is_valid().to_pylist()):
            lo, hi = texts.offs[i], texts.offs[i + 1]
            cut = removed[lo:hi]
            out.append((texts.data[lo:hi][~cut] if cut.any() else texts.data[lo:hi]).tobytes().decode("utf-8", "ignore")
                       if valid else None)
        table = table.set_column(names.index(column), column, pa.array(out, pa.string()))
        if kind is not None:
            k = names.index(count)
            old = table.column(k)
            new = [len(t) if t is not None else o for t, o in zip(out, old.to_pylist())]
            table = table.set_column(k, count, pa.array(new, old.type))
        return table

    return _removal(df, column, length, finish, df.schema)


DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def removed_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): what ``suffix_dedup`` removes, in raw bytes."""

    def finish(table: pa.Table, texts: C.Bytes, removed: np.ndarray) -> pa.Table:
        gone, spans, sha = [], [], []
        for i in range(len(texts)):
            lo, hi = texts.offs[i], texts.offs[i + 1]
            cut, data = removed[lo:hi], texts.data[lo:hi]
            gone.append(int(cut.sum()))
            spans.append(int((cut[1:] & ~cut[:-1]).sum() + cut[0]) if gone[-1] else 0)
            sha.append(hashlib.sha256((data[~cut] if gone[-1] else data).tobytes()).hexdigest())
        return pa.table({"doc_id": table.column("doc_id").cast(pa.int64()), "n_bytes": pa.array(texts.lens, pa.int64()),
                         "n_removed": pa.array(gone, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
                         "kept_sha256": pa.array(sha, pa.string())})

    return _removal(docs.select("doc_id", "text"), "text", length, finish, DIGEST)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_digest(C.read(spark, sf_dir, "documents"))
