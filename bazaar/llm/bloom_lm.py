"""LM scoring with a log-frequency Bloom filter.

Tokens are lower-cased words and one end a document.  Bigram counts are
gathered over all training documents, quantised to steps of sqrt(2), and a
bigram of level q is stored as q keys (bigram, 1) .. (bigram, q); its count is
read back by probing level after level until one is missing.  Every training
bigram is stored, also those seen once: the filter has ``BITS_PER_KEY`` bits a
key and no largest size.  It is made and written in segments, one for each
bucket of the name order.  The workers get it by broadcast: whole where it
fits ``FILTER_BYTES``, else one range of names after the other, each of that
size at most; a pass probes the bigrams that lie in its range, and the levels
it reads go back to the blocks that hold them, where the texts are scored.

    P(w | h) = (q(h w) + MU * P0(w)) / (c(h) + MU)
    P0(w)    = (c(w) + 0.1) / (N + 0.1 (V + 1))

q: count read from the filter, c: exact counts.  As q never exceeds the count,
the sum over w is 1 at most but for false positives of the filter.

Scale: documents are packed into blocks of ``BLOCK_BYTES``; a block tells the
buckets once of each distinct word and bigram it holds, so no word, however
frequent, costs a bucket more than one entry a block.  A bucket stores its
distinct bigrams beside its segment, in folders of ``FOLDER`` buckets.  The
number of passes grows with the filter, by one for each ``FILTER_BYTES`` (some
45 million keys), but a pass reads the bigrams of its own range alone: all
passes together probe every distinct bigram once, and the texts are scored
once, however many passes there are.

Cases: a null or empty text is one end token; documents with a null id count
as training documents; repeated rows count as often as they occur; an empty
table gives an empty one; without training documents every c is 0.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

BITS_PER_KEY = 12
HASHES = 4
FILTER_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
FOLDER = 64  # buckets whose bigrams are stored in one folder
STEP = 2 ** 0.5
MU = 4.0
ALPHA = 0.1
END, START = C.U64(0x1F83D9ABFB41BD6B), C.U64(0x5BE0CD19137E2179)


def _tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, document index, name of the token before) of a block, an end after each text."""
    texts = C.Bytes(table.column("text"))
    data = C.LOWER[texts.data]
    starts, ends, text = C.word_spans(data, texts.offs)
    words = C.Roller(data).names(starts, ends)
    n = np.bincount(text, minlength=len(texts))
    doc = np.repeat(np.arange(len(texts)), n + 1)
    last = np.cumsum(n + 1) - 1
    names = np.full(len(doc), END)
    inner = np.ones(len(doc), bool)
    inner[last] = False
    names[inner] = words
    before = np.empty_like(names)
    before[1:] = names[:-1]
    before[last[:-1] + 1] = START
    before[:1] = START
    return names, doc, before


def _pairs(before: np.ndarray, names: np.ndarray) -> np.ndarray:
    return C.mix(before * C.U64(0xC2B2AE3D27D4EB4F) + names)


def _parts(table: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """A block's rows in pieces, each with its ``_tokens``."""
    for piece in C._pieces(table, "text", C.BLOCK_BYTES):
        yield piece, *_tokens(piece)


def _runs(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct names ascending, and how often each occurs."""
    s = np.sort(names)
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1])[:len(s)])
    return s[first], np.diff(np.append(first, len(s)))


def _inverse(names: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct names ascending, and the place among them of each name."""
    every = np.concatenate(names)
    order = np.argsort(every)
    s = every[order]
    new = np.append(True, s[1:] != s[:-1])[:len(s)]
    place = np.empty(len(s), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return s[new], place


def _training(names: list[np.ndarray], train: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct names ascending, and how often each occurs in training documents."""
    every, count = _runs(np.concatenate(names))
    held, n = _runs(np.concatenate([x[~t] for x, t in zip(names, train)]))
    count[np.searchsorted(every, held)] -= n
    return every, count.astype(np.uint32)


def _planes(x: np.ndarray) -> bytes:
    return x.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.uint8).reshape(8, -1).T.copy().view(np.int64).ravel()


def _stored(x: np.ndarray) -> bytes:
    """64-bit numbers, mostly ascending, compressed, behind how many they are."""
    return len(x).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(C.pack_sorted(x.view(C.U64)), asbytes=True)


def _restored(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return C.unpack_sorted(pa.Codec("zstd", 1).decompress(b[8:], 8 * n, asbytes=True))


def _totals(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of names of each block, the distinct names ascending, their
    summed counts, place among these of each name in the order of the blocks)."""
    lists = [C.unpack_sorted(x.as_py()) for x in table.column("names")]
    count = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table.column("extra")])
    names = np.concatenate(lists)
    order = np.argsort(names, kind="stable")
    s = names[order]
    new = np.append(True, s[1:] != s[:-1])
    first, place = np.flatnonzero(new), np.empty(len(s), np.int64)
    place[order] = np.cumsum(new) - 1
    return np.array([len(x) for x in lists]), s[first], np.add.reduceat(count[order].astype(np.int64), first), place


def levels(count: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(count) / np.log(STEP) + 1e-9).astype(np.int64)


def quantised(level: np.ndarray) -> np.ndarray:
    """The count that each level stands for, 0 for level 0."""
    return np.where(level > 0, np.floor(STEP ** (level - 1.0) + 1e-6), 0.0)


def _place(names: np.ndarray, level: int, i: int, bits: np.ndarray | int) -> np.ndarray:
    """The bit of hash ``i`` for (name, level) within the name's segment of ``bits`` bits."""
    salt = C.mix(np.array([level * HASHES + i + 1], C.U64))
    return (C.mix(names + salt) % np.asarray(bits, C.U64)).astype(np.int64)


class LogBloom:
    """Some segments of the filter, by bucket of the name order."""

    def __init__(self, segments: dict[int, bytes], buckets: int):
        self.bits, self.base = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        at = 0
        for k, b in sorted(segments.items()):
            self.bits[k], self.base[k], at = 8 * len(b), at, at + 8 * len(b)
        self.table = np.frombuffer(b"".join(b for _, b in sorted(segments.items())), np.uint8)
        self.edges = np.array([(i << 64) // buckets for i in range(buckets)], C.U64)

    @staticmethod
    def segment(names: np.ndarray, level: np.ndarray) -> bytes:
        """The filter of the names of one bucket."""
        bits = max(64, -(-int(level.sum()) * BITS_PER_KEY // 64) * 64)
        table = np.zeros(bits, bool)
        for j in range(1, int(level.max(initial=0)) + 1):
            for i in range(HASHES):
                table[_place(names[level >= j], j, i, bits)] = True
        return np.packbits(table, bitorder="little").tobytes()

    def levels(self, names: np.ndarray) -> np.ndarray:
        """The level of each name, 0 if unknown, by repeated probes."""
        bucket = np.searchsorted(self.edges, names, side="right") - 1
        bits, base = self.bits[bucket], self.base[bucket]
        level = np.zeros(len(names), np.int64)
        alive = np.flatnonzero(bits)
        j = 1
        while len(alive):
            for i in range(HASHES):
                at = _place(names[alive], j, i, bits[alive]) + base[alive]
                alive = alive[(self.table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
            level[alive] = j
            j += 1
        return level

    def counts(self, names: np.ndarray) -> np.ndarray:
        """The quantised count of each name, 0 if unknown."""
        return quantised(self.levels(names))


def filter_segments(blocks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, segment, folder, names, blocks, sizes, places), a row a bucket:
    the filter of all training bigrams, the distinct bigrams of all texts, and
    for each block that holds some how many and their places among them."""
    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column("block"), batch.column("batch")):
                pairs, train = [], []
                for piece, names, doc, before in _parts(C.open_block(payload.as_py())):
                    pairs.append(_pairs(before, names))
                    train.append(~np.asarray(piece.column("held_out"))[doc])
                u, n = _training(pairs, train)
                yield C.send(block.as_py(), u, buckets, n)

    def build(table: pa.Table) -> pa.Table:
        sizes, names, total, place = _totals(table)
        bucket, stored = table.column("bucket")[0].as_py(), total > 0
        return pa.table({
            "bucket": pa.array([bucket], pa.int32()), "segment": [LogBloom.segment(names[stored], levels(total[stored]))],
            "folder": pa.array([bucket // FOLDER], pa.int32()), "names": [_stored(names)],
            "blocks": [_stored(np.asarray(table.column("block")))], "sizes": [_stored(sizes)], "places": [_stored(place)]})

    return C.keep(C.exchange(blocks.mapInArrow(gather, C.SENT), build, "bucket int, segment binary, folder int, "
                             "names binary, blocks binary, sizes binary, places binary"), "bigrams", "folder", compression="none")


def name_ranges(segments: DataFrame, most: int) -> list[tuple[int, int]]:
    """(first, last) buckets of the ranges that are broadcast: ``most`` bytes
    of segments each, or one segment."""
    sizes = sorted((r.bucket, r.size) for r in segments.select("bucket", F.length("segment").alias("size")).collect())
    out, held = [], 0
    for bucket, size in sizes:
        if out and held + size <= most:
            out[-1], held = (out[-1][0], bucket), held + size
        else:
            out, held = [*out, (bucket, bucket)], size
    return out


def probed(segments: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, reply): for each block the levels of its ascending
    distinct bigrams, read from the filter as it is broadcast range by range."""
    spark = segments.sparkSession
    path = C.scratch(spark, "levels")
    for lo, hi in name_ranges(segments, FILTER_BYTES) or [(0, buckets - 1)]:
        here = segments.filter(F.col("folder").between(lo // FOLDER, hi // FOLDER) & F.col("bucket").between(lo, hi))
        probes = spark.sparkContext.broadcast(
            LogBloom({r.bucket: bytes(r.segment) for r in here.select("bucket", "segment").collect()}, buckets))
        here.select("bucket", "names", "blocks", "sizes", "places").mapInArrow(_prober(probes), C.SHARED).write.mode("append").parquet(path)
        probes.destroy()
        del probes  # else the driver holds it beside the next range
    return spark.read.schema(C.SHARED).parquet(path)


def _prober(probes):
    """Probes the broadcast segments for the bigrams of their buckets."""

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom: LogBloom = probes.value
        for batch in batches:
            for bucket, names, blocks, sizes, places in zip(*map(batch.column, ("bucket", "names", "blocks", "sizes", "places"))):
                C.release()
                level = np.minimum(bloom.levels(_restored(names.as_py())), 255).astype(np.uint8)
                blocks, sizes, places = (_restored(x.as_py()).view(np.int64) for x in (blocks, sizes, places))
                reply, ends = level[places], np.append(0, np.cumsum(sizes)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks), pa.array(np.full(len(blocks), bucket.as_py(), np.int32)),
                     pa.Array.from_buffers(pa.binary(), len(blocks), [None, pa.py_buffer(ends), pa.py_buffer(reply)])],
                    names=["block", "bucket", "reply"])

    return probe


SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def lm_scores(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, held_out): log10 probabilities of its text."""
    spark = docs.sparkSession
    blocks = C.to_blocks(docs.select("doc_id", "text", "held_out"), "text", "lm-blocks", BLOCK_BYTES)
    buckets, word_buckets = C.bucket_count(spark, blocks, 0.5), C.bucket_count(spark, blocks, 0.1, a_partition=1)
    levels_read = probed(filter_segments(blocks, buckets), buckets)

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column("block"), batch.column("batch")):
                words, train = [], []
                for piece, names, doc, _ in _parts(C.open_block(payload.as_py())):
                    words.append(names)
                    train.append(~np.asarray(piece.column("held_out"))[doc])
                u, n = _training(words, train)
                yield C.send(block.as_py(), u, word_buckets, n)

    def answer(table: pa.Table) -> pa.Table:
        sizes, names, total, place = _totals(table)
        out = [_planes(x) for x in np.split(total[place], np.cumsum(sizes)[:-1])]
        new = np.zeros((2, len(out)), np.int64)
        new[:, 0] = (total > 0).sum(), total.sum()
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "reply": pa.array(out, pa.binary()),
                         "distinct": new[0], "tokens": new[1]})

    answers = C.keep(C.exchange(blocks.mapInArrow(ask, C.SENT), answer, C.SHARED + ", distinct long, tokens long"), "counts")
    v, n = (x or 0 for x in answers.agg(F.sum("distinct"), F.sum("tokens")).first())

    asked = (blocks.join(C.per_block(answers.select("block", "bucket", "reply"), "counts"), "block", "left")
             .join(C.per_block(levels_read, "levels"), "block", "left").select("batch", "counts", "levels"))
    return C.keep(asked.mapInArrow(_scorer(buckets, word_buckets, n, v), SCORED), "scores")


def _scorer(buckets: int, word_buckets: int, n: int, v: int):
    """Scores blocks (batch, counts, levels): the counts of their distinct
    words and the levels of their distinct bigrams, by bucket."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, replies, found in zip(*map(batch.column, ("batch", "counts", "levels"))):
                parts = [(piece, doc, before == START, names, _pairs(before, names))
                         for piece, names, doc, before in _parts(C.open_block(payload.as_py()))]
                u, word = _inverse([x[3] for x in parts])
                e, got = C.bucket_edges(u, word_buckets), np.zeros(len(u), np.int64)
                for r in replies.as_py() or []:
                    got[e[r["bucket"]]:e[r["bucket"] + 1]] = _unplanes(r["reply"])
                starts = got[np.searchsorted(u, END)]  # as many beginnings as ends
                pairs, pair = _inverse([x[4] for x in parts])
                level, at = C.spread(pairs, buckets, found.as_py(), "uint8"), 0
                parts = [x[:3] for x in parts]
                for piece, doc, first in parts:
                    here, m = slice(at, at := at + len(doc)), piece.num_rows
                    c, q = got[word[here]], quantised(level[pair[here]].astype(np.int64))
                    ch = np.where(first, starts, np.append(0, c[:-1]))
                    p0 = (c + ALPHA) / (n + ALPHA * (v + 1))
                    p = np.minimum((q + MU * p0) / (ch + MU), 1.0)
                    total = lambda x: pa.array(np.bincount(doc, weights=x, minlength=m))  # noqa: B023, E731
                    count = lambda x: pa.array(np.bincount(doc, weights=x, minlength=m).astype(np.int64))  # noqa: B023, E731
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("doc_id").combine_chunks().cast(pa.int64()), piece.column("held_out").combine_chunks(),
                         count(np.ones(len(doc))), count(c > 0), pa.array(np.full(m, n), pa.int64()),
                         total(np.log10(p0)), total(np.log10(p))],
                        names=[f.split()[0] for f in SCORED.split(", ")])

    return score


def op3_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    return lm_scores(C.read(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held_out")))
