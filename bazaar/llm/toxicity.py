"""Toxicity by compression distance.

Two zstandard dictionaries are made from a bounded sample of labelled
documents: one of ordinary text, and one of the same ordinary text together
with passages that mark toxic documents.  Every window of a text (about
``WINDOW`` bytes, cut at white space) is compressed with either one; where the
toxic dictionary makes it shorter, the window is closer to toxic text.  A
text's greatest gain and its sum of gains over all windows go through a
logistic curve calibrated on the sample, so that 0.5 is the threshold.

Toxic passages: a label holds for a whole document, most of which is ordinary
prose.  The words with their neighbours whose distinct contexts lie mostly in
toxic documents (log odds over ``ODDS``; ``CONTEXTS`` contexts at least, and
one for 150 toxic documents of the sample) are the ones taken; counting contexts, not occurrences, keeps copied documents
from marking their own words.  The dictionaries share their ordinary part at
equal distance from the window, so ordinary text compresses alike with both.

Sample: ``SAMPLE`` toxic and twice as many ordinary documents, picked by hash,
none over ``LONGEST`` characters (longer ones are scored, not learned from).

Cases: null and empty texts have no window and get the score of no gain;
repeated rows get equal scores; repeated labels of a document count as toxic
if any does; labels of null are left out; with labels of one kind only, or
none, every score is the share of toxic labels (0 without any); an empty table
gives an empty one; other columns do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SAMPLE = 1500
LONGEST = 200_000
WINDOW = 64
REACH = 32
LEVEL = 6
ORDINARY = 40_000
TOXIC = 12_000
ODDS = 4.0
CONTEXTS = 4
PIECE = 1 << 20


def windows(texts: C.Bytes, data: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index): about ``width`` bytes each, cut before white space where some is near."""
    n = -(-texts.lens // width)
    text = np.repeat(np.arange(len(texts)), n)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    start = texts.offs[:-1][text] + nth * width
    space = np.append(np.flatnonzero(C.SPACE[data]), len(data) + 2 * REACH)
    gap = space[np.searchsorted(space, start)]
    start = np.where((nth > 0) & (gap - start <= REACH), gap, start)
    start = np.minimum(start, texts.offs[1:][text])
    end = np.append(start[1:], len(data))
    end = np.where(np.append(text[1:] != text[:-1], True), texts.offs[1:][text], end) if len(text) else end[:0]
    some = end > start
    return start[some], end[some], text[some]


class Compressors:
    def __init__(self, toxic: bytes, ordinary: bytes):
        import zstandard as zs

        self.zs = zs
        plain = zs.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.pair = [zs.ZstdCompressor(dict_data=zs.ZstdCompressionDict(d, dict_type=zs.DICT_TYPE_RAWCONTENT),
                                       compression_params=plain) for d in (ordinary, toxic + ordinary)]

    def gains(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Bytes by which the toxic dictionary compresses each window better."""
        if not len(start):
            return np.zeros(0)
        held = self.zs.BufferWithSegments(data.tobytes(), np.stack([start, end - start], 1).astype(np.uint64).tobytes())
        size = []
        for z in self.pair:
            out = z.multi_compress_to_buffer(held, threads=1)
            size.append(np.fromiter((len(out[i]) for i in range(len(out))), np.int64, len(out)))
        return (size[0] - size[1]).astype(float)

    def features(self, column: pa.Array) -> np.ndarray:
        """Greatest gain and sum of gains of each text."""
        texts = C.Bytes(column)
        data = C.LOWER[texts.data]
        start, end, text = windows(texts, data)
        gain = np.maximum(self.gains(data, start, end), 0)
        most = np.zeros(len(texts))
        np.maximum.at(most, text, gain)
        total = np.bincount(text, weights=np.maximum(gain - 1, 0), minlength=len(texts))
        return np.stack([np.minimum(most, 12), np.log1p(total)], 1)


def _lower(text: str) -> bytes:
    return text.encode().translate(bytes(C.LOWER))


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """(toxic passages, ordinary text)."""

    def contexts(texts: list[str]) -> Counter:
        seen = set()
        for t in dict.fromkeys(texts):
            w = [x.strip(b".,;:!?\"'()") for x in _lower(t).split()]
            seen.update(zip([b"", *w], w, [*w[1:], b""]))
        return Counter(x for _, x, _ in seen if x)

    bad, good = contexts(toxic), contexts(ordinary)
    bad_total, good_total = max(1, bad.total()), max(1, good.total())
    least = max(CONTEXTS, len(toxic) / 150)
    lean = {w: n for w, n in bad.items() if n >= least
            and np.log((n + 0.5) / bad_total) - np.log((good[w] + 0.5) / good_total) > ODDS}
    marks = b"".join(b" " + w + b" " for w in sorted(lean, key=lambda w: (lean[w], w)))[-TOXIC:]  # the surest last
    rng = np.random.default_rng(C.SEED + 9)
    pieces, size = [], 0
    texts = [_lower(t) for t in dict.fromkeys(ordinary) if t]
    for i in rng.permutation(len(texts) * 8) if texts else []:
        t = texts[i % len(texts)]
        lo = int(rng.integers(0, max(1, len(t) - WINDOW)))
        pieces.append(t[lo:lo + WINDOW])
        size += WINDOW
        if size >= ORDINARY:
            break
    return marks, b" ".join(pieces)[:ORDINARY] or b" " * 8


def _calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, weakly held to 0."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hold = 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + hold, a.T @ (p - y) + 1e-2 * w)
    return w


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    marked = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    count = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = count.get(1, 0) / max(1, sum(count.values()))
    if len(count) < 2:
        return None, share
    chance = F.pmod(F.xxhash64(F.lit(C.SEED), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    rate = F.when(F.col("toxic") == 1, F.lit(sample / count[1])).otherwise(F.lit(2 * sample / count[0]))
    chosen = marked.filter(chance < rate).limit(4 * sample)  # expected 3 x sample: a proven size
    rows = (docs.select("doc_id", "text").filter(F.length("text").between(1, LONGEST))
            .join(F.broadcast(chosen), "doc_id").limit(8 * sample).collect())
    rows.sort(key=lambda r: (r.doc_id, r.text))
    toxic, ordinary = ([r.text for r in rows if r.toxic == k] for k in (1, 0))
    if not toxic or not ordinary:
        return None, share
    marks, plain = dictionaries(toxic, ordinary)
    x = Compressors(marks, plain).features(pa.array([r.text for r in rows], pa.string()))
    y = np.array([r.toxic for r in rows], float)
    w = _calibrate(x, y)
    odds = count[1] / count[0] / (y.sum() / (1 - y).sum())  # back from the sample's share to the labels'
    w[-1] += np.log(odds)
    return (marks, plain, w), share


def scores(docs: DataFrame, model, id_columns: list[str], column: str = "text") -> DataFrame:
    """The ``id_columns`` of ``docs`` with ``score`` and ``predicted``."""
    C.bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in id_columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned, share = shared.value
        pair = Compressors(*learned[:2]) if learned else None
        for whole in batches:
            for batch in C._pieces(whole, column, PIECE):
                if pair:
                    x = pair.features(batch.column(column))
                    p = 1 / (1 + np.exp(-np.clip(x @ learned[2][:-1] + learned[2][-1], -500, 500)))
                else:
                    p = np.full(len(batch), share)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in id_columns], pa.array(p),
                                                  pa.array((p >= 0.5).astype(np.int32))],
                                                 names=[*id_columns, "score", "predicted"])

    return docs.select(*id_columns, column).mapInArrow(run, f"{kinds}, score double, predicted int")


def op9_zstd_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.crc32(F.col("doc_id").cast("string")) % 5
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(slot == 0, F.lit(False)).alias("held_out"))
    labels = C.read(spark, sf_dir, "labels").filter(slot != 0)
    return scores(docs, train(docs, labels), ["doc_id", "held_out"])
