"""Language ID by a string kernel.

The kernel of two texts is the number of byte n-grams (1 to ``MOST_N``, of
letters and spaces, hashed to ``DIMS`` cells) present in both, over the
geometric mean of their own numbers: a blended-spectrum presence kernel.
``LANDMARKS`` training windows serve as Nystroem landmarks; one-versus-rest
kernel ridge regression is solved in their span.  Since the kernel is a
product of presence vectors, landmarks and weights fold into one matrix, and a
batch of windows is scored by one matrix product.  A text is scored in windows
of ``WINDOW`` bytes over its whole length; the windows' scores are averaged
by their number of letters.

Training rows are a bounded sample: ``PER_LANGUAGE`` different texts of each
language, those of the least hashes, two windows of each: the first and the middle one of the whole
text.

Cases: a null text, or one without a letter, gets ``und`` and score 0; ties go
to the first language by name; repeated rows get equal results; null ids never
train; nothing to train on gives ``und`` everywhere; an empty table gives an
empty one; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

DIMS = 1 << 13
MOST_N = 3
WINDOW = 1000
LANDMARKS = 160
PER_LANGUAGE = 400
RIDGE = 1e-3
PIECE = 1 << 20
UNKNOWN = "und"

IN_GRAM = np.zeros(256, bool)
IN_GRAM[97:123] = IN_GRAM[128:] = IN_GRAM[32] = True


def windows(texts: C.Bytes, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of consecutive windows, one at least for every text with bytes."""
    n = -(-texts.lens // width)
    text = np.repeat(np.arange(len(texts)), n)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    start = texts.offs[:-1][text] + nth * width
    return start, np.minimum(start + width, texts.offs[1:][text]), text


def presence(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Windows by cells: 1 where an n-gram of the window falls."""
    size = end - start
    row = np.repeat(np.arange(len(start)), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + start[row]
    own = data[at]
    out = np.zeros((len(start), DIMS), bool)
    flat = out.reshape(-1)
    ok, code = IN_GRAM[own], own.astype(np.uint32)
    for n in range(1, MOST_N + 1):
        if n > 1:  # one more byte, if it is of the same window
            ok = ok[:-1] & IN_GRAM[own[n - 1:]] & (row[:len(ok) - 1] == row[n - 1:])
            code = code[:-1] * np.uint32(257) + own[n - 1:]
        h = (code[ok] + np.uint32(n * 0x3C6EF37)) * np.uint32(2654435761)
        flat[row[:len(ok)][ok] * DIMS + (h >> np.uint32(19)).astype(np.int64)] = True
    return out


def _normal(p: np.ndarray) -> np.ndarray:
    x = p.astype(np.float32)
    return x / np.sqrt(np.maximum(p.sum(1, dtype=np.float32), 1))[:, None]


def two_windows(texts: C.Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of the first and the middle window of each text."""
    start, end, text = windows(texts)
    place = np.arange(len(text)) - np.searchsorted(text, text)
    count = np.bincount(text, minlength=len(texts))[text]
    use = (place == 0) | (place == count // 2)
    return start[use], end[use], text[use]


def fit(parts: list[bytes], langs: list[str]) -> tuple[list[str], np.ndarray]:
    """(languages, cells by languages): the folded ridge solution for windows and their languages."""
    names = sorted(set(langs))
    size = np.array([len(b) for b in parts])
    data = C.LOWER[np.frombuffer(b"".join(parts), np.uint8)]
    x = _normal(presence(data, np.cumsum(size) - size, np.cumsum(size)))
    lang = np.array(langs)
    y = np.where(lang[:, None] == np.array(names)[None, :], 1.0, -1.0)
    rng = np.random.default_rng(C.SEED + 8)
    each = max(1, LANDMARKS // len(names))
    marks = np.concatenate([rng.permutation(np.flatnonzero(lang == k))[:each] for k in names])
    landmarks = x[marks]
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    sound = values > 1e-6 * values.max()
    half = vectors[:, sound] / np.sqrt(values[sound])  # K_mm to the power -1/2 on its sound part
    z = (x @ landmarks.T).astype(np.float64) @ half
    # classes count alike, however many windows each has
    weight = 1 / np.bincount(np.searchsorted(names, lang), minlength=len(names))[np.searchsorted(names, lang)]
    w = np.linalg.solve(z.T @ (z * weight[:, None]) + RIDGE * np.eye(z.shape[1]), z.T @ (y * weight[:, None]))
    return names, (landmarks.T @ (half @ w)).astype(np.float32)


def train(df: DataFrame, column: str = "text", label: str = "lang", per_language: int = PER_LANGUAGE):
    """A model from the rows of ``df`` with text and label; None without any."""
    known = df.select(F.col(column).alias("text"), F.col(label).cast("string").alias("lang")).filter(
        F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = C.Bytes(batch.column("text"))
            start, end, text = two_windows(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([texts.data[s:e].tobytes() for s, e in zip(start, end)], pa.binary()),
                 batch.column("lang").take(pa.array(text))], names=["part", "lang"])

    C.bound_batches(df.sparkSession)
    rows = sorted((bytes(r.part), r.lang) for r in C.distinct_sample(known, "text", per_language, "lang")
                  .mapInArrow(cut, "part binary, lang string").collect())
    return fit([b for b, _ in rows], [k for _, k in rows]) if rows else None


def predict(df: DataFrame, model, id_columns: list[str], column: str = "text") -> DataFrame:
    """The ``id_columns`` of ``df`` with ``lang_pred`` and ``score``."""
    C.bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in id_columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights = shared.value or ([UNKNOWN], np.zeros((DIMS, 1), np.float32))
        for whole in batches:
            for batch in C._pieces(whole, column, PIECE):
                texts = C.Bytes(batch.column(column))
                data = C.LOWER[texts.data]
                start, end, text = windows(texts)
                letters = np.append(0, np.cumsum(IN_GRAM[data] & (data != 32)))
                total = np.zeros((len(texts), len(names)))
                for lo in range(0, len(start), 512):
                    s, e, t = start[lo:lo + 512], end[lo:lo + 512], text[lo:lo + 512]
                    p = presence(data, s, e)
                    f = (p.astype(np.float32) @ weights) / np.sqrt(np.maximum(p.sum(1), 1))[:, None]
                    np.add.at(total, t, f * (letters[e] - letters[s])[:, None])
                n = letters[texts.offs[1:]] - letters[texts.offs[:-1]]
                total /= np.maximum(n, 1)[:, None]
                best = total.argmax(1)
                score = np.clip((total.max(1) + 1) / 2, 0, 1)
                plain = np.append(0, np.cumsum((data >= 97) & (data < 123)))
                some = plain[texts.offs[1:]] > plain[texts.offs[:-1]]
                for i in np.flatnonzero(~some & (n > 0)):  # letters beyond ASCII, or only signs
                    some[i] = any(ch.isalpha() for ch in texts.text(i).decode())
                if shared.value is None:
                    some[:] = False
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in id_columns],
                     pa.array([names[b] if ok else UNKNOWN for b, ok in zip(best, some)], pa.string()),
                     pa.array(np.where(some, score, 0.0))], names=[*id_columns, "lang_pred", "score"])

    return df.select(*id_columns, column).mapInArrow(run, f"{kinds}, lang_pred string, score double")


def op8_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.crc32(F.col("doc_id").cast("string")) % 4
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(slot == 2, F.lit(False)).alias("held_out"))
    model = train(docs.filter(slot != 2))
    return predict(docs.select("doc_id", "held_out", "text"), model, ["doc_id", "held_out"])
