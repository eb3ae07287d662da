"""Quality classifier from weak labels.

1. Six overlapping heuristic labellers vote good, bad or nothing on a text.
2. Expectation maximisation over the counts of vote patterns (3^6 at most,
   counted over all documents) estimates how often each labeller is right on
   good and on bad texts, and with that a posterior for every pattern.
3. The posteriors of a bounded sample (``SAMPLE`` different texts, those of the
   least hashes) train a logistic scorer over hashed word shapes and pairs of
   shapes.
4. The scorer alone scores every whole document: ``score`` is the modelled
   probability of good text; below ``THRESHOLD`` the document is rejected.

Cases: texts without words (null, empty, only white space) get score 0 and
are rejected; texts on which no labeller votes count with the prior; ties at
the threshold are kept; repeated rows get equal scores; an empty table gives
an empty one and trains nothing; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

SAMPLE = 20_000
THRESHOLD = 0.5
DIMS = 1 << 14
PIECE = 1 << 20
#: share of the words or bytes at which a labeller says bad, and below which good
LABELLERS = {"symbols": (0.08, 0.03), "shouting": (0.5, 0.2), "marked_words": (0.2, 0.05), "wordless": (0.15, 0.05),
             "stutter": (0.3, 0.1), "echo": (0.4, 0.2)}

LETTER, UPPER, DIGIT, STOP, SYMBOL, WIDE = range(6)
KIND = np.full(256, SYMBOL, np.uint8)
KIND[97:123], KIND[65:91], KIND[48:58], KIND[128:] = LETTER, UPPER, DIGIT, WIDE
KIND[[ord(c) for c in ".,;:?'\"()-"]] = STOP
KIND[C.SPACE] = STOP


def _before(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(x, dtype=np.int64)])


class Measured:
    """Shapes of the words of a batch, and its texts' shares for the labellers."""

    def __init__(self, column: pa.Array):
        texts = C.Bytes(column)
        data, m = texts.data, len(texts)
        starts, ends, self.text = C.word_spans(data, texts.offs)
        kind = KIND[data]
        symbols, upper = _before(kind == SYMBOL), _before(kind == UPPER)
        letters = _before((kind == LETTER) | (kind == UPPER) | (kind == WIDE))
        self.words = np.bincount(self.text, minlength=m)
        names = C.Roller(data).names(starts, ends)
        same = [np.zeros(len(names), bool) for _ in range(3)]
        for k in (1, 2, 3):
            same[k - 1][k:] = (names[k:] == names[:-k]) & (self.text[k:] == self.text[:-k])
        stutter, echo = same[0], same[0] | same[1] | same[2]
        size = ends - starts
        plain = letters[ends] - letters[starts]
        loud = 2 * (upper[ends] - upper[starts]) > np.maximum(plain, 1)
        last = kind[ends - 1] if len(ends) else np.zeros(0, np.uint8)
        but = np.where(size > 1, kind[ends - 2], STOP) if len(ends) else last
        marked = (size > 2) & (data[ends - 1] == data[ends - 2]) & (KIND[data[ends - 1]] == SYMBOL) if len(ends) else stutter
        digits = _before(kind == DIGIT)
        wordless = (plain == 0) & (digits[ends] == digits[starts])
        shape = (kind[starts].astype(np.int64) if len(starts) else np.zeros(0, np.int64))
        for part, base in ((last, 6), (but, 6), (loud, 2), (stutter, 2), (echo, 2), (marked, 2), (wordless, 2),
                           (np.minimum(size // 4, 5), 6), (np.minimum(symbols[ends] - symbols[starts], 3), 4)):
            shape = shape * base + part.astype(np.int64)
        prior = np.zeros_like(shape)
        prior[1:] = np.where(self.text[1:] == self.text[:-1], shape[:-1] + 1, 0)
        one = C.mix(shape.astype(C.U64) + C.U64(1))
        two = C.mix(one + C.mix(prior.astype(C.U64) + C.U64(7)))
        self.codes = np.stack([(x >> C.U64(50)).astype(np.int64) % DIMS for x in (one, two)])
        w = np.maximum(self.words, 1)
        by = lambda x: np.bincount(self.text, weights=x, minlength=m) / w
        offs = texts.offs
        over = lambda x, y: (x[offs[1:]] - x[offs[:-1]]) / np.maximum(y, 1)
        self.shares = np.stack([over(symbols, texts.lens), over(upper, letters[offs[1:]] - letters[offs[:-1]]),
                                by(marked), by(wordless), by(stutter), by(echo)], axis=1)

    def patterns(self) -> np.ndarray:
        """Votes in base 3, by labeller: 0 none, 1 bad, 2 good."""
        bad, good = np.array(list(LABELLERS.values())).T
        votes = np.where(self.shares >= bad, 1, np.where(self.shares < good, 2, 0))
        votes[self.words < 3] = 0
        return votes @ 3 ** np.arange(len(LABELLERS))

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        gain = weights[self.codes].sum(0)
        return bias + np.bincount(self.text, weights=gain, minlength=len(self.words)) / np.maximum(self.words, 1)


def pattern_votes(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def posteriors(pattern: np.ndarray, count: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, dict]:
    """P(good) of every vote pattern, and the labellers' estimated accuracies
    on bad and on good texts, by expectation maximisation."""
    votes = pattern_votes(pattern)
    bad, good = (votes == 1).astype(float), (votes == 2).astype(float)
    p = np.where(bad.sum(1) > 0, 0.1, 0.95)  # start: any bad vote makes a text suspect
    for _ in range(rounds):
        prior = (count @ p + 1) / (count.sum() + 2)
        on_good = ((count * p) @ good + 1) / ((count * p) @ (good + bad) + 2)
        on_bad = ((count * (1 - p)) @ bad + 1) / ((count * (1 - p)) @ (good + bad) + 2)
        logit = (np.log(prior / (1 - prior)) + good @ np.log(on_good / (1 - on_bad)) + bad @ np.log((1 - on_good) / on_bad))
        new = 1 / (1 + np.exp(-logit))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return p, {k: (b, g) for k, b, g in zip(LABELLERS, on_bad, on_good)}


def _fit(rows: list, dims: int = DIMS, rounds: int = 300, rate: float = 0.3, penalty: float = 1e-6):
    """Logistic regression on (codes, shares, target) rows by Adam steps over all of them."""
    size = np.array([len(r.codes) for r in rows])
    code, share = np.concatenate([r.codes for r in rows]).astype(int), np.concatenate([r.shares for r in rows])
    row = np.repeat(np.arange(len(rows)), size)
    y = np.array([r.good for r in rows])
    w, m, v = (np.zeros(dims + 1) for _ in range(3))
    for t in range(1, rounds + 1):
        z = np.bincount(row, weights=w[code] * share, minlength=len(rows)) + w[dims]
        e = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(rows)
        g = np.append(np.bincount(code, weights=e[row] * share, minlength=dims), e.sum()) + penalty * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    return w[:dims], float(w[dims])


def train(df: DataFrame, column: str = "text", sample: int = SAMPLE) -> dict | None:
    """{weights, bias, accuracies}; None for a table without words."""

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in C._pieces(whole, column, PIECE):
                seen = Measured(batch.column(column))
                u, n = np.unique(seen.patterns()[seen.words > 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(n, pa.int64())], names=["pattern", "n"])

    C.bound_batches(df.sparkSession)
    texts = df.select(column)
    counted = texts.mapInArrow(vote, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    if not counted:
        return None
    pattern, count = (np.array([r[k] for r in sorted(counted)]) for k in ("pattern", "n"))
    p, accuracies = posteriors(pattern, count.astype(float))
    belief = dict(zip(pattern.tolist(), p.tolist()))

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in C._pieces(whole, column, PIECE):
                seen = Measured(batch.column(column))
                at = np.concatenate([seen.text, seen.text]) * DIMS + seen.codes.ravel()
                u, n = np.unique(at, return_counts=True)
                text, share = u // DIMS, n / np.maximum(seen.words[u // DIMS], 1)
                cut = np.append(0, np.cumsum(np.bincount(text, minlength=len(batch)))).astype(np.int32)
                good = [belief.get(k, 0.5) for k in seen.patterns().tolist()]
                out = pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(cut), pa.array((u % DIMS).astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(share)), pa.array(good, pa.float64())],
                    names=["codes", "shares", "good"])
                yield out.filter(pa.array(seen.words > 0))

    chosen = C.distinct_sample(texts.filter(F.col(column).rlike(r"[^\x20\x09-\x0D]")), column, sample)
    rows = chosen.mapInArrow(describe, "codes array<int>, shares array<double>, good double").collect()
    weights, bias = _fit(rows) if rows else (np.zeros(DIMS), float(np.log(p.mean() / (1 - p.mean()))))
    return {"weights": weights, "bias": bias, "accuracies": accuracies}


def score(df: DataFrame, model: dict | None, column: str = "text", name: str = "score") -> DataFrame:
    """``df`` with a column ``name``: P(good) of each whole text."""
    C.bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((model["weights"], model["bias"]) if model else (np.zeros(DIMS), 0.0))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for whole in batches:
            for batch in C._pieces(whole, column, PIECE):
                seen = Measured(batch.column(column))
                p = 1 / (1 + np.exp(-np.clip(seen.logits(weights, bias), -500, 500)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.where(seen.words > 0, p, 0.0))],
                                                 names=[*batch.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())]))


def quality_filter(df: DataFrame, column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` whose text the scorer does not reject."""
    name = C.free_name(df, "quality_score")
    return score(df, train(df, column), column, name).filter(F.col(name) >= threshold).drop(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return (score(docs, train(docs)).drop("text")
            .withColumn("kept", F.col("score") >= THRESHOLD))
