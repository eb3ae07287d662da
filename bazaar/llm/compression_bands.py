"""Quality rules by compression bands.

How far zstandard compresses a text tells repetitive text (it shrinks too
well) and text without structure (keys, encoded files, noise: it hardly
shrinks) from prose.  Short texts always compress worse, so what is normal
depends on the length: ``LIMITS`` gives, for texts of up to so many bytes, the
least and the largest ratio of bytes to compressed bytes.  Prose of any
European language reaches 1.3 at 300 bytes, 1.6 at 1,000 and 2 to 3 from
5,000 on; random letters and digits reach 1.1, 1.25 and 1.33 there; the limits
leave room on both sides and were not fitted to a corpus.

A text is rejected if

* the ratio of the whole text lies outside its band, or
* more than ``MOST`` of its bytes lie in chunks of ``CHUNK`` bytes whose own
  ratios lie outside the band of the chunk's length (a repetitive or noisy
  part inside a long text moves the whole ratio little).  The last chunk may
  be shorter; chunks are cut at fixed bytes, and zstandard does not mind if a
  character is cut.

``base`` rules come first: too few words, or too many words in repeated
8-word windows.

Cases: null and empty texts have no words, so the base rule rejects them
(ratio 0); repeated rows are judged alike, rows with null ids as others; a
text of any length is read whole, in pieces of 1 MB where it is longer; other
columns do not matter; an empty table gives an empty one.  No shuffle: a row
is judged by itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .text_counts import PIECE, Counted, flags

#: (bytes up to, least ratio, largest ratio); 0: no least one (frame headers decide there).
LIMITS = ((256, 0.0, 2.5), (512, 1.15, 3.0), (1024, 1.25, 3.5), (2048, 1.35, 4.0), (8192, 1.4, 4.5), (1 << 62, 1.45, 6.0))
CHUNK = 2048
MOST = 0.25
LEVEL = 3
LEAST_WORDS = 20
WINDOW = 8
MOST_REPEATED = 30  # percent of words
SYMBOLS = "#*$%&|<>"


def outside(size: np.ndarray, ratio: np.ndarray, limits=LIMITS) -> np.ndarray:
    """-1 where a ratio is below the band of its size, 1 above, 0 inside."""
    upto, least, most = (np.array(x) for x in zip(*limits))
    band = np.searchsorted(upto, size)
    return np.where(ratio > most[band], 1, np.where(ratio < least[band], -1, 0))


def compressed(compressor: zstandard.ZstdCompressor, data: memoryview) -> int:
    """Compressed length; a long text goes through in pieces."""
    if len(data) <= PIECE:
        return len(compressor.compress(data))
    stream = compressor.compressobj(size=len(data))
    return sum(len(stream.compress(data[i:i + PIECE])) for i in range(0, len(data), PIECE)) + len(stream.flush())


def ratios(texts: C.Bytes, chunk: int = CHUNK, level: int = LEVEL) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ratio of each text, text of each chunk, its bytes, its ratio)."""
    z, data = zstandard.ZstdCompressor(level=level), memoryview(np.ascontiguousarray(texts.data))
    whole = np.zeros(len(texts))
    of, size, small = [], [], []
    for i, (lo, hi) in enumerate(zip(texts.offs[:-1].tolist(), texts.offs[1:].tolist())):
        if lo == hi:
            continue
        length = compressed(z, data[lo:hi])
        whole[i] = (hi - lo) / length
        for at in range(lo, hi, chunk):
            end = min(hi, at + chunk)
            of.append(i)
            size.append(end - at)
            small.append(length if end - at == hi - lo else len(z.compress(data[at:end])))
    size = np.array(size, np.int64)
    return whole, np.array(of, np.int64), size, size / np.maximum(1, np.array(small, np.int64))


FOUND = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
         "kept boolean, ratio double, n_chunks long, repetitive_chunks long, noisy_chunks long, verdict string")


def judge(df: DataFrame, column: str = "text", keep: tuple[str, ...] = (), limits=LIMITS, chunk: int = CHUNK,
          most: float = MOST, level: int = LEVEL) -> DataFrame:
    """The columns ``keep`` of every row of ``df`` with the counts, the base
    rules' and the bands' verdicts: ``verdict`` names the rule that rejects
    (null: kept)."""
    symbols = flags(SYMBOLS)
    narrow = df.select(*[F.col(f"`{c}`").alias(f"keep{i}") for i, c in enumerate(keep)], F.col(f"`{column}`").alias("text"))
    kept_fields = [f for f in narrow.schema.fields if f.name != "text"]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in C._pieces(whole, "text", PIECE):
                t = Counted(batch.column("text"))
                words, repeated = t.words(), t.repeated_windows(WINDOW)
                ratio, of, size, each = ratios(t.texts, chunk, level)
                band, part = outside(t.texts.lens, ratio, limits), outside(size, each, limits)
                share = np.bincount(of, weights=size * (part != 0), minlength=t.n) / np.maximum(1, t.texts.lens)
                rules = [("few words", words < LEAST_WORDS), ("repeated windows", 100 * repeated > MOST_REPEATED * words),
                         ("repetitive", band > 0), ("incompressible", band < 0), ("chunks", share > most)]
                failed = rules[0][1] | rules[1][1]
                verdict = np.select([hit for _, hit in rules], [name for name, _ in rules], "")
                columns = [words, t.code_points(True), t.chars(symbols), t.duplicate_lines(), repeated, failed, verdict == "",
                           ratio, t.per_text(of), t.per_text(of[part > 0]), t.per_text(of[part < 0])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(f.name) for f in kept_fields] + [pa.array(x) for x in columns]
                    + [pa.array(verdict, mask=verdict == "", type=pa.string())],
                    names=[f.name for f in kept_fields] + [x.split()[0] for x in FOUND.split(", ")])

    fields = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept_fields] + [FOUND])
    out = narrow.mapInArrow(rows, fields)
    return out.select(*[F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)],
                      *[F.col(x.split()[0]) for x in FOUND.split(", ")])


def op13_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(C.read(spark, sf_dir, "documents"), keep=("doc_id",))
