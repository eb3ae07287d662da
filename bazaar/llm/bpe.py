"""BPE encoding and decoding with a public vocabulary file.

Text is cut at ASCII white space, where the vocabulary's own rules never join
anything, so every distinct word of a batch is encoded once by the tokenizers
library and a document is put together from its words' ids.

*Long unsplit text* (a piece that the vocabulary's rules leave whole, over
``LEAF`` characters) goes through tree concatenation: leaves are encoded in
parallel, and halves are joined by encoding a growing window around the join
again until it agrees with the left half and with the right half on a token
at the same place each.  Left tokens up to there, the window's tokens between
and right tokens from there on are then the encoding of the whole: a token
sequence is the encoding of its text exactly if every neighbouring pair is
the encoding of theirs, and every pair here comes out of one real encoding.
What an end of word does to a half's last tokens is undone in the same way,
as the window's own last tokens never count as agreement unless they match.

Cases: null and empty texts and texts of white space have no ids, and decode
to the empty string; special tokens written out in a text become their ids,
as the library does it; repeated rows are encoded alike; an empty table gives
an empty one; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common as C

LEAF = 2048
CACHED = 150_000
PIECE = 3 << 20


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """A tokenizer file with a bounded cache of words."""

    def __init__(self, path: str, leaf: int = LEAF):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.leaf = leaf
        special = sorted((t.content for t in self.tok.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.end = getattr(self.tok.model, "end_of_word_suffix", None) or ""
        self.known: dict[bytes, tuple[bytes, str, int]] = {}

    # -- long unsplit pieces

    def _leaf(self, piece: str) -> list[tuple[int, int, int, str]]:
        """(id, start, end, token) over the characters of ``piece``."""
        out, at = [], 0
        for t in self.tok.model.tokenize(piece):
            size = len(t.value) - (len(self.end) if self.end and t.value.endswith(self.end) and
                                   at + len(t.value) > len(piece) else 0)
            out.append((t.id, at, at + size, t.value))
            at += size
        return out

    def _join(self, piece: str, left: list, right: list) -> list:
        shift, stop = left[0][1], right[-1][2]
        width = 8
        while True:
            lo, hi = max(0, len(left) - width), min(len(right), width)
            begin, end = left[lo][1], right[hi - 1][2]
            window = [(i, a + begin, b + begin, v) for i, a, b, v in self._leaf(piece[begin:end])]
            first = next((k for k, t in enumerate(window) if t in set(left[lo:])), None) if begin > shift else 0
            last = next((k for k in range(len(window) - 1, -1, -1) if window[k] in set(right[:hi])), None) \
                if end < stop else len(window) - 1
            if first is not None and last is not None and first <= last:
                head = left[:left.index(window[first])] if begin > shift else []
                tail = right[right.index(window[last]) + 1:] if end < stop else []
                return head + window[first:last + 1] + tail
            if begin == shift and end == stop:
                return window
            width *= 2

    def _tree(self, piece: str, pool: ThreadPoolExecutor) -> list:
        cuts = [*range(0, len(piece), self.leaf), len(piece)]
        parts = [[(i, a + lo, b + lo, v) for i, a, b, v in leaf] for lo, leaf in
                 zip(cuts, pool.map(self._leaf, [piece[i:j] for i, j in zip(cuts, cuts[1:])]))]
        while len(parts) > 1:
            pairs = [(piece, parts[i], parts[i + 1]) for i in range(0, len(parts) - 1, 2)]
            rest = parts[len(pairs) * 2:]
            parts = list(pool.map(lambda x: self._join(*x), pairs)) + rest
        return parts[0]

    def encode_long(self, text: str) -> tuple[list[int], list[str]]:
        """Ids and tokens of a text, its long unsplit pieces by the tree."""
        ids, tokens = [], []
        with ThreadPoolExecutor(2) as pool:
            for part in self.special.split(text) if self.special else [text]:
                if self.special and self.special.fullmatch(part):
                    ids.append(self.tok.token_to_id(part))
                    tokens.append(part)
                    continue
                for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(part)):
                    found = self._tree(piece, pool) if len(piece) > self.leaf else self._leaf(piece)
                    ids += [t[0] for t in found]
                    tokens += [t[3] for t in found]
        return ids, tokens

    # -- words

    def words(self, words: list[bytes]) -> list[tuple[bytes, str, int]]:
        """(decimal ids joined by a space, decoded text, number of ids) of each word."""
        known = self.known
        fresh = [w for w in words if w not in known]
        if fresh:
            if len(known) + len(fresh) > CACHED:
                keep_out = [known.get(w) for w in words]
                known.clear()
                known.update((w, k) for w, k in zip(words, keep_out) if k is not None)
            short = [w for w in fresh if len(w) <= self.leaf]
            for w, e in zip(short, self.tok.encode_batch([w.decode() for w in short], add_special_tokens=False)):
                ids = e.ids
                known[w] = " ".join(map(str, ids)).encode(), self.decode_tokens(ids, e.tokens), len(ids)
            for w in fresh:
                if len(w) > self.leaf:
                    ids, tokens = self.encode_long(w.decode())
                    known[w] = " ".join(map(str, ids)).encode(), self.decode_tokens(ids, tokens), len(ids)
        return [known[w] for w in words]

    def decode_tokens(self, ids: list[int], tokens: list[str]) -> str:
        """As the library decodes them: it joins tokens by a space where the file names no decoder."""
        return " ".join(tokens) if self.tok.decoder is None else self.tok.decode(ids, skip_special_tokens=False)

    def decode(self, ids: list[int]) -> str:
        return self.tok.decode(ids, skip_special_tokens=False)

    def documents(self, column: pa.Array) -> Iterator[tuple[bytes, str, int]]:
        """The same three values of each text."""
        texts = C.Bytes(column)
        starts, ends, text = C.word_spans(texts.data, texts.offs)
        names = C.Roller(texts.data).names(starts, ends)
        _, first, inverse = np.unique(names, return_index=True, return_inverse=True)
        raw = texts.data.tobytes()
        found = self.words([raw[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist())])
        ids, decoded = np.empty(len(found), object), np.empty(len(found), object)
        ids[:], decoded[:] = [f[0] for f in found], [f[1] for f in found]
        n = np.array([f[2] for f in found], np.int64)
        offs = np.append(0, np.cumsum(np.bincount(text, minlength=len(texts))))
        silent = bool((n == 0).any())
        for i, j in zip(offs[:-1].tolist(), offs[1:].tolist()):
            at = inverse[i:j]
            if silent:
                at = at[n[at] > 0]
            yield b" ".join(ids[at].tolist()), " ".join(decoded[at].tolist()), int(n[at].sum())


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(df: DataFrame, path: str, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, n_tokens, decoded) of every whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for batch in C._pieces(whole, column, PIECE // 2):
                found = list(enc.documents(batch.column(column)))
                flat = np.array(b" ".join(f[0] for f in found if f[0]).split(), np.int32)
                cut = np.append(0, np.cumsum([f[2] for f in found])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_column), pa.ListArray.from_arrays(pa.array(cut), pa.array(flat, pa.int32())),
                     pa.array([f[2] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())],
                    names=[id_column, "ids", "n_tokens", "decoded"])

    C.bound_batches(df.sparkSession)
    kind = df.schema[id_column].dataType.simpleString()
    return df.select(id_column, column).mapInArrow(run, f"`{id_column}` {kind}, ids array<int>, n_tokens long, decoded string")


def decode(df: DataFrame, path: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """The columns of ``df`` and ``name``: the text of the ids (null: empty)."""
    from pyspark.sql import types as T

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = [enc.decode(x or []) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.StringType())]))


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, path: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for batch in C._pieces(whole, "text", PIECE):
                n, a, b = [], [], []
                for ids, decoded, size in enc.documents(batch.column("text")):
                    n.append(size)
                    a.append(hashlib.sha256(ids).hexdigest())
                    b.append(hashlib.sha256(decoded.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()),
                                                  pa.array(a, pa.string()), pa.array(b, pa.string())],
                                                 names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, DIGEST)


def op10_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(C.read(spark, sf_dir, "documents"), vocabulary())
