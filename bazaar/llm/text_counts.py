"""Counts over the whole texts of an Arrow batch, without a loop over rows.

``Counted`` names every word by the number of its exact bytes within the
batch (a dictionary, not a hash), so counts of distinct or repeated words and
windows are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import common as C

PIECE = 1 << 20


def flags(chars: str) -> np.ndarray:
    """Which of the 256 bytes are one of ``chars`` (ASCII)."""
    out = np.zeros(256, bool)
    out[np.frombuffer(chars.encode("ascii"), np.uint8)] = True
    return out


def exact_ids(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A number per string ``data[offs[i]:offs[i + 1]]``, equal for equal strings alone."""
    strings = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offs) - 1, [None, pa.py_buffer(np.ascontiguousarray(offs, np.int64)),
                                           pa.py_buffer(np.ascontiguousarray(data))])
    return np.asarray(strings.dictionary_encode().indices, np.int64)


def number_ids(x: np.ndarray) -> np.ndarray:
    """A number below ``len(x)`` per element, equal for equal elements alone."""
    return np.asarray(pa.array(x).dictionary_encode().indices, np.int64)


class Counted:
    """The texts of a string array (null: empty) with their words
    ``[^\\x20\\x09-\\x0D]+``: ``text`` and ``word`` of each word in order."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        self.texts = C.Bytes(column)
        self.data, self.offs, self.n = self.texts.data, self.texts.offs, len(self.texts)
        self.starts, self.ends, self.text = C.word_spans(self.data, self.offs)
        offs = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.ends - self.starts)])
        self.word = exact_ids(self.data[~C.SPACE[self.data]], offs)

    def per_text(self, text: np.ndarray) -> np.ndarray:
        return np.bincount(text, minlength=self.n).astype(np.int64)

    def bytes_where(self, hit: np.ndarray) -> np.ndarray:
        """Number of bytes of each text for which ``hit`` (one bool a byte) holds."""
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(hit, dtype=np.int64)])
        return total[self.offs[1:]] - total[self.offs[:-1]]

    def words(self) -> np.ndarray:
        return self.per_text(self.text)

    def code_points(self, in_words: bool = False) -> np.ndarray:
        lead = (self.data & 0xC0) != 0x80
        return self.bytes_where(lead & ~C.SPACE[self.data] if in_words else lead)

    def chars(self, which: np.ndarray) -> np.ndarray:
        return self.bytes_where(which[self.data])

    def distinct_words(self) -> np.ndarray:
        return self.per_text(np.unique(self.word * self.n + self.text) % max(1, self.n))

    def repeated_windows(self, width: int) -> np.ndarray:
        """Per text: words lying in a window of ``width`` words (a power of
        two) that the text holds at least twice, wherever it stands."""
        n = len(self.word) - width + 1
        if n <= 0:
            return np.zeros(self.n, np.int64)
        name, step = self.word, 1
        while step < width:  # names of windows of twice the width, from pairs of names
            name = number_ids(name[:-step] * len(self.word) + name[step:])
            step *= 2
        inside = np.flatnonzero(self.text[:n] == self.text[width - 1:])
        key = number_ids(name[inside] * self.n + self.text[inside])
        again = inside[np.bincount(key, minlength=1)[key] > 1]
        edge = np.bincount(again, minlength=len(self.word) + 1) - np.bincount(again + width, minlength=len(self.word) + 1)
        return self.per_text(self.text[np.cumsum(edge)[:-1] > 0])

    def duplicate_lines(self) -> np.ndarray:
        """Per text: \\n-split lines holding a word that equal an earlier line of it."""
        feed = self.data == 10
        cuts = np.union1d(np.flatnonzero(feed) + 1, self.offs[:-1])
        cuts = cuts[cuts < len(self.data)]  # what follows a text's last \n is the next text
        ends = np.append(cuts, len(self.data))[1:]
        text = np.searchsorted(self.offs, cuts, side="right") - 1
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(~C.SPACE[self.data], dtype=np.int64)])
        live = total[ends] > total[cuts]
        kept = np.concatenate([np.zeros(1, np.int64), np.cumsum(~feed, dtype=np.int64)])
        offs = np.append(kept[cuts], kept[-1])
        line = exact_ids(self.data[~feed], offs)[live]
        text = text[live]
        return self.per_text(text) - self.per_text(np.unique(line * self.n + text) % max(1, self.n))
