"""Rotated one-bit codes of vectors, with bounds that never fail.

A vector v is moved by the shard's centre and turned by a fixed random
rotation to y.  Its first code is the signs of y: the unit vector u with
components +-1 / sqrt(D).  Stored with it is the alignment a = <y, u>, so that
y = a u + r with r orthogonal to u.  ``LEVELS`` codes follow each other: the
rest r is turned again and coded the same way, each level leaving about 0.6 of
the length of the one before, |r| is stored after the last.

For a query q the same turns give z at each level, rounded to ``BITS`` bits a
component (z = z' + e, |e| is known).  <u, z'> is counted: the popcounts of
the code with each bit plane of z'.  With the levels' sums s = sum a <u, z'>

    <v, q> = <centre, q> + s + <errors> + <r, z_last>,
    |<r, z_last>| <= |r| sqrt(|z_last|^2 - <u, z_last>^2)   (Cauchy-Schwarz, r orthogonal to u)
    |a <u, e>| <= |a| |e|                                      (the same, |u| = 1)

so every score has an interval it lies in for certain, up to rounding of
doubles, for which the interval is widened.
"""

from __future__ import annotations

import numpy as np

LEVELS = 4
BITS = 6
SEED = 20240229 + 11
_ROTATIONS: dict[tuple[int, int], np.ndarray] = {}


def rotation(dim: int, level: int) -> np.ndarray:
    """An orthogonal matrix, the same in every worker and run."""
    if (dim, level) not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng((SEED, dim, level)).standard_normal((dim, dim)))
        _ROTATIONS[dim, level] = q * np.sign(np.diag(r))
    return _ROTATIONS[dim, level]


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bools as rows of 64-bit words."""
    n, dim = bits.shape
    whole = np.zeros((n, -(-dim // 64) * 8), np.uint8)
    b = np.packbits(bits, axis=1, bitorder="little")
    whole[:, :b.shape[1]] = b
    return whole.view(np.uint64)


def ones(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of bits that rows of ``a`` and ``b`` have in common, all pairs."""
    out = np.zeros((len(a), len(b)), np.int32)
    for w in range(a.shape[1]):
        out += np.bitwise_count(a[:, w, None] & b[None, :, w])
    return out


class Codes:
    """One-bit codes of the rows of ``x``: centre, codes (level, row, word),
    align (level, row) and rest (row), the length that no level covers."""

    def __init__(self, centre, codes, align, rest):
        self.centre, self.codes, self.align, self.rest = centre, codes, align, rest

    @classmethod
    def of(cls, x: np.ndarray, levels: int = LEVELS) -> Codes:
        dim = x.shape[1]
        centre = x.mean(0)
        y, codes, align = x - centre, [], []
        for level in range(levels):
            y = y @ rotation(dim, level)
            up = y >= 0
            codes.append(packed(up))
            u = np.where(up, 1.0, -1.0) / np.sqrt(dim)
            align.append(np.einsum("ij,ij->i", y, u))
            y = y - align[-1][:, None] * u
        # What the rotations and differences round off is far below 1e-12 of the length.
        rest = np.sqrt(np.einsum("ij,ij->i", y, y)) + 1e-12 * np.sqrt(np.einsum("ij,ij->i", x, x)) + 1e-12
        return cls(centre, np.stack(codes), np.stack(align), rest)

    def bounds(self, q: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) of the inner product of every query with every row."""
        dim = q.shape[1]
        size = np.sqrt(np.einsum("ij,ij->i", q, q))
        middle = np.repeat((q @ self.centre)[:, None], len(self.rest), 1)
        slack = np.zeros_like(middle)
        z = q
        for level, (code, align) in enumerate(zip(self.codes, self.align)):
            z = z @ rotation(dim, level)
            low = z.min(1, keepdims=True)
            step = np.maximum((z.max(1, keepdims=True) - low) / ((1 << bits) - 1), 1e-300)
            k = np.rint((z - low) / step).astype(np.int64)
            error = z - (low + step * k)
            # <u, z'> sqrt(D) = sum of z' over the set bits minus the sum over the others
            on = low * np.bitwise_count(code).sum(1, dtype=np.int64)[None, :]
            for j in range(bits):
                on = on + (step * (1 << j)) * ones(packed((k >> j & 1).astype(bool)), code)
            along = (2 * on - (low * dim + step * k.sum(1, keepdims=True))) / np.sqrt(dim)
            off = np.sqrt(np.einsum("ij,ij->i", error, error))[:, None]
            middle += align * along
            slack += np.abs(align) * off
        # the part of z across the last code: at least as far along it as the count says
        across = np.sqrt(np.maximum(size[:, None] ** 2 - np.maximum(np.abs(along) - off, 0) ** 2, 0))
        reach = np.sqrt(self.centre @ self.centre) + np.abs(self.align).sum(0) + self.rest
        slack += self.rest * across + 1e-9 * size[:, None] * reach[None, :] + 1e-6
        return middle - slack, middle + slack
