"""Words of Arrow text columns as numpy arrays of positions and 64-bit hashes.

A word is a longest run of bytes outside ``[\\x20\\x09-\\x0D]``, with A-Z lower-cased. These bytes
never occur inside a multi-byte UTF-8 character, so words of bytes and of characters agree.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, 256, np.uint64)
_GRAM = np.random.Generator(np.random.PCG64(11)).integers(0, 2**64, 16, np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base, and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def byte_hashes(data: np.ndarray) -> np.ndarray:
    """Running hash; ``span_hashes`` gets the hash of any span of bytes from it."""
    up, _ = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=total[1:])
    return total


def span_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(total))
    return mix((total[ends] - total[starts]) * down[starts])


@dataclass
class Words:
    """Words of some texts. ``doc`` is each word's text, counted from the first of the slice."""

    n_docs: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words within a text, and their texts.

        A text of one to ``n - 1`` words has its whole sequence as its only shingle.
        """
        h, doc = self.hashes, self.doc
        counts = self.per_doc()
        long = max(0, len(h) - n + 1)
        out = np.zeros(long, np.uint64)
        for k in range(n):
            out += h[k : k + long] * _GRAM[k]
        whole = doc[:long] == doc[n - 1 : n - 1 + long]
        out, of = mix(out[whole]), doc[:long][whole]
        short = np.flatnonzero((counts > 0) & (counts < n))
        if len(short):
            first = np.concatenate(([0], np.cumsum(counts)))[short]
            extra = np.zeros(len(short), np.uint64)
            for k in range(n - 1):
                has = counts[short] > k
                extra[has] += h[first[has] + k] * _GRAM[k]
            extra = mix(extra ^ _GRAM[n + counts[short]])
            order = np.argsort(np.concatenate((of, short)), kind="stable")
            out, of = np.concatenate((out, extra))[order], np.concatenate((of, short))[order]
        return out, of


def text_slices(
    column: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of slices of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, "right")) - 1)
        high = min(high, len(column))
        yield low, high, data[at[low] : at[high]], at[low : high + 1] - at[low]
        low = high


def words_of(
    data: np.ndarray, offsets: np.ndarray, with_hashes: bool = True, lower: bool = True
) -> Words:
    """Words of concatenated texts; without ``lower``, letters stay as they are."""
    n = len(data)
    if lower:
        data = data + (data - np.uint8(65) < 26) * np.uint8(32)
    inside = (data != 32) & (data - np.uint8(9) > 4)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    hashes = (
        span_hashes(byte_hashes(data), starts, ends) if with_hashes else np.zeros(0, np.uint64)
    )
    return Words(len(offsets) - 1, data, starts, ends, doc, hashes)
