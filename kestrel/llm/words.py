"""Word hashes of whole texts with numpy, straight from Arrow's UTF-8 buffers.

Used inside ``mapInArrow`` tasks: Spark deals the rows, a batch is cut into slices of a few MB
of text (a single longer text is its own slice), and every step works on flat arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21

_rng = np.random.default_rng(20240607)
_BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)                       # odd, so it has an inverse mod 2^64
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
# Words are runs of anything but space and TAB..CR; A-Z count as a-z.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every input bit moves every output bit)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    a = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(a.buffers()[1], dtype=np.int64, count=a.offset + len(a) + 1)[a.offset:]
    raw = a.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, size: int = SLICE_BYTES):
    """(first row, end row) of runs of rows with about ``size`` bytes together."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end
        row = end


class _Powers:
    """Powers of the step and of its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int):
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            a, b = np.full(size, _STEP, np.uint64), np.full(size, _BACK, np.uint64)
            a[0] = b[0] = 1
            with np.errstate(over="ignore"):
                self.up, self.down = np.cumprod(a, dtype=np.uint64), np.cumprod(b, dtype=np.uint64)
        return self.up, self.down


_powers = _Powers()


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = IS_SPACE):
    """start, end of every word of the texts ``data[offsets[i]:offsets[i+1]]`` and the first word
    of each text (``len(offsets)`` entries). ``offsets`` must be relative to ``data``."""
    n = len(data)
    inside = ~space[data]
    first = np.zeros(n + 1, dtype=bool)
    if n:
        first[1:n] = inside[1:] & ~inside[:-1]
        first[0] = inside[0]
        edges = offsets[:-1][offsets[:-1] < n]
        first[edges] = inside[edges]
        last = np.zeros(n + 1, dtype=bool)
        last[1:n] = inside[:-1] & ~inside[1:]
        last[n] = inside[n - 1]
        cuts = offsets[1:][offsets[1:] > 0]
        last[cuts] |= inside[cuts - 1]
    else:
        last = first
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the lower-cased bytes of every word (polynomial, then mixed)."""
    n = len(data)
    up, down = _powers.get(n + 1)
    with np.errstate(over="ignore"):
        c = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODE[LOWERED[data]] * up[:n], out=c[1:])
        return mix64((c[ends] - c[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int = 5):
    """Hash and text number of every ``k``-word shingle; a text of fewer words, but not none,
    has one shingle of all its words."""
    n_words = np.diff(first)
    texts = np.repeat(np.arange(len(n_words)), n_words)
    coef = mix64(np.arange(1, k + 1, dtype=np.uint64) * _STEP) | np.uint64(1)
    with np.errstate(over="ignore"):
        m = max(len(words) - k + 1, 0)
        h = np.zeros(m, np.uint64)
        for j in range(k):
            h += words[j:j + m] * coef[j]
        whole = texts[:m] == texts[k - 1:k - 1 + m] if m else np.zeros(0, bool)
        out, owner = mix64(h[whole]), texts[:m][whole]
        few = np.flatnonzero((n_words > 0) & (n_words < k))
        if len(few):
            part = np.zeros(len(few), np.uint64)
            for j in range(k - 1):
                has = n_words[few] > j
                part[has] += words[first[few[has]] + j] * coef[j]
            out = np.concatenate([out, mix64(part + n_words[few].astype(np.uint64) * _STEP)])
            owner = np.concatenate([owner, few])
    return out, owner


def distinct_sets(hashes: np.ndarray, owner: np.ndarray, n: int):
    """Hashes sorted within their text without repeats, and where each text's begin (n + 1)."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o = h[keep], o[keep]
    return h, np.searchsorted(o, np.arange(n + 1), side="left")
