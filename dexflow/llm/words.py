"""Words of texts in Arrow batches, hashed with numpy: the words ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Multipliers of the rolling hashes of word hashes (odd, so they have inverses modulo 2**64).
WORD_STEP, OTHER_STEP = 0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15
#: Bytes, or words, that one rolling sum runs over.
BLOCK = 1 << 18
#: Bytes of text worked on at once; a longer text is worked on alone.
PIECE = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all (the finaliser of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(step: int, n: int) -> np.ndarray:
    out = np.full(n, step % 2**64, U)
    out[:1] = 1
    return np.cumprod(out, dtype=U)


class Rolling:
    """Position-independent hashes of spans: sum of value[k] * step**k, times step**-start."""

    def __init__(self, step: int):
        self.step, self.back = step, pow(step, -1, 2**64)
        self.up, self.down = powers(self.step, BLOCK), powers(self.back, BLOCK)

    def sums(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(len(values) + 1, U)
        out[0] = 0
        np.cumsum(values * self.up[:len(values)], out=out[1:])
        return out


def spread(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A 64-bit number for each byte at each place of a word."""
    return mix((place.astype(U) << U(8)) + data + U(1))


class Words:
    """The words of a run of texts: ``hashes`` one after the other, ``first[i]`` where those of text i begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        word = WORD[data]
        text_edge = np.zeros(len(data) + 1, bool)
        text_edge[offsets] = True
        gap = np.ones(len(data) + 1, bool)
        gap[1:-1] = ~(word[1:] & word[:-1]) | text_edge[1:-1]
        self.begins = np.flatnonzero(word & gap[:-1])
        self.ends = np.flatnonzero(word & gap[1:]) + 1
        self.first = np.searchsorted(self.begins, offsets)

    def hashes(self) -> np.ndarray:
        """A hash of each word: the sum of a spread number for each of its bytes and the byte's place in the word.

        No sum of powers: those are equal for some pairs of unequal words whatever the base.
        """
        out, i, n = np.empty(len(self.begins), U), 0, len(self.begins)
        while i < n:
            s = self.begins[i]
            j = max(i + 1, int(np.searchsorted(self.ends, s + BLOCK, "right")))
            if self.ends[i] - s > BLOCK:  # one word longer than a block
                out[i] = sum(int(spread(self.data[a:min(a + BLOCK, self.ends[i])], np.arange(a - s, min(a + BLOCK, self.ends[i]) - s)).sum())
                             for a in range(s, self.ends[i], BLOCK)) % 2**64
                j = i + 1
            else:
                lengths = self.ends[i:j] - self.begins[i:j]
                starts = np.cumsum(lengths) - lengths
                place = np.arange(lengths.sum()) - np.repeat(starts, lengths)
                out[i:j] = np.add.reduceat(spread(self.data[np.repeat(self.begins[i:j], lengths) + place], place), starts)
            i = j
        return mix(out + (self.ends - self.begins).astype(U))

    def text(self, i: int) -> np.ndarray:
        """Which words text i has, as a slice."""
        return slice(self.first[i], self.first[i + 1])


def window_hashes(values: np.ndarray, width: int, rolling: Rolling) -> np.ndarray:
    """Hash of every ``width`` consecutive values, by the place of the first."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, U)
    out = np.empty(n, U)
    step = BLOCK - width
    for i in range(0, n, step):
        j = min(n, i + step)
        c = rolling.sums(values[i:j + width - 1])
        out[i:j] = (c[width:] - c[:-width]) * rolling.down[:j - i]
    return out


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``PIECE`` bytes of ``text``: the slice, its bytes, and the offsets of its texts.

    Null texts have no bytes. The bytes are views of the batch; nothing is decoded.
    """
    for batch in batches:
        column = batch.column(text)
        column = column.cast(pa.large_string() if not pa.types.is_binary(column.type) else pa.large_binary())
        if column.null_count:
            column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
        _, ends, data = column.buffers()
        offsets = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        i = 0
        while i < len(column):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, "right")) - 1)
            yield batch.slice(i, j - i), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            i = j
