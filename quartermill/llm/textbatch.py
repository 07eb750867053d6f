"""Words of whole Arrow text batches as numpy positions."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes 0x20 and 0x09-0x0D end a word, so words are ``[^\\x20\\x09-\\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Letter runs: ASCII letters and every byte of a non-ASCII character.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

#: Masks that keep the first n bytes of eight.
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of ``column`` each; a longer text stands alone."""
    for batch in batches:
        sizes = batch.column(column).cast(pa.large_string()).fill_null("")
        ends = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset : sizes.offset + len(sizes) + 1]
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


class Words:
    """Word positions of a text column; null texts are empty.

    ``data`` holds the bytes of all texts, ``offsets`` the texts' bounds in it,
    ``starts`` and ``ends`` the words' bounds, ``first`` the number of words
    before each text (one entry more than texts).
    """

    def __init__(self, column: pa.Array, lower: bool = False, separators: np.ndarray = SPACE):
        column = column.cast(pa.large_string()).fill_null("")
        bounds, body = column.buffers()[1:]
        offsets = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
        self.data = LOWER[data] if lower else data
        self.offsets = offsets - offsets[0]
        self.inside = ~separators[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[self.offsets] = True
        before = np.concatenate([[False], self.inside[:-1]]) if len(data) else self.inside
        after = np.concatenate([self.inside[1:], [False]]) if len(data) else self.inside
        self.starts = np.flatnonzero(self.inside & (edge[:-1] | ~before))
        self.ends = np.flatnonzero(self.inside & (edge[1:] | ~after)) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, eight bytes at a time for all words together."""
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eights = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))
        at, left = self.starts, self.ends - self.starts
        with np.errstate(over="ignore"):
            out = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            rest = np.arange(len(at))
            while len(rest):
                out[rest] = mixed(out[rest] ^ (eights[at] & _LOW_BYTES[np.minimum(left, 8)]))
                more = left > 8
                rest, at, left = rest[more], at[more] + 8, left[more] - 8
        return out

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Number of set flags (one flag a byte) in each text."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def per_words(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value a word over the words of each text."""
        sums = np.concatenate([np.zeros(1, np.float64 if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
        return sums[self.first[1:]] - sums[self.first[:-1]]


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return values ^ (values >> np.uint64(33))
