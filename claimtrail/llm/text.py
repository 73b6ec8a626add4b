"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
_K1, _K2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], U64)
_LANES = 8  # words of more bytes than 8 * _LANES are hashed one by one
CHUNK_BYTES = 2 << 20


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans: the byte is in one of the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes that part words of the class ``[^\x20\x09-\x0D]+``.
BLANKS = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Bytes that part words of the class ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased.
NOT_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * _K1
    x = (x ^ (x >> U64(27))) * _K2
    return x ^ (x >> U64(31))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and n + 1 offsets into them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES, texts: int = 1 << 62) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``texts`` texts and about ``limit`` bytes together; a longer text stands alone, whole."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, first + texts)
        yield first, last
        first = last


class Words:
    """Spans of the words of some texts.

    ``starts`` and ``ends`` are byte positions in ``data``; the words of text i are ``of[i]:of[i + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
        self.data, self.offsets = data, offsets
        word = ~separators[data]
        begins, stops = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        stops[:-1] &= ~word[1:]
        full = offsets[1:] > offsets[:-1]
        first, last = offsets[:-1][full], offsets[1:][full] - 1
        begins[first], stops[last] = word[first], word[last]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.of = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes; words of one length up to 8 bytes never collide."""
        n = len(self.starts)
        size = (self.ends - self.starts).astype(np.int64)
        padded = np.zeros(len(self.data) + 16, np.uint8)
        padded[: len(self.data)] = self.data
        eights = np.ndarray(len(padded) - 7, np.dtype("<u8"), padded, strides=(1,))
        h = mix(size.astype(U64))
        active = np.arange(n)
        for lane in range(_LANES):
            if lane:
                active = active[size[active] > 8 * lane]
            if not len(active):
                break
            left = np.minimum(size[active] - 8 * lane, 8)
            h[active] = mix(h[active] ^ (eights[self.starts[active] + 8 * lane] & _MASKS[left]))
        for i in np.flatnonzero(size > 8 * _LANES):
            h[i] = xxhash.xxh64_intdigest(self.data[self.starts[i] : self.ends[i]].tobytes(), 7)
        return h


def each_chunk(column: pa.Array, separators: np.ndarray, lower: bool = False, texts: int = 1 << 62) -> Iterator[tuple[int, int, Words]]:
    """The words of a column's texts by chunks: first text, last text (exclusive), words."""
    data, offsets = text_bytes(column)
    for first, last in chunks(offsets, texts=texts):
        part = data[offsets[first] : offsets[last]]
        yield first, last, Words(lower_ascii(part) if lower else part, offsets[first : last + 1] - offsets[first], separators)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words from each position on; positions with fewer words left are missing."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, U64)
    for j in range(n):
        out *= U64(0x9E3779B97F4A7C15)
        out += hashes[j : j + count]
    return mix(out)


def union_length(starts: np.ndarray, ends: np.ndarray) -> int:
    """How many positions half-open intervals cover together."""
    if not len(starts):
        return 0
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    begin = np.maximum(starts, np.concatenate([starts[:1], ends[:-1]]))
    return int(np.maximum(ends - begin, 0).sum())
