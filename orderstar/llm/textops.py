"""Vectorised text helpers used inside Arrow batches (numpy only, no Spark).

Texts are handled as the UTF-8 bytes of an Arrow string column: one byte array and the documents'
offsets. Hashes are 64-bit polynomial hashes over random byte values, finished by a bit mixer, so any
byte range of the batch is hashed from two prefix sums.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: Code points of scripts written without blanks (Thai to Lao, Burmese, Khmer, Chinese and Japanese with full-width signs).
UNSPACED = np.zeros(1 << 16, bool)
for _a, _b in ((0x0E00, 0x0F00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x2E80, 0xA4D0), (0xF900, 0xFB00), (0xFF00, 0xFFF0)):
    UNSPACED[_a:_b] = True
#: Marks that stay with the character before them.
JOINED = np.zeros(1 << 16, bool)
JOINED[[*map(ord, ".,;:!?\"')]}>»’”›…、。〉》」』】〕！＂＇），．：；？］｝｡")]] = True
#: Bytes of text handled at once; a single longer document is handled alone.
SLICE_BYTES = 1 << 20

try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U), np.ones(1, U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2**64 (kept per process)."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        both = []
        for base in (BASE, INVERSE):
            p = np.full(size, base, U)
            p[0] = 1
            both.append(np.cumprod(p, dtype=U))
        _powers = (both[0], both[1])
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer (bijective on 64-bit words)."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column (null: empty) and the ``len + 1`` offsets."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = pc.fill_null(column, b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Gives freed memory back at the end of a task: Python workers live on, and what they keep adds up on an executor."""
    global _powers
    if len(_powers[0]) > 2 * SLICE_BYTES:  # made for a very long text
        _powers = (np.ones(1, U), np.ones(1, U))
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into row ranges of at most ``most`` bytes of text (one row at least); at their end freed memory is
    given back."""
    yield from _slices(batches, text, most)
    release()


def _slices(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """``n + 1`` prefix sums from which :func:`range_hash` takes the hash of any byte range."""
    forward, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, U)
    np.cumsum(BYTE_VALUES[data] * forward[:-1], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inverse = powers(len(prefix))
    return mix((prefix[end] - prefix[begin]) * inverse[begin] + (end - begin).astype(U))


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes that are not ``space``), and for each document the
    index of its first word (``len + 1`` values). A word never crosses documents."""
    inside = ~space[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    before[first] = False
    after[last] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of the characters that start at ``at`` (0 for those beyond 16 bits or cut off)."""
    byte = [np.where(at + k < len(data), data[np.minimum(at + k, len(data) - 1)], 0).astype(np.int64) for k in range(3)]
    two = (byte[0] & 0x1F) << 6 | byte[1] & 0x3F
    three = (byte[0] & 0x0F) << 12 | (byte[1] & 0x3F) << 6 | byte[2] & 0x3F
    return np.where(byte[0] < 0x80, byte[0], np.where(byte[0] < 0xE0, two, np.where(byte[0] < 0xF0, three, 0)))


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`words`, but every character of a script without blanks is a word, with the marks that close it."""
    start, end, first = words(data, offsets)
    lead = np.flatnonzero(data >= 0xE0)
    if not len(start) or not len(lead):
        return start, end, first
    four = data[lead] >= 0xF0
    # beyond 16 bits: the ideographs of planes 2 and 3
    own = np.where(four, (data[lead] == 0xF0) & (data[np.minimum(lead + 1, len(data) - 1)] >= 0xA0), UNSPACED[code_points(data, lead)])
    cut = np.unique(np.concatenate((lead[own], (lead + 3 + four)[own])))
    cut = cut[cut < len(data)]
    cut = cut[~JOINED[code_points(data, cut)]]
    word = np.searchsorted(start, cut, side="right") - 1
    cut = cut[(word >= 0) & (cut > start[word]) & (cut < end[word])]
    start, end = np.sort(np.concatenate((start, cut))), np.sort(np.concatenate((end, cut)))
    return start, end, np.searchsorted(start, offsets)


def slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every window of ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    return pick(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def runs(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as maximal disjoint runs (touching intervals join)."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate(([True], begin[1:] > reach[:-1])))
    return begin[new], reach[np.concatenate((new[1:] - 1, [len(reach) - 1]))]
