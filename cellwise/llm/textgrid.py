"""Words and hashes of many texts at once, as numpy arrays over Arrow buffers.

Helpers of the operators that run Python inside tasks. Texts are handled in blocks of
half a megabyte, so that a task's memory does not depend on its partition; six to ten
arrays of eight bytes a byte of text are alive at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = column.type
    if pa.types.is_string(kind) or pa.types.is_binary(kind):
        width = np.int32
    else:
        column = column.cast(pa.large_binary())
        width = np.int64
    if column.null_count:
        column = column.fill_null(b"" if not pa.types.is_string(column.type) else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``size`` bytes: first row, bytes, offsets.  A longer row is a run alone."""
    data, offsets = flat(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))


def spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE):
    """Maximal runs of bytes outside ``breaks``, never across rows: starts, ends, row of each."""
    inside = ~breaks[data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(data):
        before[0] = after[-1] = False
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < len(data))]
        before[cuts] = False
        after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_block_powers: list[tuple[np.ndarray, np.ndarray]] = []  # kept by a worker: one pair, for whole blocks


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and scale factors: ``(sums[e] - sums[s]) * scale[s]`` identifies ``data[s:e]``.

    The powers for a longer text than a block are made anew and not kept.
    """
    if len(data) < 2 * BLOCK_BYTES:
        if not _block_powers:
            _block_powers.append(_powers(2 * BLOCK_BYTES))
        up, down = _block_powers[0]
    else:
        up, down = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= up[: len(data)]
    np.cumsum(terms, out=sums[1:])
    return sums, down


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums, scale = prefix_hash(data)
    return mix((sums[ends] - sums[starts]) * scale[starts] + (ends - starts).astype(np.uint64))


def as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
