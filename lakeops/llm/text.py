"""Whole-batch text work with numpy: the texts of a batch are one byte array with offsets.

All hashes are 64 bits, depend on the bytes alone and are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STEP = 1 << 19  # bytes worked on at once, so that temporary arrays stay small
_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_MULT), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, np.uint64) * _U(2) + _U(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def strings(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.cast(pa.large_string()).chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(offsets[-1] - offsets[0])
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if size else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def steps(offsets: np.ndarray, most: int = STEP) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes together, a longer row alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def folded(raw: np.ndarray) -> np.ndarray:
    """A-Z lower-cased."""
    return _FOLD[raw]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits, one to one."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers up to the n-th; a worker keeps those of a step, not of the longest text it has met."""
    if len(_powers[0]) >= n + 1:
        return _powers
    found = []
    for base in (_MULT, _INVERSE):
        table = np.full(max(n + 1, STEP + 1), base, np.uint64)
        table[0] = 1
        found.append(np.cumprod(table, out=table))
    if n <= STEP:
        _powers[:] = found
    return found


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, of its content and length only. Spans in order of place are
    worked on in steps."""
    if len(raw) > STEP and not (np.any(starts[1:] < starts[:-1]) or np.any(ends[1:] < ends[:-1])):
        found, i = np.zeros(len(starts), np.uint64), 0
        while i < len(starts):
            low = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, low + STEP, "right")))
            found[i:j] = _span_hashes(raw[low : ends[j - 1]], starts[i:j] - low, ends[i:j] - low)
            i = j
        return found
    return _span_hashes(raw, starts, ends)


def _span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _power_tables(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _BYTE[7])


def rolling_hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """``span_hashes`` of all k consecutive bytes."""
    n = len(raw) - k + 1
    up, down = _power_tables(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=total[1:])
    return mix((total[k:] - total[:n]) * down[:n] + _U(k * int(_BYTE[7]) % 2**64))


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes, cut at rows; and each row's first run."""
    cut = np.zeros(len(inside) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(inside), bool)
    before[:1], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(len(inside), bool)
    after[-1:], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``spans`` of the words ``[^\\x20\\x09-\\x0D]+``."""
    return spans(~_SPACE[raw], offsets)


def span_strings(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of each span, which begins and ends between characters, as a string."""
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    data = raw[np.repeat(starts - at[:-1], size) + np.arange(at[-1])]
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(at), pa.py_buffer(data)])


def cell_hashes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A hash of each cell of a string column."""
    raw, offsets = strings(column)
    return span_hashes(raw, offsets[:-1], offsets[1:])


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash of every k consecutive words of one row, the row of each, and the place of its first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed, up = np.zeros(n, np.uint64), _power_tables(k)[0]
    for j in range(k):
        mixed += hashes[j : j + n] * up[j]
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    return mix(mixed[at] + _U(k)), row[at], at


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of ``windows``; a row of fewer words, but not none, has one of all its words."""
    found, row, _ = windows(hashes, first, k)
    counts, up = np.diff(first), _power_tables(k)[0]
    parts, rows = [found], [row]
    for m in range(1, k):
        short = np.flatnonzero(counts == m)
        mixed = np.zeros(len(short), np.uint64)
        for j in range(m):
            mixed += hashes[first[short] + j] * up[j]
        parts.append(mix(mixed + _U(m)))
        rows.append(short)
    return np.concatenate(parts), np.concatenate(rows)


def per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``marks`` between consecutive offsets."""
    total = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def unique_per_row(hashes: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row, rows in order, and n_rows + 1 offsets."""
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.searchsorted(row[new], np.arange(n_rows + 1))


def pack(keys: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit numbers as compressed differences."""
    steps_ = np.diff(keys, prepend=_U(0)).astype("<u8")
    return squeeze(steps_.view(np.uint8).reshape(-1, 8))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(spread(data, 8).view("<u8").ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts of 4 bytes, or of 8 if one needs them; the first byte tells which."""
    width = 4 if counts.max(initial=0) < 2**32 else 8
    return bytes([width]) + squeeze(counts.astype(f"<u{width}").view(np.uint8).reshape(-1, width))


def unpack_counts(data: bytes) -> np.ndarray:
    width = data[0]
    return spread(data[1:], width).view(f"<u{width}").ravel().astype(np.int64)


def squeeze(table: np.ndarray) -> bytes:
    """Byte columns apart, as high bytes are mostly zero."""
    plain = np.ascontiguousarray(table.T).tobytes()
    return len(plain).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(plain, asbytes=True)


def spread(data: bytes, width: int) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    plain = pa.Codec("zstd", 1).decompress(data[8:], size, asbytes=True) if size else b""
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(width, -1).T)
