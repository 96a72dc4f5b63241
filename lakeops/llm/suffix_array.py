"""Suffix arrays of a block of bytes by two-stage sorting, with numpy.

Only suffixes smaller than their successor (type S) are sorted directly, by their first DEPTH
bytes. The others (type L) are induced: scanning the first-byte buckets in order, every suffix
found puts its predecessor, if of type L, at the head of the predecessor's bucket. A bucket is
scanned a batch at a time; only a run of one repeated byte takes a batch for each of its bytes.

Suffixes equal in their first DEPTH bytes stand together, in any order; that is enough for common
prefixes up to DEPTH.
"""

from __future__ import annotations

import numpy as np

DEPTH = 56  # in words of 8 bytes


def words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as a big-endian number; zeros follow the end, DEPTH more places of them too."""
    n = len(data)
    padded = np.zeros(n + DEPTH + 8, np.uint8)
    padded[:n] = data
    out = np.zeros(n + DEPTH, np.uint64)
    for k in range(8):
        out <<= np.uint64(8)
        out |= padded[k : k + n + DEPTH]
    return out


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """Type S places: the first different byte that follows is greater. The last place is of type L."""
    n = len(data)
    ends = np.append(np.flatnonzero(data[1:] != data[:-1]), n - 1)
    grows = np.zeros(len(ends), bool)
    grows[:-1] = data[ends[:-1]] < data[ends[:-1] + 1]
    return np.repeat(grows, np.diff(np.append(-1, ends)))


def _sorted_directly(places: np.ndarray, word: np.ndarray, depth: np.ndarray | None) -> np.ndarray:
    """Places in the order of the DEPTH bytes that begin there, or of fewer where ``depth`` is less."""
    first = word[places]
    order = np.argsort(first, kind="stable")
    places, key = places[order], first[order]
    group = np.cumsum(np.append(False, key[1:] != key[:-1])) if len(places) else np.zeros(0, np.int64)
    open_ = np.arange(len(places))
    for at in range(8, DEPTH, 8):
        same = group[open_][1:] == group[open_][:-1]
        tied = np.append(False, same) | np.append(same, False) if len(open_) else np.zeros(0, bool)
        open_ = open_[tied]
        if depth is not None:
            open_ = open_[depth[places[open_]] > at]
        if not len(open_):
            break
        own, key = group[open_], word[places[open_] + at]
        order = np.lexsort((key, own))
        places[open_] = places[open_][order]
        own, key = own[order], key[order]
        # Groups keep the number of their first member's place, so that numbers stay in order.
        new = np.append(True, (own[1:] != own[:-1]) | (key[1:] != key[:-1]))
        group[open_] = open_[np.flatnonzero(new)][np.cumsum(new) - 1] + len(places)
    return places


def suffix_array(data: np.ndarray, word: np.ndarray | None = None, depth: np.ndarray | None = None) -> np.ndarray:
    """All places in the order of the suffixes that begin there, to DEPTH bytes.

    ``depth`` may say how many bytes count at each place, if it falls by one at most from a place to
    the next: two places then stand in the order of as many bytes as count at both.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    word = words(data) if word is None else word
    small = smaller_than_next(data)
    count = np.bincount(data, minlength=256)
    count_large = np.bincount(data[~small], minlength=256)
    begin = np.concatenate([[0], np.cumsum(count)])
    head = begin[:-1].copy()
    out = np.empty(n, np.int64)

    direct = _sorted_directly(np.flatnonzero(small), word, depth)
    first = np.concatenate([[0], np.cumsum(count - count_large)])
    for c in np.flatnonzero(count - count_large):
        out[begin[c] + count_large[c] : begin[c + 1]] = direct[first[c] : first[c + 1]]

    def induce(batch: np.ndarray) -> None:
        before = batch[batch > 0] - 1
        before = before[~small[before]]
        byte = data[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        per = np.bincount(byte, minlength=256)
        rank = np.arange(len(before)) - np.repeat(np.cumsum(per) - per, per)
        out[head[byte] + rank] = before
        head[:] += per

    out[head[data[n - 1]]] = n - 1  # the end precedes all suffixes
    head[data[n - 1]] += 1
    for c in np.flatnonzero(count):
        done = begin[c]
        while done < head[c]:
            upto = head[c]
            induce(out[done:upto])
            done = upto
        induce(out[begin[c] + count_large[c] : begin[c + 1]])
    return out


def common_prefixes(order: np.ndarray, word: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix in order with the one before it, up to ``most`` bytes; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for at in range(0, most, 8):
        differ = word[order[live] + at] ^ word[order[live - 1] + at]
        equal = differ == 0
        rest = differ[~equal]
        # leading zero bytes of a difference
        bytes_ = sum(((rest >> np.uint64(8 * k)) == 0).astype(np.int64) for k in range(1, 8)) if len(rest) else 0
        out[live[~equal]] = np.minimum(at + bytes_, most)
        live = live[equal]
    out[live] = most
    return out
