"""Words and their hashes for whole Arrow batches of texts, in numpy.

A word is a run of ASCII letters, digits and bytes from 0x80 on; A-Z are lower-cased where
asked for.  With ``marks`` runs of other visible characters are words too.  Hashes are
polynomial over the bytes, taken from one running sum over the whole buffer, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64

_kind = np.zeros(256, np.uint8)
_kind[33:127] = 2
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _kind[_low:_high] = 1
_letters = np.where(_kind == 1, _kind, 0).astype(np.uint8)
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_power = np.ones(1, _U)
_inverse = np.ones(1, _U)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _power, _inverse
    if len(_power) < n:
        def table(base: int) -> np.ndarray:
            steps = np.full(n, base, _U)
            steps[0] = 1
            return np.cumprod(steps, dtype=_U)

        _power, _inverse = table(_BASE), table(pow(_BASE, -1, 1 << 64))
    return _power[:n], _inverse[:n]


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        yield row, stop
        row = stop


def _tokens(data: np.ndarray, offsets: np.ndarray, marks: bool, lower: bool):
    kind = (_kind if marks else _letters)[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
    edge[offsets] = True
    at = np.flatnonzero(edge)
    begin, end = at[:-1], at[1:]
    keep = kind[begin] != 0
    begin, end = begin[keep], end[keep]
    power, inverse = _powers(len(data) + 1)
    values = (_lower[data] if lower else data).astype(_U) + _U(1)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(values * power[:-1], out=total[1:])
    return begin, end, mix((total[end] - total[begin]) * inverse[begin])


def words(data: np.ndarray, offsets: np.ndarray, marks: bool = False, lower: bool = True):
    """(row, hash, n_bytes) of all words of the rows, in text order.

    Buffers beyond ``PIECE`` bytes are taken in pieces cut between words, so the tables of
    powers stay small for any length of a text.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none.astype(_U), none
    table = _kind if marks else _letters
    found, left = [], 0
    while left < len(data):
        right = min(len(data), left + PIECE)
        if right < len(data):
            tail = table[data[left:right]]
            change = np.flatnonzero(tail[1:] != tail[:-1])
            if len(change):
                right = left + int(change[-1]) + 1
            else:  # one endless word: go on to its end
                rest = np.flatnonzero(table[data[right:]] != tail[-1])
                right = right + int(rest[0]) if len(rest) else len(data)
        here = offsets[(offsets >= left) & (offsets <= right)] - left
        begin, end, h = _tokens(data[left:right], here, marks, lower)
        found.append((begin + left, h, end - begin))
        left = right
    begin, h, size = (np.concatenate(x) for x in zip(*found))
    return np.searchsorted(offsets, begin, side="right") - 1, h, size


def grams(row: np.ndarray, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all runs of ``k`` words; a row with fewer words, but not none, gives one run of all."""
    if not len(h):
        return row, h
    start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    size = np.diff(np.concatenate([start, [len(h)]]))
    n = len(h) - k + 1
    made = np.zeros(max(n, 0), _U)
    for i in range(k):
        if n > 0:
            made = (made + h[i : i + n]) * _U(_BASE)
    whole = np.flatnonzero(row[: max(n, 0)] == row[k - 1 :]) if n > 0 else np.zeros(0, np.int64)
    short = np.flatnonzero(size < k)
    if not len(short):
        return row[whole], mix(made[whole])
    odd = np.zeros(len(short), _U)
    for i in range(k - 1):
        more = size[short] > i
        odd[more] = (odd[more] + h[start[short[more]] + i]) * _U(_BASE)
    at = np.concatenate([whole, start[short]])
    order = np.argsort(at, kind="stable")
    return row[at][order], np.concatenate([mix(made[whole]), mix(odd ^ _U(0xA5))])[order]
