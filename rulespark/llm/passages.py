"""Anchors of fixed-length windows of bytes, for a block of texts at a time.

Every window of ``length`` bytes has an anchor: of its runs of ``SEED`` bytes the one
whose hash is least. Equal windows have equal anchors at the same place, and most
consecutive windows share one, so windows are handled in runs that share an anchor.
"""

from typing import NamedTuple

import numpy as np

from .shingles import _BASE, _INVERSE, _power, mixed

SEED = 32
_PIECE = 1 << 16
_LOW = np.uint64((1 << 20) - 1)


class Runs(NamedTuple):
    """Consecutive windows with one anchor: first window, windows, hashes of anchor and bytes."""

    first: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    whole: np.ndarray


def _prefix_sums(data):
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=sums[1:])
    return sums


def _least(values, width):
    """The least of every ``width`` consecutive values."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def window_starts(sizes, length):
    """For texts one after the other: which places start a window that stays in its text."""
    ends = np.cumsum(sizes)
    edge = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int32)
    np.add.at(edge, ends - sizes, 1)
    np.add.at(edge, np.maximum(ends - sizes, ends - length + 1), -1)
    return np.cumsum(edge)[:-1] > 0


def runs_of(data, valid, length):
    """The runs of all windows of a block, in order."""
    found = []
    for begin in range(0, len(data), _PIECE):
        piece = data[begin : begin + _PIECE + length - 1]
        starts = len(piece) - length + 1
        if starts <= 0:
            break
        own = valid[begin : begin + starts]
        sums, inverse = _prefix_sums(piece), _power(_INVERSE, len(piece))
        seeds = mixed((sums[SEED:] - sums[: len(piece) - SEED + 1]) * inverse[: len(piece) - SEED + 1])
        keyed = (seeds & ~_LOW) | np.arange(len(seeds), dtype=np.uint64)
        place = (_least(keyed, length - SEED + 1)[:starts] & _LOW).astype(np.int64)
        fresh = own.copy()
        fresh[1:] &= ~own[:-1] | (place[1:] != place[:-1])
        first = np.flatnonzero(fresh)
        last = np.flatnonzero(own & np.concatenate((fresh[1:] | ~own[1:], [True])))
        at = place[first]
        whole = (sums[last + length] - sums[first]) * inverse[first]
        shape = (last - first).astype(np.uint64) * np.uint64(1 << 20) + (at - first).astype(np.uint64)
        # least hashes are all small: spread them again, as parts are dealt by their leading bits
        anchors = mixed(seeds[at] ^ np.uint64(_BASE))
        found.append((first + begin, last - first + 1, anchors, mixed(whole ^ mixed(shape + np.uint64(1)))))
    if not found:
        return Runs(*(np.zeros(0, kind) for kind in ("i8", "i8", "u8", "u8")))
    return Runs(*(np.concatenate(parts) for parts in zip(*found)))


def window_hashes(data, first, count, length):
    """A hash of each window of the given runs, run by run."""
    hashes = []
    for begin, many in zip(first.tolist(), count.tolist()):
        piece = data[begin : begin + many + length - 1]
        sums = _prefix_sums(piece)
        hashes.append((sums[length:] - sums[:many]) * _power(_INVERSE, many))
    return mixed(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
