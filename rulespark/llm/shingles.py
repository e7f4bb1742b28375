"""Sets of hashed word shingles, for a batch of texts at a time."""

import numpy as np

WORDS = 5
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PART = 1 << 20
_powers = {}


def mixed(values):
    """A bijection that spreads every bit of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power(base, count):
    held = _powers.get(base)
    if held is None or len(held) < count:
        held = np.full(max(count, 1024), base, np.uint64)
        held[0] = 1
        held = _powers[base] = np.multiply.accumulate(held)
    return held[:count]


def _factors(count, seed):
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


def _word_hashes(data):
    """Hashes and starts of the words of one run of bytes, from sums of its prefixes."""
    space = _SPACE[data]
    edges = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts]), starts


def _parts(texts):
    """Runs of texts of about a megabyte together; a longer text is a run of its own."""
    begin, size = 0, 0
    for place, text in enumerate(texts):
        if size and size + len(text) > _PART:
            yield begin, place
            begin, size = place, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def shingle_sets(texts, words=WORDS):
    """Per UTF-8 text the sorted distinct hashes of its runs of ``words`` words.

    Words are what white space parts, with A to Z in lower case. A text of fewer words
    has one shingle of them all, one without words none.
    """
    sets = []
    factors = _factors(words, 1)
    for begin, end in _parts(texts):
        part = texts[begin:end]
        data = np.frombuffer(b"\n".join(text.lower() for text in part) + b"\n", np.uint8)
        hashes, starts = _word_hashes(data)
        limits = np.searchsorted(starts, np.concatenate(([0], np.cumsum([len(text) + 1 for text in part]))))
        if len(hashes) >= words:
            rows = len(hashes) - words + 1
            whole = np.zeros(rows, np.uint64)
            for place in range(words):
                whole += hashes[place : place + rows] * factors[place]
            whole = mixed(whole)
        for first, last in zip(limits, limits[1:]):
            if last - first >= words:
                sets.append(np.unique(whole[first : last - words + 1]))
            elif last > first:
                few = hashes[first:last] * factors[: last - first]
                sets.append(mixed(np.array([few.sum(dtype=np.uint64) + np.uint64(last - first)])))
            else:
                sets.append(np.zeros(0, np.uint64))
    return sets


def set_digest(hashes):
    """128 bits of a set as two signed longs; None for the empty set."""
    if not len(hashes):
        return None
    high = mixed(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    low = mixed(hashes + np.uint64(0x0123456789ABCDEF)).sum(dtype=np.uint64)
    return int(high.astype(np.int64)), int(low.astype(np.int64))


def min_hashes(hashes, count, seed=7):
    """The least values of a set under ``count`` (even) hash functions, 32 bits each."""
    factors = _factors(count // 2, seed)
    least = np.full(count, 0xFFFFFFFF, np.uint32)
    for begin in range(0, len(hashes), 1024):
        product = hashes[begin : begin + 1024, None] * factors
        np.minimum(least, product.view(np.uint32).min(axis=0), out=least)
    return least


def prefix_hashes(least, trees, depth):
    """One hash per tree of the first ``depth`` values of its label."""
    labels = least.reshape(trees, depth).astype(np.uint64)
    return mixed((labels * _factors(depth, 11)).sum(axis=1, dtype=np.uint64) + _factors(trees, 13)).astype(np.int64)
