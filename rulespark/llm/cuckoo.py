"""A cuckoo filter over pairs of 64-bit hashes, with removal and growth."""

import numpy as np

SLOTS, KICKS = 4, 200
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _places(high, low, buckets):
    """Fingerprints, and both buckets of each key; either follows from the other."""
    high, low = high.astype(np.uint64), low.astype(np.uint64)
    marks = (high >> np.uint64(48)) + np.uint64(1)
    marks = np.minimum(marks, np.uint64(0xFFFF)).astype(np.uint16)
    first = (low & np.uint64(buckets - 1)).astype(np.int64)
    return marks, first, first ^ _step(marks, buckets)


def _step(marks, buckets):
    mixed = marks.astype(np.uint64) * _SPREAD
    return ((mixed >> np.uint64(32)) & np.uint64(buckets - 1)).astype(np.int64)


class CuckooFilter:
    """Says no only for keys that aren't in it. Tables are added as they fill up.

    A key must be put in once and taken out once; what it stands for is counted outside.
    Where several tables show a key's mark, one of them may be another key's: ``remove``
    then leaves them all, which can only let through more. Who wants them gone builds anew.
    """

    def __init__(self, tables=()):
        self.tables = list(tables)

    @classmethod
    def loads(cls, data):
        tables, at = [], 0
        while at < len(data):
            buckets = int.from_bytes(data[at : at + 8], "little")
            size = buckets * SLOTS * 2
            tables.append(np.frombuffer(data, np.uint16, buckets * SLOTS, at + 8).reshape(buckets, SLOTS).copy())
            at += 8 + size
        return cls(tables)

    def dumps(self):
        return b"".join(len(table).to_bytes(8, "little") + table.tobytes() for table in self.tables)

    def contains(self, high, low):
        found = np.zeros(len(high), bool)
        for table in self.tables:
            marks, first, second = _places(high, low, len(table))
            found |= (table[first] == marks[:, None]).any(1) | (table[second] == marks[:, None]).any(1)
        return found

    def insert(self, high, low):
        left = np.arange(len(high))
        if not self.tables and len(left):
            self._grow(len(left))
        while len(left):
            table = self.tables[-1]
            marks, first, second = _places(high[left], low[left], len(table))
            refused = [
                at for at, mark, *ways in zip(left.tolist(), marks.tolist(), first.tolist(), second.tolist())
                if not self._put(table, mark, ways)
            ]
            left = np.array(refused, np.int64)
            if len(left):
                self._grow(max(len(left), len(table) * SLOTS))

    def remove(self, high, low):
        for at in range(len(high)):
            shown = []
            for table in self.tables:
                marks, first, second = _places(high[at : at + 1], low[at : at + 1], len(table))
                bucket = next((way for way in (int(first[0]), int(second[0])) if (table[way] == marks[0]).any()), None)
                if bucket is not None:
                    shown.append((table, bucket, int(np.argmax(table[bucket] == marks[0]))))
            if len(shown) == 1:
                table, bucket, slot = shown[0]
                table[bucket, slot] = 0

    def _grow(self, keys):
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8)))))
        self.tables.append(np.zeros((buckets, SLOTS), np.uint16))

    def _put(self, table, mark, ways):
        path, bucket = [], ways[0]
        for way in ways:
            free = np.flatnonzero(table[way] == 0)
            if len(free):
                table[way, free[0]] = mark
                return True
        for turn in range(KICKS):
            slot = turn % SLOTS
            path.append((bucket, slot, int(table[bucket, slot])))
            mark, table[bucket, slot] = int(table[bucket, slot]), mark
            bucket ^= int(_step(np.array([mark], np.uint16), len(table))[0])
            free = np.flatnonzero(table[bucket] == 0)
            if len(free):
                table[bucket, free[0]] = mark
                return True
        for bucket, slot, before in reversed(path):
            table[bucket, slot] = before
        return False
