"""A run-length index of many short texts: their Burrows-Wheeler transform by its runs."""

import numpy as np


def _rank(keys):
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


class RunIndex:
    """The transform as runs of equal bytes, with a text place sampled at each run's end.

    ``breaks`` are the rows of the sorted suffixes that agree on fewer than ``depth``
    bytes with the row before, or are shorter; so the rows between two breaks are those
    of one string of ``depth`` bytes. Texts end in ends of text, which order by text.
    """

    def __init__(self, data, sizes, depth):
        sizes = np.asarray(sizes, np.int64)
        self.sizes, self.depth, count = sizes, depth, len(sizes)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        ends = self.starts + sizes
        symbols = np.zeros(len(data) + count, np.int64)
        inner = np.ones(len(symbols), bool)
        inner[ends] = False
        symbols[inner] = data.astype(np.int64) + 1
        rank, window = self._ranks(symbols, np.repeat(ends, sizes + 1))
        order = np.argsort(rank, kind="stable")

        before = symbols[order - 1]
        self.run_starts = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        self.heads = before[self.run_starts]
        lengths = np.diff(np.append(self.run_starts, len(before)))
        self.samples = order[self.run_starts + lengths - 1]
        self.steps = np.empty(len(self.heads), np.int64)
        by_head = np.argsort(self.heads, kind="stable")
        # rows in front of all that begin with smaller bytes, then of earlier runs of the same byte
        self.steps[by_head] = np.cumsum(lengths[by_head]) - lengths[by_head]

        windows = window[order]
        self.breaks = np.flatnonzero(np.concatenate(([True], windows[1:] != windows[:-1])) | (windows < 0))

    def _ranks(self, symbols, ends):
        """The order of all suffixes, and of those long enough the order of their first bytes."""
        places = np.arange(len(symbols))
        keys = np.zeros(len(symbols), np.int64)
        for ahead in range(7):
            keys <<= 9
            shifted = symbols[ahead:] * (places[: len(symbols) - ahead] + ahead <= ends[: len(symbols) - ahead])
            keys[: len(shifted)] |= shifted
        rank, width, window = _rank(keys), 7, None
        longest = int(self.sizes.max(initial=0)) + 1

        def joined(ahead):
            then = np.zeros(len(rank), np.int64)
            then[: len(rank) - ahead] = rank[ahead:] + 1
            then[places + ahead > ends] = 0
            return (rank << 32) | then

        while width < max(longest, self.depth):
            if width < self.depth <= 2 * width:
                window = np.where(places + self.depth <= ends, _rank(joined(self.depth - width)), -1)
            rank = _rank(joined(width))
            width *= 2
        if window is None:
            window = np.full(len(rank), -1)
        return rank, window

    def back(self, rows):
        """The row of the suffix one byte longer than each row's."""
        run = np.searchsorted(self.run_starts, rows, side="right") - 1
        return self.steps[run] + rows - self.run_starts[run]

    def matches(self):
        """Streams every text through the index, and says which window equals an earlier one.

        A text is read from its end, one byte a step, for all texts at a time: each step
        leads to the row of the suffix read so far. From the step at which ``depth``
        bytes are read, the rows between the breaks around it are the text's matches of
        at least that length. Returns, text by text, whether an earlier window, of an
        earlier text or place, is among them.
        """
        windows = np.maximum(self.sizes - self.depth + 1, 0)
        offsets = np.cumsum(windows) - windows
        classes = np.empty(int(windows.sum()), np.int64)
        longest_first = np.argsort(-self.sizes, kind="stable")
        rows, sizes = longest_first.copy(), self.sizes[longest_first]
        for step in range(1, int(sizes[0]) + 1 if len(sizes) else 1):
            live = int(np.searchsorted(-sizes, -step, side="right"))
            rows = self.back(rows[:live])
            if step >= self.depth:
                at = longest_first[:live]
                classes[offsets[at] + self.sizes[at] - step] = np.searchsorted(self.breaks, rows, side="right")
        _, first, of = np.unique(classes, return_index=True, return_inverse=True)
        return first[of] < np.arange(len(classes))
