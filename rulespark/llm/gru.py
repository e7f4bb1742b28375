"""A small gated recurrent language model in numpy, with a class-factored output.

Tokens are numbers: ``words`` frequent ones, in classes of ``per_class``, and ``tails``
classes of all others. The model says how likely the next token's class is and, in the
classes of frequent words, how likely the word; within a tail class it says nothing.
Token 0 ends a text. Texts are laid one after the other into lanes that advance together;
the state begins at zero in each text and is carried from window to window.
"""

import heapq
from dataclasses import dataclass

import numpy as np

END = 0
#: Steps of a window at least; with few lanes, as many as make up so many tokens.
WINDOW, WINDOW_TOKENS = 16, 4096


@dataclass(frozen=True)
class Shape:
    words: int = 1024
    per_class: int = 64
    tails: int = 48
    hidden: int = 12

    @property
    def heads(self):
        return self.words // self.per_class

    def parts(self):
        classes, width = self.heads + self.tails, self.hidden
        return {
            "inputs": (self.words + self.tails, 3 * width), "turn": (width, 3 * width), "classes": (width, classes),
            "class_bias": (classes,), "members": (self.heads, width, self.per_class), "member_bias": (self.heads, self.per_class)}

    def size(self):
        return sum(int(np.prod(shape)) for shape in self.parts().values())

    def views(self, flat):
        """The parts of a model as views of one vector."""
        out, at = {}, 0
        for name, shape in self.parts().items():
            size = int(np.prod(shape))
            out[name] = flat[at : at + size].reshape(shape)
            at += size
        return out

    def class_of(self, tokens):
        return np.where(tokens < self.words, tokens // self.per_class, tokens - self.words + self.heads)


def started(shape, counts, seed=5):
    """A model that gives each class and word its share of ``counts``, whatever comes before."""
    flat = np.zeros(shape.size(), np.float32)
    parts, draw = shape.views(flat), np.random.default_rng(seed)
    parts["inputs"][:] = draw.normal(0, 0.3, parts["inputs"].shape)
    parts["turn"][:] = draw.normal(0, shape.hidden**-0.5, parts["turn"].shape)
    smooth = np.asarray(counts, np.float64) + 1
    heads = smooth[: shape.words].reshape(shape.heads, shape.per_class)
    masses = np.concatenate((heads.sum(axis=1), smooth[shape.words :]))
    parts["class_bias"][:] = np.log(masses / masses.sum())
    parts["member_bias"][:] = np.log(heads / heads.sum(axis=1, keepdims=True))
    return flat


def packed(texts, lanes):
    """Texts of tokens in lanes, the longest lane first: tokens and texts' numbers, -1 where none."""
    heap = [(0, lane) for lane in range(min(lanes, len(texts)))]
    held = [[] for _ in heap]
    for at in sorted(range(len(texts)), key=lambda at: -len(texts[at])):
        size, lane = heapq.heappop(heap)
        held[lane].append(at)
        heapq.heappush(heap, (size + len(texts[at]), lane))
    sizes = [sum(len(texts[at]) for at in own) for own in held]
    order = sorted(range(len(held)), key=lambda lane: -sizes[lane])
    tokens = np.full((sizes[order[0]], len(held)), -1, np.int32)
    owners = np.full(tokens.shape, -1, np.int32)
    for place, lane in enumerate(order):
        tokens[: sizes[lane], place] = np.concatenate([texts[at] for at in held[lane]])
        owners[: sizes[lane], place] = np.repeat(held[lane], [len(texts[at]) for at in held[lane]])
    return tokens, owners


def windows(tokens, size=WINDOW, least=WINDOW_TOKENS):
    """Per window its first step, the inputs and the targets of the lanes that still have some.

    Where few lanes are left, the end of the longest texts, windows are longer.
    """
    begin = 0
    while begin < len(tokens):
        active = int((tokens[begin] >= 0).sum())
        end = begin + max(size, least // active)
        targets = tokens[begin:end, :active]
        before = tokens[begin - 1 : begin, :active] if begin else np.full((1, active), END, np.int32)
        yield begin, np.maximum(np.concatenate((before, targets[:-1])), END), targets
        begin = end


def _sigmoid(values):
    np.multiply(values, 0.5, out=values)
    np.tanh(values, out=values)
    np.multiply(values, 0.5, out=values)
    np.add(values, 0.5, out=values)


def _advance(parts, width, inputs, state):
    """States after each step, and what the way back needs."""
    gates = parts["inputs"][inputs]
    ended = inputs == END
    kept, resets = (~ended)[..., None].astype(np.float32), ended.any(axis=1)
    steps, lanes = inputs.shape
    before, states, new, turned = (np.empty((steps, lanes, width), np.float32) for _ in range(4))
    both, moved = np.empty((steps, lanes, 2 * width), np.float32), np.empty((lanes, 3 * width), np.float32)
    for step in range(steps):
        held, now, fresh, turn, gate = before[step], both[step], new[step], turned[step], gates[step]
        if resets[step]:
            np.multiply(state, kept[step], out=held)
        else:
            held[:] = state
        np.matmul(held, parts["turn"], out=moved)
        np.add(gate[:, : 2 * width], moved[:, : 2 * width], out=now)
        _sigmoid(now)
        turn[:] = moved[:, 2 * width :]
        np.multiply(now[:, width:], turn, out=fresh)
        np.add(fresh, gate[:, 2 * width :], out=fresh)
        np.tanh(fresh, out=fresh)
        state = states[step]
        np.subtract(held, fresh, out=state)
        np.multiply(state, now[:, :width], out=state)
        np.add(state, fresh, out=state)
    return states, (kept, before, both, new, turned)


def _back(parts, width, held, wanted, inputs, grads):
    """Adds what the states' gradients mean for the inputs and turns of a window."""
    kept, before, both, new, turned = held
    keep, reset = both[..., :width], both[..., width:]
    to_keep = (before - new) * keep * (1 - keep)
    to_fresh = (1 - keep) * (1 - new * new)
    to_reset = turned * reset * (1 - reset)
    gates, moved = np.empty((*inputs.shape, 3 * width), np.float32), np.empty((*inputs.shape, 3 * width), np.float32)
    back, carried, passed = parts["turn"].T.copy(), np.zeros(before[0].shape, np.float32), np.empty(before[0].shape, np.float32)
    for step in range(len(inputs) - 1, -1, -1):
        change, gate, turn = wanted[step], gates[step], moved[step]
        change += carried
        np.multiply(change, to_keep[step], out=gate[:, :width])
        fresh = gate[:, 2 * width :]
        np.multiply(change, to_fresh[step], out=fresh)
        np.multiply(fresh, to_reset[step], out=gate[:, width : 2 * width])
        turn[:, : 2 * width] = gate[:, : 2 * width]
        np.multiply(fresh, reset[step], out=turn[:, 2 * width :])
        np.matmul(turn, back, out=carried)
        np.multiply(change, keep[step], out=passed)
        carried += passed
        carried *= kept[step]
    grads["turn"] += before.reshape(-1, width).T @ moved.reshape(-1, 3 * width)
    flat, order = inputs.ravel(), np.argsort(inputs.astype(np.uint16).ravel(), kind="stable")
    starts = np.flatnonzero(np.diff(flat[order], prepend=-1))
    grads["inputs"][flat[order][starts]] += np.add.reduceat(gates.reshape(-1, 3 * width)[order], starts)


def _shares(logits):
    """Column by column, in place: shares that are not yet divided by their sums; the sums."""
    np.subtract(logits, logits.max(axis=0), out=logits)
    shares = np.exp(logits)
    return shares, shares.sum(axis=0)


def _output(shape, parts, states, targets, grads=None):
    """Natural logarithms of the targets' classes and words; with ``grads``, the states' gradients too."""
    classes = shape.class_of(targets)
    columns = np.arange(len(targets))
    logits = parts["classes"].T @ states.T
    logits += parts["class_bias"][:, None]
    shares, sums = _shares(logits)
    found = logits[classes, columns] - np.log(sums)
    wanted = None
    if grads is not None:
        shares /= sums
        shares[classes, columns] -= 1
        grads["classes"] += states.T @ shares.T
        grads["class_bias"] += shares.sum(axis=1)
        wanted = (parts["classes"] @ shares).T.copy()
    order = np.argsort(classes.astype(np.int16), kind="stable")
    edges = np.searchsorted(classes[order], np.arange(shape.heads + 1))
    for head in range(shape.heads):
        own = order[edges[head] : edges[head + 1]]
        if not len(own):
            continue
        held, words, at = states[own], targets[own] - head * shape.per_class, columns[: len(own)]
        logits = parts["members"][head].T @ held.T
        logits += parts["member_bias"][head][:, None]
        shares, sums = _shares(logits)
        found[own] += logits[words, at] - np.log(sums)
        if grads is not None:
            shares /= sums
            shares[words, at] -= 1
            grads["members"][head] += held.T @ shares.T
            grads["member_bias"][head] += shares.sum(axis=1)
            wanted[own] += (parts["members"][head] @ shares).T
    return found, wanted


class Trainer:
    """Truncated backpropagation through windows, with a step of Adam's after ``step`` tokens."""

    def __init__(self, shape, flat, rate, step, limit=1.0):
        self.shape, self.flat, self.rate, self.step, self.limit = shape, flat.copy(), rate, step, limit
        self.first, self.second, self.turns = np.zeros_like(flat), np.zeros_like(flat), 0
        self.slope, self.waiting = np.zeros_like(flat), 0

    def window(self, inputs, targets, state):
        """Adds a window's gradient, of the sum over its tokens; returns its loss and the state after it."""
        shape, parts, grads = self.shape, self.shape.views(self.flat), self.shape.views(self.slope)
        states, held = _advance(parts, shape.hidden, inputs, state)
        there = targets.ravel() >= 0
        found, wanted = _output(shape, parts, states.reshape(-1, shape.hidden)[there], targets.ravel()[there], grads)
        if len(found) < targets.size:
            wanted, some = np.zeros((targets.size, shape.hidden), np.float32), wanted
            wanted[there] = some
        _back(parts, shape.hidden, held, wanted.reshape(states.shape), inputs, grads)
        self.waiting += len(found)
        return -float(found.sum()), states[-1]

    def take(self):
        """A step along the mean gradient of the tokens that wait."""
        slope = self.slope / np.float32(self.waiting)
        slope *= np.float32(min(1.0, self.limit / (float(np.sqrt(slope @ slope)) + 1e-12)))
        self.turns += 1
        self.first += np.float32(0.1) * (slope - self.first)
        self.second += np.float32(0.01) * (slope * slope - self.second)
        rate = self.rate * np.sqrt(1 - 0.99**self.turns) / (1 - 0.9**self.turns)
        self.flat -= np.float32(rate) * self.first / (np.sqrt(self.second) + np.float32(1e-6))
        self.slope[:], self.waiting = 0, 0

    def learn(self, texts, lanes):
        tokens, _ = packed(texts, lanes)
        state = np.zeros((tokens.shape[1], self.shape.hidden), np.float32)
        for _, inputs, targets in windows(tokens):
            _, state = self.window(inputs, targets, state[: inputs.shape[1]])
            if self.waiting >= self.step:
                self.take()
        if self.waiting:
            self.take()


def log_likelihoods(shape, flat, texts, lanes=256):
    """Per text the sum of its tokens' natural logarithms, over all of its windows."""
    if not texts:
        return np.zeros(0)
    parts, totals = shape.views(flat), np.zeros(len(texts))
    tokens, owners = packed(texts, lanes)
    state = np.zeros((tokens.shape[1], shape.hidden), np.float32)
    for begin, inputs, targets in windows(tokens):
        states, _ = _advance(parts, shape.hidden, inputs, state[: inputs.shape[1]])
        state = states[-1]
        there = targets.ravel() >= 0
        found, _ = _output(shape, parts, states.reshape(-1, shape.hidden)[there], targets.ravel()[there])
        own = owners[begin : begin + len(targets), : targets.shape[1]].ravel()[there]
        totals += np.bincount(own, found, len(texts))
    return totals
