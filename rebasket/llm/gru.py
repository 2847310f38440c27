"""A gated recurrent language model with a class-factored softmax, in numpy."""

from __future__ import annotations

import heapq

import numpy as np

UNKNOWN, END = 0, 1
HIDDEN = 32
CLASSES = 32
CLASS_WORDS = 64
WORDS = CLASSES * CLASS_WORDS
"""Tokens that the model tells apart: the unknown, the end and the most frequent words."""
WINDOW = 16
"""Steps through which errors are carried back; the state goes on to the next window."""
TRAIN_LANES = 256
RATE = 0.1
CLIP = 5.0
CHUNK = 1 << 15
"""Positions whose softmax is computed together."""

_SHAPES = {
    "input": (WORDS, 3 * HIDDEN),
    "state": (HIDDEN, 3 * HIDDEN),
    "class": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "word": (CLASSES, HIDDEN, CLASS_WORDS),
    "word_bias": (CLASSES, CLASS_WORDS),
}


def fresh(log_share: np.ndarray) -> dict[str, np.ndarray]:
    """Parameters that predict the given natural log shares (-inf: no such token)."""
    generator = np.random.Generator(np.random.PCG64(7))
    made = {k: (0.1 * generator.standard_normal(s)).astype(np.float32) for k, s in _SHAPES.items()}
    shares = np.exp(log_share).reshape(CLASSES, CLASS_WORDS)
    made["class_bias"] = np.log(np.maximum(shares.sum(axis=1), 1e-30)).astype(np.float32)
    made["word_bias"] = np.log(np.maximum(shares, 1e-30)).astype(np.float32)
    for name in ("class", "word"):
        made[name] *= 0.1
    return made


def packed(model: dict[str, np.ndarray]) -> bytes:
    return b"".join(model[k].astype(np.float32).tobytes() for k in _SHAPES)


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    flat, made, at = np.frombuffer(data, np.float32), {}, 0
    for name, shape in _SHAPES.items():
        size = int(np.prod(shape))
        made[name] = flat[at : at + size].reshape(shape).copy()
        at += size
    return made


class Lanes:
    """Texts dealt into lanes that run side by side, longest first, each text whole in one lane.

    At every step the lanes that still have tokens are a prefix, so arrays only
    get shorter.  The input of a text's first token is the end token.
    """

    def __init__(self, texts: list[np.ndarray], most: int = 1024):
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        count = int(np.clip(2 * sizes.sum() // max(int(sizes.max(initial=1)), 1), 128, most))
        loads = [(0, k) for k in range(min(count, len(texts)))]
        lanes: list[list[int]] = [[] for _ in loads]
        for number in order.tolist():
            load, k = heapq.heappop(loads)
            lanes[k].append(number)
            heapq.heappush(loads, (load + int(sizes[number]), k))
        total = np.array([sizes[lane].sum() for lane in lanes], np.int64)
        by_load = np.argsort(-total, kind="stable")
        self.steps = int(total.max(initial=0))
        shape = (self.steps, len(lanes))
        self.target = np.zeros(shape, np.int16)
        self.given = np.zeros(shape, np.int16)
        self.owner = np.zeros(shape, np.int32)
        self.first = np.zeros(shape, bool)
        for column, k in enumerate(by_load.tolist()):
            at = 0
            for number in lanes[k]:
                text = texts[number]
                end = at + len(text)
                self.target[at:end, column] = text
                self.given[at + 1 : end, column] = text[:-1]
                self.given[at, column] = END
                self.first[at, column] = True
                self.owner[at:end, column] = number
                at = end
        ascending = np.sort(total)
        self.live = len(lanes) - np.searchsorted(ascending, np.arange(self.steps), "right")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _step(model, h, x):
    """The next state, and what the way back needs."""
    given = model["input"][x]
    back = h @ model["state"]
    n = HIDDEN
    gates = _sigmoid(given[:, : 2 * n] + back[:, : 2 * n])
    z, r = gates[:, :n], gates[:, n:]
    inner = back[:, 2 * n :]
    new = np.tanh(given[:, 2 * n :] + r * inner)
    return new + z * (h - new), (z, r, inner, new)


def _shares(x: np.ndarray) -> np.ndarray:
    """Softmax of each column, in place.  Numpy adds up rows much faster than within them."""
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x /= x.sum(axis=0)
    return x


def _log_share(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The logarithm of the softmax of each column, at its chosen row; ``x`` is overwritten."""
    x -= x.max(axis=0)
    own = x[chosen, np.arange(x.shape[1])]
    np.exp(x, out=x)
    return own - np.log(x.sum(axis=0))


def _logits(states: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """A column per state."""
    found = weights.T @ states.T
    found += bias[:, None]
    return found


def _by_class(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their classes, and where each class starts."""
    order = np.argsort(group.astype(np.uint8), kind="stable")  # a radix sort
    return order, np.searchsorted(group[order], np.arange(CLASSES + 1))


def log_chance(model, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probability of each target: of its class, then of the word in it."""
    group, word = targets // CLASS_WORDS, targets % CLASS_WORDS
    found = _log_share(_logits(states, model["class"], model["class_bias"]), group)
    order, cuts = _by_class(group)
    sorted_states, sorted_words = states[order], word[order]
    inner = np.empty(len(order), found.dtype)
    for c in range(CLASSES):
        own = slice(cuts[c], cuts[c + 1])
        if cuts[c] < cuts[c + 1]:
            logits = _logits(sorted_states[own], model["word"][c], model["word_bias"][c])
            inner[own] = _log_share(logits, sorted_words[own])
    found[order] += inner
    return found


def score(model, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each whole text, the state carried from end to end."""
    lanes, sums = Lanes(texts), np.zeros(len(texts))
    h = np.zeros((lanes.target.shape[1], HIDDEN), np.float32)
    kept: list[np.ndarray] = []
    held, start = 0, 0
    for t in range(lanes.steps):
        live = lanes.live[t]
        h = h[:live]
        first = lanes.first[t, :live]
        if first.any():
            h = np.where(first[:, None], np.float32(0), h)
        h, _ = _step(model, h, lanes.given[t, :live])
        kept.append(h)
        held += live
        if held >= CHUNK or t == lanes.steps - 1:
            rows = range(start, t + 1)
            targets = np.concatenate([lanes.target[k, : lanes.live[k]] for k in rows]).astype(np.int64)
            owners = np.concatenate([lanes.owner[k, : lanes.live[k]] for k in rows])
            found = log_chance(model, np.concatenate(kept), targets)
            sums += np.bincount(owners, weights=found, minlength=len(texts))
            kept, held, start = [], 0, t + 1
    return sums


class Trainer:
    """Adagrad over windows of truncated backpropagation through time."""

    def __init__(self, model: dict[str, np.ndarray], rate: float = RATE):
        self.model = {k: v.copy() for k, v in model.items()}
        self.past = {k: np.full(v.shape, 1e-4, np.float32) for k, v in model.items()}
        self.rate = rate
        self.tokens = 0

    def learn(self, texts: list[np.ndarray]) -> None:
        lanes = Lanes(texts, TRAIN_LANES)
        h = np.zeros((lanes.target.shape[1], HIDDEN), np.float32)
        for begin in range(0, lanes.steps, WINDOW):
            h = self._window(lanes, begin, min(begin + WINDOW, lanes.steps), h[: lanes.live[begin]])

    def _window(self, lanes: Lanes, begin: int, end: int, h: np.ndarray) -> np.ndarray:
        model, trail = self.model, []
        for t in range(begin, end):
            live = lanes.live[t]
            first = lanes.first[t, :live]
            h = np.where(first[:, None], np.float32(0), h[:live])
            new, inside = _step(model, h, lanes.given[t, :live])
            trail.append((h, new, inside, first))
            h = new
        states = np.concatenate([s[1] for s in trail])
        targets = np.concatenate([lanes.target[t, : lanes.live[t]] for t in range(begin, end)]).astype(np.int64)
        grads, to_states = self._output(states, targets)
        cuts = np.cumsum([len(s[0]) for s in trail])[:-1]
        errors = np.split(to_states, cuts)
        n, following = HIDDEN, np.zeros((0, HIDDEN), np.float32)
        into, back = [], []
        for (h0, _, (z, r, inner, new), first), error in zip(reversed(trail), reversed(errors)):
            d = error
            d[: len(following)] += following
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (h0 - new) * z * (1 - z)
            d_r = d_new * inner * r * (1 - r)
            to_back = np.concatenate((d_z, d_r, d_new * r), axis=1)
            into.append(np.concatenate((d_z, d_r, d_new), axis=1))
            back.append((h0, to_back))
            following = d * z + to_back @ model["state"].T
            following[first] = 0
        grads["state"] = sum(a.T @ b for a, b in back)
        given = np.concatenate([lanes.given[t, : lanes.live[t]] for t in range(begin, end)])
        self._apply(grads, given, np.concatenate(into[::-1]), len(targets))
        self.tokens += len(targets)
        return h

    def _output(self, states: np.ndarray, targets: np.ndarray):
        model = self.model
        group, word = targets // CLASS_WORDS, targets % CLASS_WORDS
        error = _shares(_logits(states, model["class"], model["class_bias"]))
        error[group, np.arange(len(group))] -= 1
        grads = {"class": states.T @ error.T, "class_bias": error.sum(axis=1)}
        to_states = error.T @ model["class"].T
        grads["word"] = np.zeros_like(model["word"])
        grads["word_bias"] = np.zeros_like(model["word_bias"])
        order, cuts = _by_class(group)
        sorted_states, sorted_words = states[order], word[order]
        inner_to_states = np.empty_like(to_states)
        for c in range(CLASSES):
            own = slice(cuts[c], cuts[c + 1])
            if cuts[c] < cuts[c + 1]:
                inner = _shares(_logits(sorted_states[own], model["word"][c], model["word_bias"][c]))
                inner[sorted_words[own], np.arange(inner.shape[1])] -= 1
                grads["word"][c] = sorted_states[own].T @ inner.T
                grads["word_bias"][c] = inner.sum(axis=1)
                inner_to_states[own] = inner.T @ model["word"][c].T
        to_states[order] += inner_to_states
        return grads, to_states

    def _apply(self, grads, given: np.ndarray, into: np.ndarray, tokens: int) -> None:
        order = np.argsort(given, kind="stable")  # a radix sort of 16 bits
        words, cuts = np.unique(given[order], return_index=True)
        rows = np.add.reduceat(into[order], cuts, axis=0) / tokens
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values())) / tokens
        scale = min(1.0, CLIP / max(norm, 1e-12)) / tokens
        for name, grad in grads.items():
            grad = grad * np.float32(scale)
            self.past[name] += grad * grad
            self.model[name] -= self.rate * grad / np.sqrt(self.past[name])
        past = self.past["input"]
        past[words] += rows * rows
        self.model["input"][words] -= self.rate * rows / np.sqrt(past[words])
