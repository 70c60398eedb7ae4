"""A small causal self-attention model over token classes, in numpy.

One head attends over the inputs up to a position; its output and the last input's own
vector give the logits of the next token's class. Inputs share a table of hashed
vectors. Scoring looks the queries, keys and values of all inputs up in tables, and
handles many windows of ``BLOCK`` targets at once: each sees the block before it too, so
that windows overlap and every token is scored once.
"""

from __future__ import annotations

import numpy as np

WIDTH, BUCKETS, CLASSES = 16, 4096, 64
BLOCK = 16
WINDOW = 2 * BLOCK
START, PAD = BUCKETS, BUCKETS + 1

SHAPES = {
    "inputs": (BUCKETS + 2, WIDTH),
    "query": (WIDTH, WIDTH),
    "key": (WIDTH, WIDTH),
    "value": (WIDTH, WIDTH),
    "distance": (WINDOW,),
    "out": (2 * WIDTH, CLASSES),
    "bias": (CLASSES,),
}

Weights = dict[str, np.ndarray]


def flat(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in SHAPES])


def shaped(values: np.ndarray) -> Weights:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = np.asarray(values[at : at + size], np.float32).reshape(shape)
        at += size
    return out


def initial(shares: np.ndarray, seed: int = 1) -> Weights:
    """Small random weights; the bias holds the classes' log shares."""
    rng = np.random.default_rng(seed)
    found = {n: (rng.standard_normal(s) * 0.1).astype(np.float32) for n, s in SHAPES.items()}
    for name in ("query", "key", "value"):
        found[name] += np.eye(WIDTH, dtype=np.float32) * 0.5
    found["distance"][:] = 0
    found["out"] *= 0.1
    found["bias"] = np.log(shares + 1e-6).astype(np.float32)
    return found


def bucket(ids: np.ndarray) -> np.ndarray:
    """Input bucket of token ids: the first ones by themselves, the others by a hash."""
    mixed = (ids.astype(np.int64) * 2654435761 >> 7) % (BUCKETS // 2) + BUCKETS // 2
    return np.where(ids < BUCKETS // 2, ids, mixed).astype(np.int32)


def _distances(length: int) -> np.ndarray:
    """Distance from each query to each key of a window, and beyond it for later keys."""
    i = np.arange(length)
    return i[:, None] - i[None, :]


def loss_and_gradient(weights: Weights, inputs: np.ndarray, targets: np.ndarray) -> tuple[float, Weights]:
    """Mean loss over the targets that are not negative, and its gradient."""
    n, length = inputs.shape
    away = _distances(length)
    later = away < 0
    root = float(np.sqrt(WIDTH))
    kind = weights["inputs"].dtype
    e = weights["inputs"][inputs]
    q, k, v = (e @ weights[name] for name in ("query", "key", "value"))
    a = q @ k.transpose(0, 2, 1)
    a /= root
    a += np.where(later, kind.type(-1e9), weights["distance"][np.maximum(away, 0)])
    pad = inputs == PAD
    edge = np.flatnonzero(pad.any(1))
    a[edge] += np.where(pad[edge], kind.type(-1e9), kind.type(0))[:, None, :]
    a -= a.max(2, keepdims=True)
    np.exp(a, out=a)
    a /= a.sum(2, keepdims=True)
    z = np.concatenate([a @ v, e], 2).reshape(-1, 2 * WIDTH)
    p = z @ weights["out"]
    p += weights["bias"]
    p -= p.max(1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(1, keepdims=True)
    wanted = targets.ravel()
    rows = np.flatnonzero(wanted >= 0)
    cols = wanted[rows]
    total = max(1, len(rows))
    loss = float(-np.log(p[rows, cols] + 1e-12).sum() / total)

    p[rows, cols] -= 1
    if len(rows) < len(p):
        p[wanted < 0] = 0
    p /= total
    g = {"out": z.T @ p, "bias": p.sum(0)}
    d_z = (p @ weights["out"].T).reshape(n, length, 2 * WIDTH)
    d_o, d_e = d_z[:, :, :WIDTH], d_z[:, :, WIDTH:].copy()
    d_v = a.transpose(0, 2, 1) @ d_o
    d_s = d_o @ v.transpose(0, 2, 1)
    d_s -= np.einsum("nij,nij->ni", d_s, a)[:, :, None]
    d_s *= a
    g["distance"] = np.bincount(away[~later], d_s.sum(0)[~later], WINDOW).astype(kind)
    d_s /= root
    for name, d in (("query", d_s @ k), ("key", d_s.transpose(0, 2, 1) @ q), ("value", d_v)):
        g[name] = e.reshape(-1, WIDTH).T @ d.reshape(-1, WIDTH)
        d_e += d @ weights[name].T
    g["inputs"] = np.zeros_like(weights["inputs"])
    order = np.argsort(inputs.ravel().astype(np.uint16), kind="stable")
    met = inputs.ravel()[order]
    first = np.flatnonzero(np.diff(met, prepend=-1))
    g["inputs"][met[first]] = np.add.reduceat(d_e.reshape(-1, WIDTH)[order], first, axis=0)
    return loss, g


class Trainer:
    """Adam over windows in the order in which they come, ``batch`` of them a step."""

    def __init__(self, weights: Weights, batch: int = 64, rate: float = 0.01):
        self.weights = {n: w.copy() for n, w in weights.items()}
        self.mean = {n: np.zeros_like(w) for n, w in weights.items()}
        self.square = {n: np.zeros_like(w) for n, w in weights.items()}
        self.batch, self.rate = batch, rate
        self.steps = self.windows = 0
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, inputs: np.ndarray, targets: np.ndarray) -> None:
        """More windows; those that do not fill a step wait for the next ones."""
        self.windows += len(inputs)
        self.waiting.append((inputs, targets))
        self.held += len(inputs)
        if self.held < self.batch:
            return
        x, y = (np.concatenate(part) for part in zip(*self.waiting))
        full = len(x) - len(x) % self.batch
        for at in range(0, full, self.batch):
            self._step(x[at : at + self.batch], y[at : at + self.batch])
        self.waiting, self.held = [(x[full:], y[full:])], len(x) - full

    def _step(self, inputs: np.ndarray, targets: np.ndarray) -> None:
        _, g = loss_and_gradient(self.weights, inputs, targets)
        self.steps += 1
        even, grown = 1 - 0.9**self.steps, float(np.sqrt(1 - 0.99**self.steps))
        for n, w in self.weights.items():
            mean, square = self.mean[n], self.square[n]
            mean += 0.1 * (g[n] - mean)
            square += 0.01 * (g[n] ** 2 - square)
            w -= (self.rate / even) * mean / (np.sqrt(square) / grown + 1e-6)

    def summed(self) -> np.ndarray:
        """The number of windows, and the weights after the last of them times that number."""
        if self.held:
            self._step(*(np.concatenate(part) for part in zip(*self.waiting)))
            self.waiting, self.held = [], 0
        values = flat(self.weights).astype(np.float64)
        return np.concatenate([[1.0], values]) * self.windows


class Scorer:
    """Log10 class probabilities of every token of some texts."""

    def __init__(self, weights: Weights, blocks: int = 256):
        e = weights["inputs"]
        self.tables = [e @ weights[n] for n in ("query", "key", "value")]
        self.tables[0] = self.tables[0] / np.float32(np.sqrt(WIDTH))
        away = np.arange(BLOCK)[:, None] + BLOCK - np.arange(WINDOW)[None, :]
        self.bias = np.where(away >= 0, weights["distance"][np.maximum(away, 0)], -1e9).astype(np.float32)
        self.own = e @ weights["out"][WIDTH:] + weights["bias"]
        self.out = np.ascontiguousarray(weights["out"][:WIDTH])
        self.blocks = blocks
        longest = lambda x, axis: float(np.linalg.norm(x, axis=axis).max())
        query, key, value = self.tables
        # what exp() can meet at most; shifting the values first is needed only beyond that
        scores = longest(query, 1) * longest(key, 1) + float(weights["distance"].max())
        self.tame_scores = scores < 80
        logits = longest(value, 1) * longest(self.out, 0) + float(np.abs(self.own).max())
        self.tame_logits = logits < 80

    def score(self, ids: np.ndarray, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log10 probability of each token's class given the tokens before it in its text.

        ``counts`` has the number of tokens of each text, at least one.
        """
        rows = -(-counts // BLOCK)
        begin = np.cumsum(counts) - counts
        slot = np.arange(len(ids)) - np.repeat(begin, counts)
        base = (np.cumsum(rows) - rows + np.arange(1, len(counts) + 1)) * BLOCK
        place = np.repeat(base, counts) + slot
        slots = int(rows.sum() + len(counts)) * BLOCK
        inputs = np.full(slots, PAD, np.int32)
        inputs[place[1:]] = bucket(ids[:-1])
        inputs[base] = START
        target = np.zeros(slots, np.int32)
        target[place] = classes
        inputs, target = inputs.reshape(-1, BLOCK), target.reshape(-1, BLOCK)
        scored = np.ones(len(inputs), bool)
        scored[base // BLOCK - 1] = False
        out = np.empty(inputs.shape, np.float32)
        todo = np.flatnonzero(scored)
        query, key, value = self.tables
        for at in range(0, len(todo), self.blocks):
            r = todo[at : at + self.blocks]
            seen = np.concatenate([inputs[r - 1], inputs[r]], 1)
            a = query[inputs[r]] @ key[seen].transpose(0, 2, 1)
            a += self.bias
            pad = seen == PAD
            edge = np.flatnonzero(pad.any(1))
            a[edge] += np.where(pad[edge], np.float32(-1e9), np.float32(0))[:, None, :]
            if not self.tame_scores:
                a -= a.max(2, keepdims=True)
            np.exp(a, out=a)
            attended = a @ value[seen]
            attended /= a.sum(2, keepdims=True)
            logits = attended.reshape(-1, WIDTH) @ self.out
            logits += self.own[inputs[r].ravel()]
            if not self.tame_logits:
                logits -= logits.max(1, keepdims=True)
            chosen = logits[np.arange(len(logits)), target[r].ravel()]
            np.exp(logits, out=logits)
            out[r] = (chosen - np.log(logits.sum(1))).reshape(-1, BLOCK)
        return out.ravel()[place] / np.float32(np.log(10))
