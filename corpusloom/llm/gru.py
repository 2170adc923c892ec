"""A gated recurrent language model in numpy with a class-factored softmax.

A unit has a gate z and a new part n, both of the word before and the state: h' = z h + (1 - z) n (a gated recurrent unit without reset gate).
A word's log-probability is that of its class plus that of the word in the class, each a softmax over the state after the words before it.
Words are numbered by falling frequency, and a class holds about as many in a row as there are classes. For scoring, documents are dealt to lanes that run side by side, each lane one document after
another; a lane's state is carried from window to window and set back to zero where a document begins, so that a text of any length is scored as a whole.

Training goes through the documents one after another, cut into lanes of one length, so that no lane waits for a long text. A window's step is back-propagated to the window's begin and
changes the rows of words that stand in it and the classes of words that follow, nothing else of the two large tables.
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN, WINDOW, LANES = 24, 64, 256
#: Of training: steps of a window, and for so many windows there are lanes, 16 to 256.
STEPS, WINDOWS, DECAY = 16, 200, 0.98
Params = dict[str, np.ndarray]


def class_size(words: int) -> int:
    """Words of a class, a power of two: somewhat more than the square root, as the word for all others needs no share within its class."""
    return 1 << max(3, round(np.log2(max(words, 1) / 0.6) / 2))


def init(counts: np.ndarray, hidden: int = HIDDEN, seed: int = 42, size: int | None = None) -> Params:
    """Weights that give every word its share of the counts, whatever went before. Numbers with a negative count are no words.
    The last row of c, and of each class in w, is what is added to the logits: states are given a last column of ones."""
    rng = np.random.default_rng(seed)
    size = size or class_size(len(counts))
    classes = -(-len(counts) // size)
    share = np.zeros(classes * size)
    share[: len(counts)] = np.where(counts < 0, 0, counts + 0.1)
    share = (share / share.sum()).reshape(classes, size)
    total = share.sum(axis=1)
    with np.errstate(divide="ignore"):
        within = np.where(share > 0, np.log(share / total[:, None]), -1e4)
    normal = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
    c, w = np.zeros((hidden + 1, classes), np.float32), np.zeros((classes, hidden + 1, size), np.float32)
    c[-1], w[:, -1] = np.log(total), within
    return {"x": normal(0.3, classes * size, 2 * hidden), "u": normal(hidden**-0.5, hidden, 2 * hidden), "xb": np.zeros(2 * hidden, np.float32), "c": c, "w": w}


def _step(u, a, h):
    """a: what the word before says. The gate, the new part, and the state after: the gate's share of the old state and the rest of the new part."""
    n = h.shape[1]
    b = h @ u
    b += a
    np.tanh(b, out=b)
    z, new = b[:, :n], b[:, n:]
    z *= 0.5
    z += 0.5
    out = h - new
    out *= z
    out += new
    return z, new, out


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _exp_sums(x: np.ndarray) -> np.ndarray:
    """Puts exp(x) in x's place, up to a factor for each row, and gives the sums of the rows. Rows are shifted only where numbers would leave the range."""
    if x.max(initial=0) > 60 or x[:, 0].min(initial=0) < -60:
        x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], x.dtype)


def _soft(x: np.ndarray, at: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The log-share at one place of each row, and its negative derivative times scale (in x's place)."""
    k = np.arange(len(at))
    sums = _exp_sums(x)
    ll = np.log(np.maximum(x[k, at] / sums, 1e-38))
    x *= (scale / sums)[:, None]
    x[k, at] -= scale
    return x, ll


def _by_class(word: np.ndarray, p: Params) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by class, and class, begin, end in it, without the first class if that has one word only."""
    size = p["w"].shape[2]
    cls = word // size
    order = np.argsort(cls, kind="stable")
    cls = cls[order]
    cuts = np.flatnonzero(np.diff(cls)) + 1
    begins = [0, *cuts.tolist()] if len(word) else []
    alone = size > 1 and p["w"][0, -1, 1] < -9999
    return order, [(int(cls[a]), a, b) for a, b in zip(begins, [*begins[1:], len(word)], strict=True) if cls[a] or not alone]


def _log_share(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log_softmax(x) at one place of each row. Overwrites x."""
    k = np.arange(len(at))
    own = x[k, at].astype(np.float64)
    top = x.max(axis=1) if x.max(initial=0) > 60 or own.min(initial=0) < -60 else None
    if top is not None:
        x -= top[:, None]
        own -= top
    return own - np.log(np.exp(x, out=x) @ np.ones(x.shape[1], x.dtype))


def _with_ones(h: np.ndarray) -> np.ndarray:
    return np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1)


def word_log_probs(p: Params, h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Natural log-probability of each word after the state in the same row."""
    size = p["w"].shape[2]
    order, parts = _by_class(word, p)
    hs, ws = _with_ones(h[order]), word[order]
    own = _log_share(hs @ p["c"], ws // size)
    ws = ws % size
    for c, a, b in parts:
        own[a:b] += _log_share(hs[a:b] @ p["w"][c], ws[a:b])
    out = np.empty(len(word))
    out[order] = own
    return out


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Documents dealt to lanes of about equal length, the longest lane first."""
    loads = [(0, i) for i in range(max(1, min(lanes, len(lengths))))]
    out: list[list[int]] = [[] for _ in loads]
    for d in np.argsort(-lengths, kind="stable").tolist():
        n, i = heapq.heappop(loads)
        out[i].append(d)
        heapq.heappush(loads, (n + int(lengths[d]), i))
    return sorted(out, key=lambda ds: -sum(int(lengths[d]) for d in ds))


def _streams(docs: list[np.ndarray], end: int, lanes: int) -> tuple:
    """word before, word, document (steps x lanes), number of steps of each lane. Documents end with the word `end`, which also stands before their first word."""
    lengths = np.array([len(d) for d in docs])
    dealt = lanes_of(lengths, lanes)
    steps = np.array([sum(int(lengths[d]) for d in ds) for ds in dealt])
    word = np.full((int(steps[0]), len(dealt)), end, np.int32)
    owner = np.zeros_like(word)
    for i, ds in enumerate(dealt):
        if ds:
            word[: steps[i], i] = np.concatenate([docs[d] for d in ds])
            owner[: steps[i], i] = np.repeat(ds, lengths[ds])
    before = np.vstack([np.full((1, len(dealt)), end, np.int32), word[:-1]])
    return before, word, owner, steps


def log_likelihoods(p: Params, docs: list[np.ndarray], end: int) -> np.ndarray:
    """Natural log-probability of each document, given as word numbers that end with `end`."""
    out = np.zeros(len(docs))
    if not docs:
        return out
    before, word, owner, steps = _streams(docs, end, LANES)
    h = np.zeros((word.shape[1], p["u"].shape[0]), np.float32)
    x = p["x"] + p["xb"]
    live = (steps > np.arange(len(word))[:, None]).sum(axis=1)
    for start in range(0, len(word), WINDOW):
        rows = slice(start, min(start + WINDOW, len(word)))
        states, m = [], live[rows].tolist()
        on = before[rows] != end
        for t, n in enumerate(m):
            h = h[:n] * on[t, :n, None]
            h = _step(p["u"], x[before[rows.start + t, :n]], h)[-1]
            states.append(h)
        valid = np.arange(word.shape[1]) < live[rows][:, None]
        ll = word_log_probs(p, np.concatenate(states), word[rows][valid])
        out += np.bincount(owner[rows][valid], ll, len(docs))
    return out


def gradients(p: Params, before: np.ndarray, word: np.ndarray, live: np.ndarray, h: np.ndarray, end: int) -> tuple[Params, dict[str, np.ndarray], np.ndarray, float]:
    """Of the mean log-loss over a window (steps x lanes; live: which words count), back-propagated to the window's begin; which rows of x and w
    they are of (the others have none), the state after the window, and the loss."""
    steps, lanes = word.shape
    hidden, size = p["u"].shape[0], p["w"].shape[2]
    kind = p["u"].dtype
    a = p["x"][before] + p["xb"]
    on = (before != end).astype(kind)[:, :, None]
    was, out = np.empty((steps, lanes, hidden), kind), np.empty((steps, lanes, hidden), kind)
    gates, news = np.empty_like(out), np.empty_like(out)
    for t in range(steps):
        np.multiply(h, on[t], out=was[t])
        gates[t], news[t], h = _step(p["u"], a[t], was[t])
        out[t] = h
    rows = np.flatnonzero(live.ravel())
    ys = word.ravel()[rows]
    order, parts = _by_class(ys, p)
    rows, ys = rows[order], ys[order]
    hs, scale, g = _with_ones(out.reshape(-1, hidden)[rows]), kind.type(1 / max(1, len(rows))), {}
    d, ll = _soft(hs @ p["c"], ys // size, scale)
    g["c"], dh = hs.T @ d, d @ p["c"][:-1].T
    g["w"] = np.empty((len(parts), hidden + 1, size), kind)
    within = ys % size
    for k, (c, i, j) in enumerate(parts):
        own = hs[i:j]
        d, more = _soft(own @ p["w"][c], within[i:j], scale)
        ll[i:j] += more
        np.matmul(own.T, d, out=g["w"][k])
        dh[i:j] += d @ p["w"][c, :-1].T
    all_dh = np.zeros((steps * lanes, hidden), kind)
    all_dh[rows] = dh
    all_dh = all_dh.reshape(steps, lanes, hidden)
    z = gates
    f = np.concatenate([(was - news) * (2 * z * (1 - z)), (1 - z) * (1 - news * news)], axis=2).reshape(steps, lanes, 2, hidden)
    keep = z * on
    dx = np.empty((steps, lanes, 2, hidden), kind)
    back, ut = np.zeros((lanes, hidden), kind), np.ascontiguousarray(p["u"].T)
    for t in range(steps - 1, -1, -1):
        back += all_dh[t]
        np.multiply(f[t], back[:, None], out=dx[t])
        back *= keep[t]
        more = dx[t].reshape(lanes, -1) @ ut
        more *= on[t]
        back += more
    flat = dx.reshape(-1, 2 * hidden)
    g["u"] = was.reshape(-1, hidden).T @ flat
    g["xb"] = flat.sum(axis=0)
    seen = before.ravel()
    by = np.argsort(seen, kind="stable")
    starts = np.concatenate([[0], np.flatnonzero(np.diff(seen[by])) + 1])
    g["x"] = np.add.reduceat(flat[by], starts, axis=0)
    return g, {"x": seen[by][starts], "w": np.array([c for c, _, _ in parts], np.int64)}, h, -float(ll.mean()) if len(ll) else 0.0


def train(p: Params, docs: list[np.ndarray], end: int, window: int = STEPS, rate: float = 0.05) -> Params:
    """One pass over the documents, a step for each window: gradients over the root of their running mean square; the rate falls to a tenth."""
    if not docs:
        return p
    p = {k: v.copy() for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    flat = np.concatenate(docs)
    long = -(-len(flat) // max(16, min(256, len(flat) // (window * WINDOWS))))
    count = -(-len(flat) // long)
    grid = lambda x: np.concatenate([x, np.full(count * long - len(flat), end, x.dtype)]).reshape(count, long).T
    word, before = grid(flat), grid(np.concatenate([np.array([end], flat.dtype), flat[:-1]]))
    counts = (np.arange(count * long) < len(flat)).reshape(count, long).T
    h, n = np.zeros((count, p["u"].shape[0]), np.float32), -(-long // window)
    for i in range(n):
        rows = slice(i * window, min((i + 1) * window, long))
        g, at, h, _ = gradients(p, before[rows], word[rows], counts[rows], h, end)
        own = np.float32(rate * (1 - 0.9 * i / n))
        for k, x in g.items():
            rows_of = at.get(k, slice(None))
            mean = s[k][rows_of] * np.float32(DECAY)
            mean += x * x * np.float32(1 - DECAY)
            s[k][rows_of] = mean
            if k not in at:
                mean = mean / np.float32(1 - DECAY ** (i + 1))
            root = np.sqrt(mean, out=mean)
            root += np.float32(1e-6)
            x *= own
            x /= root
            p[k][rows_of] -= x
    return p


def pack(p: Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def unpack(flat: np.ndarray, like: Params) -> Params:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out
