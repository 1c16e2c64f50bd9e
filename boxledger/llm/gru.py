"""A gated recurrent network over word classes, in numpy: batches of lanes, truncated backpropagation, factored softmax.

Words of a short list have an input vector each and an output class of ``per_class`` words; all other words share the
classes of their form.  The probability of a word is that of its class given the state, times that of the word in the
class: a softmax for the short list, corpus counts (applied by the caller) for the others.

Documents run one after another in lanes; the state is carried from window to window and set to zero where a document
starts, so a document's log-likelihood is complete however long it is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Gru:
    """``inputs``: gate inputs by input id; ``u``: recurrence; class and word outputs with their biases."""

    inputs: np.ndarray
    u: np.ndarray
    class_w: np.ndarray
    class_b: np.ndarray
    word_w: np.ndarray
    word_b: np.ndarray

    NAMES = ("inputs", "u", "class_w", "class_b", "word_w", "word_b")

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def filled(self, flat: np.ndarray) -> Gru:
        out, at = [], 0
        for n in self.NAMES:
            x = getattr(self, n)
            out.append(flat[at:at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return Gru(*out)


def start(word_counts: np.ndarray, other_counts: np.ndarray, *, per_class: int, hidden: int, seed: int = 3) -> Gru:
    """A network that predicts the class and word frequencies whatever the state; ``word_counts`` fill whole classes."""
    rng = np.random.default_rng(seed)
    n_words, n_other = len(word_counts), len(other_counts)
    by_class = word_counts.reshape(-1, per_class) + 0.5
    mass = np.concatenate((by_class.sum(1), other_counts + 0.5))
    n_inputs = n_words + n_other + 1
    return Gru(rng.normal(0, 0.3, (n_inputs, 3 * hidden)).astype(np.float32), rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32),
               np.zeros((hidden, len(mass)), np.float32), np.log(mass / mass.sum()).astype(np.float32),
               np.zeros((len(by_class), hidden, per_class), np.float32), np.log(by_class / by_class.sum(1, keepdims=True)).astype(np.float32))


@dataclass
class Lanes:
    """Token places by step and lane; lanes are in falling order of length, so the active ones come first."""

    place: np.ndarray
    first: np.ndarray
    active: np.ndarray


def lanes(lengths: np.ndarray, n_lanes: int) -> Lanes:
    """Whole documents (``lengths`` in tokens, one at least) dealt to lanes, the longest first, to the shortest lane."""
    import heapq

    n_lanes = max(1, min(n_lanes, len(lengths)))
    heap = [(0, k) for k in range(n_lanes)]
    chosen = np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    for d in order.tolist():
        total, k = heapq.heappop(heap)
        chosen[d] = k
        heapq.heappush(heap, (total + int(lengths[d]), k))
    totals = np.bincount(chosen, weights=lengths, minlength=n_lanes).astype(np.int64)
    rank = np.empty(n_lanes, np.int64)
    rank[np.argsort(-totals, kind="stable")] = np.arange(n_lanes)
    lane = rank[chosen]
    by = np.lexsort((order, lane))
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    size = lengths[by]
    ends = np.cumsum(size)
    lane_totals = np.sort(totals)[::-1]
    lane_first = np.concatenate(([0], np.cumsum(lane_totals)[:-1]))
    step0 = (ends - size) - lane_first[lane[by]]
    steps = int(lane_totals[0]) if len(lane_totals) else 0
    place = np.full((steps, n_lanes), -1, np.int64)
    first = np.zeros((steps, n_lanes), bool)
    inside = np.arange(size.sum()) - np.repeat(ends - size, size)
    place[np.repeat(step0, size) + inside, np.repeat(lane[by], size)] = np.repeat(starts[by], size) + inside
    first[step0, lane[by]] = True
    return Lanes(place, first, (place >= 0).sum(1))


#: Rows of one class that are multiplied at once, in windows of few and of many tokens.
CHUNKS = (16, 128)


@dataclass
class States:
    """What a window's steps leave behind for the way back; all arrays are steps by units by lanes."""

    before: np.ndarray
    gates: np.ndarray
    new: np.ndarray
    inner: np.ndarray


def _forward(net: Gru, x: np.ndarray, first: np.ndarray, state: np.ndarray, keep: bool) -> tuple[np.ndarray, States | None]:
    """States after each step of a window, steps by units by lanes; ``x`` and ``first`` are steps by lanes, all active.

    Units come before lanes, so each gate of a step is one piece of memory.
    """
    hidden = net.u.shape[0]
    steps, n_lanes = x.shape
    # A sigmoid is half a hyperbolic tangent of half its argument, plus a half: two of the three gates are halved beforehand.
    half = np.repeat(np.array([0.5, 0.5, 1], np.float32), hidden)
    fed = net.inputs[x]
    fed *= half
    gates, u = np.ascontiguousarray(fed.transpose(0, 2, 1)), np.ascontiguousarray((net.u * half).T)
    out = np.empty((steps, hidden, n_lanes), np.float32)
    kept = steps if keep else 1
    saved = States(np.empty((kept, hidden, n_lanes), np.float32), np.empty((kept, 2 * hidden, n_lanes), np.float32),
                   np.empty((kept, hidden, n_lanes), np.float32), np.empty((kept, hidden, n_lanes), np.float32))
    fresh = first.any(1).tolist()
    h = state
    for t in range(steps):
        if fresh[t]:
            h = np.where(first[t], np.float32(0), h)
        k = t if keep else 0
        a = u @ h
        zr, n = saved.gates[k], saved.new[k]
        np.add(gates[t, :2 * hidden], a[:2 * hidden], out=zr)
        np.tanh(zr, out=zr)
        zr *= np.float32(0.5)
        zr += np.float32(0.5)
        np.multiply(zr[hidden:], a[2 * hidden:], out=n)
        n += gates[t, 2 * hidden:]
        np.tanh(n, out=n)
        if keep:
            saved.before[t], saved.inner[t] = h, a[2 * hidden:]
        h = np.subtract(h, n, out=out[t])
        h *= zr[:hidden]
        h += n
    return out, saved if keep else None


def _rows(x: np.ndarray) -> np.ndarray:
    """Steps by units by lanes as one row of units for each step and lane."""
    return x.transpose(0, 2, 1).reshape(-1, x.shape[1])


#: Sums up to which no exponential overflows, so that the largest need not be taken off first.
SAFE = 60


def _safe(w: np.ndarray, b: np.ndarray) -> bool:
    """No sum of ``b`` and states (between -1 and 1) times ``w`` (units before outputs) is beyond ``SAFE``."""
    if max(w.max(), -w.min()) * w.shape[-2] + max(b.max(), -b.min()) <= SAFE:
        return True
    return (np.abs(w).sum(-2) + np.abs(b)).max() <= SAFE


def _firsts(x: np.ndarray) -> np.ndarray:
    """Places where a sorted array takes a new value."""
    return np.concatenate(([0], np.flatnonzero(x[1:] != x[:-1]) + 1))


@dataclass
class Listed:
    """Tokens of the short list, dealt to chunks of one class each: ``slot`` is the place of token ``by`` in the padded rows."""

    by: np.ndarray
    slot: np.ndarray
    classes: np.ndarray
    h: np.ndarray
    p: np.ndarray


def _outputs(net: Gru, h: np.ndarray, cls: np.ndarray, word: np.ndarray, keep: bool):
    """Log probability of each target's class and word (0 for words outside the short list), and the gradients' parts."""
    e = h @ net.class_w
    e += net.class_b
    if not _safe(net.class_w, net.class_b):
        e -= e.max(1, keepdims=True)
    rows = np.arange(len(h))
    log_p = e[rows, cls]
    np.exp(e, out=e)
    total = e @ np.ones(e.shape[1], np.float32)
    log_p -= np.log(total)
    n_classes, hidden, per_class = net.word_w.shape
    mine = np.flatnonzero(cls < n_classes)
    if not len(mine):
        return log_p, (e / total[:, None] if keep else None), None
    own = cls[mine].astype(np.min_scalar_type(n_classes))
    by = mine[np.argsort(own, kind="stable")]
    counts = np.bincount(own, minlength=n_classes)
    size = CHUNKS[len(mine) > 4096]
    chunks = -(-counts // size)
    slot = np.arange(len(by)) + np.repeat((np.cumsum(chunks) - chunks) * size - (np.cumsum(counts) - counts), counts)
    classes = np.repeat(np.arange(n_classes), chunks)
    padded = np.zeros((len(classes) * size, hidden), np.float32)
    padded[slot] = h[by]
    padded = padded.reshape(len(classes), size, hidden)
    inner = padded @ net.word_w[classes]
    inner += net.word_b[classes][:, None]
    if not _safe(net.word_w, net.word_b):
        inner -= inner.max(2, keepdims=True)
    flat = inner.reshape(-1, per_class)
    own_p = flat[slot, word[by]]
    np.exp(inner, out=inner)
    inner_total = flat @ np.ones(per_class, np.float32)
    log_p[by] += own_p - np.log(inner_total[slot])
    if not keep:
        return log_p, None, None
    flat /= inner_total[:, None]
    e /= total[:, None]
    return log_p, e, Listed(by, slot, classes, padded, inner)


def score(net: Gru, x: np.ndarray, cls: np.ndarray, word: np.ndarray, lengths: np.ndarray, *, n_lanes: int = 96, window: int = 32) -> np.ndarray:
    """Natural log probability of every token of whole documents, state carried across windows.

    Lanes and window bound what is held at once (it should fit a cache) and do not change the result.
    """
    out = np.zeros(len(x), np.float64)
    if not len(x):
        return out
    plan = lanes(lengths, n_lanes)
    state = np.zeros((net.u.shape[0], plan.place.shape[1]), np.float32)
    at = 0
    while at < len(plan.place):
        active = int(plan.active[at])
        end = min(at + window, at + int(np.searchsorted(-plan.active[at:], -active, "right")))
        place = plan.place[at:end, :active]
        h, _ = _forward(net, x[place], plan.first[at:end, :active], state[:, :active], False)
        state[:, :active] = h[-1]
        flat = place.ravel()
        out[flat] = _outputs(net, _rows(h), cls[flat], word[flat], False)[0]
        at = end
    return out


def train(net: Gru, x: np.ndarray, cls: np.ndarray, word: np.ndarray, lengths: np.ndarray, *, sums: np.ndarray | None = None, n_lanes: int = 48,
          window: int = 16, rate: float = 0.08) -> tuple[Gru, np.ndarray]:
    """One pass of truncated backpropagation (AdaGrad) over the documents; returns the network and the squared sums."""
    hidden = net.u.shape[0]
    net = net.filled(net.flat().copy())
    sums = np.full(net.flat().size, 1e-1, np.float32) if sums is None else sums.copy()
    acc = Gru(*[getattr(net.filled(sums), n) for n in Gru.NAMES])
    if not len(x):
        return net, sums
    plan = lanes(lengths, n_lanes)
    state = np.zeros((hidden, plan.place.shape[1]), np.float32)
    at = 0
    while at < len(plan.place):
        active = int(plan.active[at])
        end = min(at + window, at + int(np.searchsorted(-plan.active[at:], -active, "right")))
        place, first = plan.place[at:end, :active], plan.first[at:end, :active]
        h, saved = _forward(net, x[place], first, state[:, :active], True)
        state[:, :active] = h[-1]
        at = end
        flat = place.ravel()
        n = len(flat)
        hf = _rows(h)
        _, p, listed = _outputs(net, hf, cls[flat], word[flat], True)
        scale = np.float32(1 / max(active, 8))
        p[np.arange(n), cls[flat]] -= 1
        p *= scale
        grads = {"class_w": hf.T @ p, "class_b": np.ones(n, np.float32) @ p}
        dh_out = p @ net.class_w.T
        if listed is not None:
            q = listed.p.reshape(-1, listed.p.shape[2])
            q[listed.slot, word[flat[listed.by]]] -= 1
            q *= scale
            empty = np.ones(len(q), bool)
            empty[listed.slot] = False
            q[empty] = 0
            dh_out[listed.by] += (listed.p @ net.word_w[listed.classes].transpose(0, 2, 1)).reshape(-1, hidden)[listed.slot]
            some = listed.classes[_firsts(listed.classes)]
            chunks_of = (some[:, None] == listed.classes).astype(np.float32)
            for name, g in (("word_w", listed.h.transpose(0, 2, 1) @ listed.p), ("word_b", np.ones(listed.p.shape[1], np.float32) @ listed.p)):
                g, a, w = (chunks_of @ g.reshape(len(g), -1)).reshape(-1, *g.shape[1:]), getattr(acc, name), getattr(net, name)
                slope = g * g
                a[some] = slope = np.add(slope, a[some], out=slope)
                g *= np.float32(rate)
                g /= np.sqrt(slope, out=slope)
                w[some] -= g
        dh_out = np.ascontiguousarray(dh_out.reshape(len(place), active, hidden).transpose(0, 2, 1))
        z, r, new = saved.gates[:, :hidden], saved.gates[:, hidden:], saved.new
        # Slopes of the three gates' sums by the state after the step; the last one once as the input and once as the recurrence sees it.
        slope = np.empty((len(place), 3, hidden, active), np.float32)
        to_new = 1 - z
        np.multiply((saved.before - new) * z, to_new, out=slope[:, 0])
        to_new *= 1 - new * new
        np.multiply(to_new, r, out=slope[:, 2])
        np.multiply(slope[:, 2] * saved.inner, 1 - r, out=slope[:, 1])
        fresh = first.any(1).tolist()
        d_sums = np.empty(slope.shape, np.float32)
        d_states = np.empty(h.shape, np.float32)
        dh, back = np.zeros((hidden, active), np.float32), np.empty((hidden, active), np.float32)
        for t in range(len(place) - 1, -1, -1):
            dh = np.add(dh, dh_out[t], out=d_states[t])
            da = np.multiply(dh, slope[t], out=d_sums[t])
            dh = dh * z[t]
            dh += np.matmul(net.u, da.reshape(-1, active), out=back)
            if fresh[t]:
                dh[:, first[t]] = 0
        rows = _rows(d_sums.reshape(len(place), -1, active))
        grads["u"] = _rows(saved.before).T @ rows
        rows[:, 2 * hidden:] = _rows(d_states * to_new)
        fed = x[flat].astype(np.min_scalar_type(len(net.inputs)))
        order = np.argsort(fed, kind="stable")
        edges = _firsts(fed[order])
        used = fed[order[edges]]
        total = np.add.reduceat(rows[order], edges, axis=0)
        squares = total * total
        acc.inputs[used] = squares = np.add(squares, acc.inputs[used], out=squares)
        total *= np.float32(rate)
        total /= np.sqrt(squares, out=squares)
        net.inputs[used] -= total
        for name, g in grads.items():
            a = getattr(acc, name)
            a += g ** 2
            w = getattr(net, name)
            w -= rate * g / np.sqrt(a)
    return net, acc.flat()
