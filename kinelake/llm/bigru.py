"""Bidirectional gated recurrent units in numpy: forward, backpropagation through time, Adam.

Inputs are gate pre-activations (steps, batch, 3 * hidden) for reset, update and candidate; whoever makes them (a row
of a table for each byte, a product for each word) gets their gradient back. Where `mask` is 0 a step leaves the state
as it is, in either direction.

Trained networks are rounded (`rounded`): weights of products to multiples of 2^-8 within 8, states to multiples of
2^-9. A sum of up to 16 such products is exact in float32, in any order, so that a state does not depend on what else is
in a batch, and equal texts score alike wherever they are read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In float32 by exp alone, which is the fast one; its overflow is the right limit."""
    with np.errstate(over="ignore"):
        out = np.exp(-x)
    out += 1
    return np.reciprocal(out, out=out)


def tanh(x: np.ndarray) -> np.ndarray:
    out = sigmoid(2 * x)
    out *= 2
    out -= 1
    return out


#: States are multiples of 1 / STATE, weights of products multiples of 1 / WEIGHT within +-LIMIT.
STATE, WEIGHT, LIMIT = np.float32(512), np.float32(256), np.float32(8)


def rounded(x: np.ndarray) -> np.ndarray:
    return (np.rint(np.clip(x, -LIMIT, LIMIT) * WEIGHT) / WEIGHT).astype(np.float32)


def on_grid(state: np.ndarray) -> np.ndarray:
    """Rounds states in place."""
    state *= STATE
    np.rint(state, out=state)
    state *= 1 / STATE
    return state


def steps(n: int, back: bool):
    return range(n - 1, -1, -1) if back else range(n)


def forward(gates: np.ndarray, u: np.ndarray, back: bool, mask: np.ndarray | None = None, tape: list | None = None, grid: bool = False) -> np.ndarray:
    """States after each step, rounded if `grid`. With a tape, what the way back needs is written there."""
    n, batch, h3 = gates.shape
    h = h3 // 3
    state = np.zeros((batch, h), np.float32)
    out = np.empty((n, batch, h), np.float32)
    for t in steps(n, back):
        x, own = gates[t], state @ u
        rz = sigmoid(x[:, : 2 * h] + own[:, : 2 * h])
        r, z = rz[:, :h], rz[:, h:]
        new = r * own[:, 2 * h :]
        new += x[:, 2 * h :]
        new = tanh(new)
        nxt = state - new
        nxt *= z
        nxt += new
        if grid:
            on_grid(nxt)
        if mask is not None:
            nxt = np.where(mask[t], nxt, state)
        if tape is not None:
            tape.append((state, r, z, new, own[:, 2 * h :]))
        out[t] = state = nxt
    return out


def backward(d_out: np.ndarray, u: np.ndarray, back: bool, tape: list, mask: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates and of u, from those of the states after each step."""
    n, batch, h = d_out.shape
    d_gates = np.zeros((n, batch, 3 * h), np.float32)
    d_u = np.zeros_like(u)
    d_state = np.zeros((batch, h), np.float32)
    for k, t in enumerate(reversed(list(steps(n, back)))):
        state, r, z, new, own = tape[n - 1 - k]
        d = d_out[t] + d_state
        live = np.ones((batch, 1), np.float32) if mask is None else mask[t].astype(np.float32)
        through, d = d * (1 - live), d * live
        d_new = d * (1 - z) * (1 - new * new)
        d_z = d * (state - new) * z * (1 - z)
        d_r = d_new * own * r * (1 - r)
        d_own = np.concatenate([d_r, d_z, d_new * r], axis=1)
        d_gates[t] = np.concatenate([d_r, d_z, d_new], axis=1)
        d_u += state.T @ d_own
        d_state = d * z + d_own @ u.T + through
    return d_gates, d_u


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        fix = np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= (self.rate * fix * self.m[k] / (np.sqrt(self.v[k]) + 1e-7)).astype(np.float32)


class ByteNet:
    """A bidirectional GRU over the bytes of words; each byte has a row of gates for either direction."""

    def __init__(self, hidden: int, outputs: int, rng: np.random.Generator):
        scale = 1 / np.sqrt(hidden)
        make = lambda *shape: rng.uniform(-scale, scale, shape).astype(np.float32)
        self.p = {"ef": make(256, 3 * hidden), "eb": make(256, 3 * hidden), "uf": make(hidden, 3 * hidden), "ub": make(hidden, 3 * hidden), "v": make(2 * hidden, outputs), "c": np.zeros(outputs, np.float32)}

    def states(self, bytes_: np.ndarray, tapes: tuple[list, list] | None = None, grid: bool = False) -> np.ndarray:
        """(steps, batch, 2 * hidden) for bytes (steps, batch)."""
        f, b = tapes or (None, None)
        return np.concatenate([forward(self.p["ef"][bytes_], self.p["uf"], False, tape=f, grid=grid), forward(self.p["eb"][bytes_], self.p["ub"], True, tape=b, grid=grid)], axis=2)

    def settle(self) -> None:
        """Rounds what is multiplied, after training."""
        for k in ("uf", "ub", "v"):
            self.p[k] = rounded(self.p[k])

    def ragged_states(self, bytes_: np.ndarray, length: np.ndarray, each: Callable[[int, int, bool, np.ndarray], None]) -> None:
        """Reads sequences (steps, batch) of these lengths, longest first, in both directions; `each` gets every step,
        how many sequences reach it, the direction, and their rounded states. No step is taken beyond a sequence."""
        h, batch = self.p["uf"].shape[0], len(length)
        live = np.searchsorted(-length, -np.arange(len(bytes_)), "left").tolist()  # sequences longer than the step
        # sigmoid(x) = 1 / (1 + exp(-x)) and tanh(x) = 2 sigmoid(2 x) - 1; the signs and twos are exact in the weights
        scale = np.repeat(np.float32([-1, -1, -2]), h)
        own, x = np.empty((batch, 3 * h), np.float32), np.empty((batch, 3 * h), np.float32)
        gate, new = np.empty((batch, 2 * h), np.float32), np.empty((batch, h), np.float32)
        with np.errstate(over="ignore"):
            for back, e, u in ((False, self.p["ef"] * scale, self.p["uf"] * scale), (True, self.p["eb"] * scale, self.p["ub"] * scale)):
                state = np.zeros((batch, h), np.float32)
                for t in steps(len(bytes_), back):
                    k = live[t]
                    old, o, i, g, n = state[:k], own[:k], x[:k], gate[:k], new[:k]
                    np.matmul(old, u, out=o)
                    np.take(e, bytes_[t, :k], axis=0, out=i, mode="clip")
                    np.add(i[:, : 2 * h], o[:, : 2 * h], out=g)
                    np.exp(g, out=g)
                    g += 1
                    np.reciprocal(g, out=g)
                    np.multiply(g[:, :h], o[:, 2 * h :], out=n)
                    n += i[:, 2 * h :]
                    np.exp(n, out=n)
                    n += 1
                    np.reciprocal(n, out=n)
                    n *= 2
                    n -= 1
                    old -= n
                    old *= g[:, h:]
                    old += n
                    on_grid(old)
                    each(t, k, back, old)

    def grads(self, bytes_: np.ndarray, states: np.ndarray, d_logits: np.ndarray, d_states: np.ndarray, tapes) -> dict[str, np.ndarray]:
        h = self.p["uf"].shape[0]
        out = {}
        for k, back, d, tape in (("f", False, d_states[:, :, :h], tapes[0]), ("b", True, d_states[:, :, h:], tapes[1])):
            gates, out["u" + k] = backward(d, self.p["u" + k], back, tape)
            out["e" + k] = np.stack([np.bincount(bytes_.ravel(), gates[:, :, j].ravel(), 256) for j in range(gates.shape[2])], axis=1).astype(np.float32)
        return out


def by_length(length: np.ndarray, batch: int, rng: np.random.Generator | None = None):
    """Groups of at most `batch` places of equal length; in random order if a generator is given."""
    order = np.argsort(length, kind="stable") if rng is None else np.lexsort((rng.random(len(length)), length))
    edge = np.flatnonzero(np.diff(length[order])) + 1
    groups = [part[i : i + batch] for part in np.split(order, edge) for i in range(0, len(part), batch)]
    if rng is not None:
        rng.shuffle(groups)
    return groups


def matrix(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Bytes of ranges of one length, (steps, batch)."""
    return data[starts[None, :] + np.arange(length)[:, None]]


class Cache:
    """Vectors of words by hash; a new word takes the place of the one in its slot."""

    def __init__(self, bits: int, width: int):
        self.shift = np.uint64(64 - bits)
        self.keys, self.rows = np.zeros(1 << bits, np.uint64), np.zeros((1 << bits, width), np.float32)

    def get(self, hashes: np.ndarray, make) -> np.ndarray:
        """Rows of distinct hashes; make(places) computes those that are not there."""
        slot = (hashes >> self.shift).astype(np.int64)
        out = self.rows[slot]
        missing = np.flatnonzero(self.keys[slot] != hashes)
        if len(missing):
            new = make(missing)
            out[missing] = new
            self.keys[slot[missing]] = hashes[missing]
            # of two words for one slot the last one counts for both tables
            self.rows[slot[missing]] = new
        return out
