"""A bidirectional gated recurrent network in numpy: forward pass, backpropagation through time, Adam.

Arrays are time-major, (steps, sequences, units).  Inputs arrive as gate
pre-activations (reset, update, candidate), so a caller may look them up in a
table or multiply them out.  Within a step, arrays are unit-major: gates are
then whole rows, which numpy works on at a stretch.
"""

from __future__ import annotations

import numpy as np

_CHUNK = 1 << 14


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def init(rng: np.random.Generator, hidden: int) -> np.ndarray:
    """Recurrent weights (hidden, 3 * hidden)."""
    return (rng.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)


def forward(x: np.ndarray, u: np.ndarray, mask: np.ndarray | None, reverse: bool, keep: bool = False):
    """States of every step, (steps, sequences, hidden); where ``mask`` is 0 the state is zero.

    With ``keep``, also what :func:`backward` needs.
    """
    steps, n, width = x.shape
    h = width // 3
    states = np.empty((steps, n, h), np.float32)
    state = np.zeros((h, n), np.float32)
    kept = [None] * steps
    for t in (range(steps - 1, -1, -1) if reverse else range(steps)):
        g = u.T @ state
        own = x[t].T.copy()
        gates, candidate = own[:2 * h], own[2 * h:]
        gates += g[:2 * h]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        r, z = gates[:h], gates[h:]
        candidate += r * g[2 * h:]
        np.tanh(candidate, out=candidate)
        new = state - candidate
        new *= z
        new += candidate
        if mask is not None:
            new *= mask[t]
        if keep:
            kept[t] = (state, r, z, candidate, g[2 * h:])
        state = new
        states[t] = state.T
    return (states, kept) if keep else states


def backward(d_states: np.ndarray, kept, u: np.ndarray, mask: np.ndarray | None, reverse: bool):
    """Gradients of the gate pre-activations and of the recurrent weights."""
    steps, n, h = d_states.shape
    dx = np.empty((steps, n, 3 * h), np.float32)
    du = np.zeros_like(u)
    carry = np.zeros((h, n), np.float32)
    for t in (range(steps) if reverse else range(steps - 1, -1, -1)):
        state, r, z, candidate, gn = kept[t]
        d = d_states[t].T.copy()
        d += carry
        if mask is not None:
            d = d * mask[t]
        dn = d * (1 - z) * (1 - candidate * candidate)
        dr = dn * gn * r * (1 - r)
        dz = d * (state - candidate) * z * (1 - z)
        dx[t] = np.concatenate([dr, dz, dn]).T
        dg = np.concatenate([dr, dz, dn * r]).T.copy()
        du += state.T.copy().T @ dg  # row-major, so that sums are added as ever, whatever the number of sequences
        carry = d * z + (dg @ u.T).T
    return dx, du


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grads.items():
            rows = max(_CHUNK * len(g) // max(g.size, 1), 1)
            for i in range(0, len(g), rows):
                at = slice(i, i + rows)
                self._step(self.params[k][at], self.m[k][at], self.v[k][at], g[at], scale)

    @staticmethod
    def _step(p: np.ndarray, m: np.ndarray, v: np.ndarray, g: np.ndarray, scale: float) -> None:
        """One chunk, which stays in the cache."""
        change = g - m
        change *= 0.1
        m += change
        change = g * g
        change -= v
        change *= 0.001
        v += change
        root = np.sqrt(v)
        root += 1e-8
        move = scale * m
        move /= root
        p -= move.astype(np.float32)
