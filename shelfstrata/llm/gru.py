"""A bidirectional gated recurrent layer with attention pooling, in numpy, with its gradients."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Params = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def layer(rng: np.random.Generator, inputs: int, hidden: int, name: str) -> Params:
    """Weights of a layer; `_f` reads from the left, `_b` from the right."""
    made: Params = {f"{name}v": np.zeros(2 * hidden, dtype=np.float32)}
    for way in "fb":
        made[f"{name}W_{way}"] = (rng.standard_normal((inputs, 3 * hidden)) / np.sqrt(inputs)).astype(np.float32)
        made[f"{name}U_{way}"] = (rng.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        made[f"{name}b_{way}"] = np.zeros(3 * hidden, dtype=np.float32)
    return made


def _run(a: np.ndarray, mask: np.ndarray, u: np.ndarray, steps: range, keep: list | None) -> np.ndarray:
    """States of one direction, for projected inputs `a` of shape (rows, steps, 3 hidden)."""
    hidden = u.shape[0]
    h = np.zeros((len(a), hidden), dtype=np.float32)
    out = np.empty((len(a), a.shape[1], hidden), dtype=np.float32)
    for t in steps:
        q = h @ u
        gates = _sigmoid(a[:, t, : 2 * hidden] + q[:, : 2 * hidden])
        z, r = gates[:, :hidden], gates[:, hidden:]
        n = np.tanh(a[:, t, 2 * hidden :] + r * q[:, 2 * hidden :])
        m = mask[:, t, None]
        if keep is not None:
            keep.append((t, h, z, r, n, q[:, 2 * hidden :]))
        h = h + m * ((1.0 - z) * (n - h))
        out[:, t] = h
    return out


def pooled(a_f: np.ndarray, a_b: np.ndarray, mask: np.ndarray, p: Params, name: str, keep: dict | None = None) -> np.ndarray:
    """Attention-pooled states of both directions, one row per sequence; zeros where all is masked."""
    steps = range(a_f.shape[1])
    kept_f, kept_b = ([], []) if keep is not None else (None, None)
    h_f = _run(a_f, mask, p[f"{name}U_f"], steps, kept_f)
    h_b = _run(a_b, mask, p[f"{name}U_b"], steps[::-1], kept_b)
    states = np.concatenate([h_f, h_b], axis=2)
    scores = np.where(mask > 0, states @ p[f"{name}v"], np.float32(-1e9))
    weights = np.exp(scores - scores.max(axis=1, keepdims=True)) * mask
    weights /= np.maximum(weights.sum(axis=1, keepdims=True), 1e-9)
    result = (weights[:, :, None] * states).sum(axis=1)
    if keep is not None:
        keep.update(f=kept_f, b=kept_b, states=states, weights=weights, result=result, mask=mask)
    return result


def read(inputs: Callable[[int, int], np.ndarray], mask: np.ndarray, p: Params, name: str) -> np.ndarray:
    """What `pooled` gives, without what gradients need; a column per sequence.

    `inputs(way, t)` are the projected inputs of a step, from the left (0) or the right (1), and `mask` has a row per step. Features come
    first, so that the sequences of a feature lie side by side and each operation runs over long contiguous rows.
    """
    steps, rows = mask.shape
    hidden, kind = len(p[f"{name}v"]) // 2, p[f"{name}v"].dtype
    states = np.empty((steps, 2 * hidden, rows), dtype=kind)
    for way, letter in enumerate("fb"):
        u = np.ascontiguousarray(p[f"{name}U_{letter}"].T)
        h = np.zeros((hidden, rows), dtype=kind)
        q = np.empty((3 * hidden, rows), dtype=kind)
        gates, n = q[: 2 * hidden], q[2 * hidden :]
        for t in range(steps)[:: 1 - 2 * way]:
            a = inputs(way, t)
            np.matmul(u, h, out=q)
            gates += a[: 2 * hidden]
            # sigmoid(x) = (1 + tanh(x / 2)) / 2
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates += 1.0
            gates *= 0.5
            n *= gates[hidden:]
            n += a[2 * hidden :]
            np.tanh(n, out=n)
            n -= h
            left = np.subtract(1.0, gates[:hidden], out=gates[:hidden])
            n *= left
            n *= mask[t]
            h = np.add(h, n, out=states[t, way * hidden : (way + 1) * hidden])
    scores = np.where(mask > 0, p[f"{name}v"] @ states, np.float32(-1e9))
    weights = np.exp(scores - scores.max(axis=0)) * mask
    weights /= np.maximum(weights.sum(axis=0), 1e-9)
    states *= weights[:, None]
    return states.sum(axis=0)


def _back(d_out: np.ndarray, kept: list, mask: np.ndarray, u: np.ndarray, d_u: np.ndarray) -> np.ndarray:
    hidden = u.shape[0]
    d_a = np.zeros((*d_out.shape[:2], 3 * hidden), dtype=np.float32)
    d_h = np.zeros_like(d_out[:, 0])
    for t, before, z, r, n, q in reversed(kept):
        d_h = d_h + d_out[:, t]
        m = mask[:, t, None]
        d = m * d_h
        d_n = d * (1.0 - z) * (1.0 - n * n)
        d_q = np.concatenate([d * (before - n) * z * (1.0 - z), d_n * q * r * (1.0 - r), d_n * r], axis=1)
        d_a[:, t] = np.concatenate([d_q[:, : 2 * hidden], d_n], axis=1)
        d_u += before.T @ d_q
        d_h = d * z + (1.0 - m) * d_h + d_q @ u.T
    return d_a


def pooled_back(d_result: np.ndarray, keep: dict, p: Params, name: str, grads: Params) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs; those of the layer's own weights are added to `grads`."""
    states, weights = keep["states"], keep["weights"]
    d_scores = weights * ((states - keep["result"][:, None]) * d_result[:, None]).sum(axis=2)
    grads[f"{name}v"] += np.einsum("bt,bth->h", d_scores, states)
    d_states = weights[:, :, None] * d_result[:, None] + d_scores[:, :, None] * p[f"{name}v"]
    hidden = states.shape[2] // 2
    d_f = _back(d_states[:, :, :hidden], keep["f"], keep["mask"], p[f"{name}U_f"], grads[f"{name}U_f"])
    d_b = _back(d_states[:, :, hidden:], keep["b"], keep["mask"], p[f"{name}U_b"], grads[f"{name}U_b"])
    return d_f, d_b


def projected(x: np.ndarray, p: Params, name: str) -> tuple[np.ndarray, np.ndarray]:
    return x @ p[f"{name}W_f"] + p[f"{name}b_f"], x @ p[f"{name}W_b"] + p[f"{name}b_b"]


def projected_back(x: np.ndarray, d_f: np.ndarray, d_b: np.ndarray, p: Params, name: str, grads: Params) -> np.ndarray:
    """The gradient of the inputs; those of the projection are added to `grads`."""
    flat = x.reshape(-1, x.shape[-1])
    for way, d in (("f", d_f), ("b", d_b)):
        d = d.reshape(len(flat), -1)
        grads[f"{name}W_{way}"] += flat.T @ d
        grads[f"{name}b_{way}"] += d.sum(axis=0)
    return d_f @ p[f"{name}W_f"].T + d_b @ p[f"{name}W_b"].T
