"""Batch kernels of the networks in :mod:`gradmill.plans.models`.

A kernel maps ``(params, x)`` to ``(y, back)``; ``back(dy)`` gives ``dx`` and
the gradients of its parameters, summed over the rows of the batch. They are
the body of the training and scoring tasks and know nothing of Spark.
"""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view


def linear(p, x):
    def back(dy):
        return dy @ p["weight"], {"weight": dy.T @ x, "bias": dy.sum(0)}

    return x @ p["weight"].T + p["bias"], back


def relu(p, x):
    return np.maximum(x, 0.0), lambda dy: (dy * (x > 0), {})


def tanh(p, x):
    y = np.tanh(x)
    return y, lambda dy: (dy * (1 - y * y), {})


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


def sigmoid(p, x):
    y = _sigmoid(x)
    return y, lambda dy: (dy * y * (1 - y), {})


def log_softmax(p, x):
    shifted = x - x.max(1, keepdims=True)
    y = shifted - np.log(np.exp(shifted).sum(1, keepdims=True))
    return y, lambda dy: (dy - np.exp(y) * dy.sum(1, keepdims=True), {})


def flat(p, x):
    return x.reshape(len(x), -1), lambda dy: (dy.reshape(x.shape), {})


def conv(p, x):
    w = p["weight"][0]
    k = w.shape[-1]
    windows = sliding_window_view(x, (k, k), (2, 3))
    y = np.tensordot(windows, w, ((1, 4, 5), (1, 2, 3))).transpose(0, 3, 1, 2)

    def back(dy):
        dw = np.tensordot(dy, windows, ((0, 2, 3), (0, 2, 3)))[None]
        padded = np.pad(dy, ((0, 0), (0, 0), (k - 1, k - 1), (k - 1, k - 1)))
        spread = sliding_window_view(padded, (k, k), (2, 3))
        dx = np.tensordot(spread, w[:, :, ::-1, ::-1], ((1, 4, 5), (0, 2, 3)))
        return dx.transpose(0, 3, 1, 2), {"weight": dw, "bias": dy.sum((0, 2, 3))}

    return y + p["bias"][:, None, None], back


def max_pool(p, x):
    """2 x 2 windows, stride 2; an odd last row or column is dropped; ties go to the first."""
    n, c, h, w = x.shape
    hh, ww = h // 2, w // 2
    cells = x[:, :, : 2 * hh, : 2 * ww].reshape(n, c, hh, 2, ww, 2)
    cells = cells.transpose(0, 1, 2, 4, 3, 5).reshape(n, c, hh, ww, 4)
    best = cells.argmax(-1)[..., None]

    def back(dy):
        d = np.zeros_like(cells)
        np.put_along_axis(d, best, dy[..., None], -1)
        dx = np.zeros_like(x)
        d = d.reshape(n, c, hh, ww, 2, 2).transpose(0, 1, 2, 4, 3, 5)
        dx[:, :, : 2 * hh, : 2 * ww] = d.reshape(n, c, 2 * hh, 2 * ww)
        return dx, {}

    return np.take_along_axis(cells, best, -1)[..., 0], back


def last_step(p, x):
    def back(dy):
        dx = np.zeros_like(x)
        dx[:, -1] = dy
        return dx, {}

    return x[:, -1], back


def rnn(p, x):
    """Elman cell: ``h = tanh(i2h x + h2h h + bias)``; all steps are returned."""
    wi, wh = p["i2h"], p["h2h"]
    hs = np.zeros((len(x), x.shape[1] + 1, len(wh)))
    for t in range(x.shape[1]):
        hs[:, t + 1] = np.tanh(x[:, t] @ wi.T + hs[:, t] @ wh.T + p["bias"])

    def back(dy):
        g = {name: np.zeros_like(value) for name, value in p.items()}
        dx, dh = np.zeros_like(x), 0.0
        for t in reversed(range(x.shape[1])):
            dz = (dy[:, t] + dh) * (1 - hs[:, t + 1] ** 2)
            g["i2h"] += dz.T @ x[:, t]
            g["h2h"] += dz.T @ hs[:, t]
            g["bias"] += dz.sum(0)
            dx[:, t], dh = dz @ wi, dz @ wh
        return dx, g

    return hs[:, 1:], back


def lstm(p, x):
    """Gates stacked as input, forget, cell, output; all steps are returned."""
    wi, wh = p["i2h"], p["h2h"]
    n, steps, size = len(x), x.shape[1], wh.shape[1]
    hs, cs = np.zeros((n, steps + 1, size)), np.zeros((n, steps + 1, size))
    gates = np.zeros((steps, 4, n, size))
    for t in range(steps):
        z = (x[:, t] @ wi.T + hs[:, t] @ wh.T + p["bias"]).reshape(n, 4, size)
        i, f, g, o = gates[t] = (
            _sigmoid(z[:, 0]), _sigmoid(z[:, 1]), np.tanh(z[:, 2]), _sigmoid(z[:, 3])
        )
        cs[:, t + 1] = f * cs[:, t] + i * g
        hs[:, t + 1] = o * np.tanh(cs[:, t + 1])

    def back(dy):
        grads = {name: np.zeros_like(value) for name, value in p.items()}
        dx, dh, dc = np.zeros_like(x), 0.0, 0.0
        for t in reversed(range(steps)):
            i, f, g, o = gates[t]
            squashed = np.tanh(cs[:, t + 1])
            dh = dy[:, t] + dh
            dc = dh * o * (1 - squashed**2) + dc
            dz = np.concatenate(
                [dc * g * i * (1 - i), dc * cs[:, t] * f * (1 - f),
                 dc * i * (1 - g * g), dh * squashed * o * (1 - o)], axis=1,
            )
            grads["i2h"] += dz.T @ x[:, t]
            grads["h2h"] += dz.T @ hs[:, t]
            grads["bias"] += dz.sum(0)
            dx[:, t], dh, dc = dz @ wi, dz @ wh, dc * f
        return dx, grads

    return hs[:, 1:], back


def bilstm(p, x):
    """Two LSTMs, the second over the reversed steps and flipped back; outputs joined."""
    sides = [{k[3:]: v for k, v in p.items() if k.startswith(s)} for s in ("fw_", "bw_")]
    forth, back_forth = lstm(sides[0], x)
    rev, back_rev = lstm(sides[1], x[:, ::-1])

    def back(dy):
        half = forth.shape[-1]
        dx1, g1 = back_forth(dy[..., :half])
        dx2, g2 = back_rev(dy[:, ::-1, half:])
        grads = {f"fw_{k}": v for k, v in g1.items()} | {f"bw_{k}": v for k, v in g2.items()}
        return dx1 + dx2[:, ::-1], grads

    return np.concatenate([forth, rev[:, ::-1]], axis=-1), back


KERNELS = {
    f.__name__: f
    for f in (linear, relu, tanh, sigmoid, log_softmax, flat, conv, max_pool, last_step,
              rnn, lstm, bilstm)
}


def nll(out, label1):
    rows, hit = np.arange(len(out)), label1.astype(int) - 1
    if len(hit) and not 0 <= hit.min() <= hit.max() < out.shape[1]:
        raise ValueError(f"labels must be from 1 to {out.shape[1]}")
    dout = np.zeros_like(out)
    dout[rows, hit] = -1.0
    return -out[rows, hit].sum(), dout


def cross_entropy(out, label1):
    log_probs, back = log_softmax({}, out)
    loss, d = nll(log_probs, label1)
    return loss, back(d)[0]


def mse(out, target):
    diff = out - target.reshape(out.shape)
    return (diff * diff).mean(1).sum(), 2 * diff / out.shape[1]


#: Criterion values and output gradients, summed (not averaged) over the batch.
CRITERIA = {"nll": nll, "cross_entropy": cross_entropy, "mse": mse}
