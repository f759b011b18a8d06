"""Update rules for a flat parameter vector."""

from __future__ import annotations

import numpy as np


class Optimizer:
    """Holds the step count and per-parameter state as one flat vector."""

    slots = 0

    def __init__(self):
        self.t = 0.0
        self.state = np.zeros(0)

    def start(self, size: int) -> None:
        if len(self.state) != self.slots * size:
            self.t, self.state = 0.0, np.zeros(self.slots * size)

    def step(self, vector: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def pack(self) -> np.ndarray:
        return np.concatenate([[self.t], self.state])

    def unpack(self, packed: np.ndarray) -> None:
        self.t, self.state = float(packed[0]), packed[1:].copy()


class SGD(Optimizer):
    """Step ``lr / (1 + t * decay)``, t counted from 0."""

    def __init__(self, lr: float = 1e-3, decay: float = 0.0):
        super().__init__()
        self.lr, self.decay = lr, decay

    def step(self, vector, gradient):
        rate = self.lr / (1.0 + self.t * self.decay)
        self.t += 1.0
        return vector - rate * gradient


class Adam(Optimizer):
    """Adam with bias correction (Kingma and Ba, 2015)."""

    slots = 2

    def __init__(self, lr: float = 1e-3, beta1: float = 0.9, beta2: float = 0.999, eps: float = 1e-8):
        super().__init__()
        self.lr, self.beta1, self.beta2, self.eps = lr, beta1, beta2, eps

    def step(self, vector, gradient):
        self.t += 1.0
        m, v = np.split(self.state, 2)
        m = self.beta1 * m + (1 - self.beta1) * gradient
        v = self.beta2 * v + (1 - self.beta2) * gradient**2
        self.state = np.concatenate([m, v])
        m_hat = m / (1 - self.beta1**self.t)
        v_hat = v / (1 - self.beta2**self.t)
        return vector - self.lr * m_hat / (np.sqrt(v_hat) + self.eps)
