"""Model descriptions: layer lists, parameter shapes and training settings."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from gradmill.plans import kernels
from gradmill.plans.optim import SGD, Adam, Optimizer


def _shapes(kind: str, sizes: tuple) -> dict[str, tuple[int, ...]]:
    if kind == "linear":
        n_in, n_out = sizes
        return {"weight": (n_out, n_in), "bias": (n_out,)}
    if kind == "conv":
        c_in, c_out, k = sizes
        return {"weight": (1, c_out, c_in, k, k), "bias": (c_out,)}
    if kind in ("rnn", "lstm"):
        n_in, n = sizes
        rows = n if kind == "rnn" else 4 * n
        return {"i2h": (rows, n_in), "h2h": (rows, n), "bias": (rows,)}
    if kind == "bilstm":
        one = _shapes("lstm", sizes)
        return {f"{side}_{k}": v for side in ("fw", "bw") for k, v in one.items()}
    return {}


#: Rows a kernel takes at once: its intermediate arrays are many times its input.
SLICE_ROWS = 512


def _slices(x: np.ndarray) -> list[slice]:
    return [slice(at, at + SLICE_ROWS) for at in range(0, len(x), SLICE_ROWS)]


@dataclass(frozen=True)
class Model:
    """A chain of ``(kind, name, *sizes)`` layers over rows of ``input_shape``.

    All parameters together are one flat float64 vector, in layer order.
    """

    name: str
    input_shape: tuple[int, ...]
    layers: tuple[tuple, ...]
    criterion: str

    def shapes(self) -> dict[tuple[str, str], tuple[int, ...]]:
        return {
            (name, param): shape
            for kind, name, *sizes in self.layers
            for param, shape in _shapes(kind, tuple(sizes)).items()
        }

    @property
    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.shapes().values())

    @property
    def inputs(self) -> int:
        return int(np.prod(self.input_shape))

    @property
    def outputs(self) -> int:
        """Length of an output row: what the last linear layer gives."""
        return next(sizes[1] for kind, _, *sizes in reversed(self.layers) if kind == "linear")

    def split(self, vector: np.ndarray) -> dict[tuple[str, str], np.ndarray]:
        out, at = {}, 0
        for key, shape in self.shapes().items():
            n = int(np.prod(shape))
            out[key] = vector[at : at + n].reshape(shape)
            at += n
        return out

    def join(self, params: dict[tuple[str, str], np.ndarray]) -> np.ndarray:
        parts = [np.asarray(params[key], float).reshape(-1) for key in self.shapes()]
        return np.concatenate(parts) if parts else np.zeros(0)

    def init(self, seed: int = 0) -> np.ndarray:
        """Uniform in ±1/sqrt(fan-in) for every layer."""
        rng = np.random.default_rng(seed)
        fan_in: dict[str, float] = {}
        out = {}
        for (layer, param), shape in self.shapes().items():
            if len(shape) > 1 and layer not in fan_in:
                fan_in[layer] = float(np.prod(shape[-3:] if len(shape) == 5 else shape[1:]))
            bound = 1.0 / np.sqrt(fan_in[layer])
            out[layer, param] = rng.uniform(-bound, bound, shape)
        return self.join(out)

    def formula(self) -> np.ndarray:
        """Reproducible weights that any engine can state: by row, column and ordinal."""
        out = {}
        for t, (key, shape) in enumerate(self.shapes().items()):
            i = np.arange(int(np.prod(shape)))
            row, col = i // shape[-1], i % shape[-1]
            out[key] = ((row * 31 + col * 17 + t * 13) % 11 - 5) / 10.0
        return self.join(out)

    def _run(self, vector: np.ndarray, x: np.ndarray):
        params = self.split(vector)
        x = np.asarray(x, float).reshape((len(x), *self.input_shape))
        tape = []
        for kind, name, *_ in self.layers:
            mine = {p: v for (layer, p), v in params.items() if layer == name}
            x, back = kernels.KERNELS[kind](mine, x)
            tape.append((name, back))
        return x, tape

    def forward(self, vector: np.ndarray, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._run(vector, x[at])[0] for at in _slices(x)])

    def loss_and_gradient(self, vector, x, target) -> tuple[float, np.ndarray]:
        """Criterion and gradient summed over the rows of the batch."""
        parts = [self._slice_gradient(vector, x[at], target[at]) for at in _slices(x)]
        return sum(loss for loss, _ in parts), sum(gradient for _, gradient in parts)

    def _slice_gradient(self, vector, x, target) -> tuple[float, np.ndarray]:
        out, tape = self._run(vector, x)
        loss, d = kernels.CRITERIA[self.criterion](out, target)
        grads = {}
        for name, back in reversed(tape):
            d, mine = back(d)
            grads.update({(name, param): g for param, g in mine.items()})
        return float(loss), self.join(grads)


def softmax(n_input: int = 784, n_classes: int = 10) -> Model:
    """Logistic regression."""
    layers = (("linear", "score", n_input, n_classes), ("log_softmax", "out"))
    return Model("softmax", (n_input,), layers, "nll")


def mlp(n_input: int = 784, hidden: tuple[int, int] = (256, 256), n_classes: int = 10) -> Model:
    layers = (
        ("linear", "fc1", n_input, hidden[0]), ("relu", "relu1"),
        ("linear", "fc2", hidden[0], hidden[1]), ("relu", "relu2"),
        ("linear", "fc3", hidden[1], n_classes), ("log_softmax", "out"),
    )
    return Model("mlp", (n_input,), layers, "nll")


def lenet(
    side: int = 28, kernel: tuple[int, int] = (5, 5), channels: tuple[int, int] = (6, 12),
    n_fc: int = 100, n_classes: int = 10,
) -> Model:
    """The names of the layers and the default sizes."""
    end = ((side - kernel[0] + 1) // 2 - kernel[1] + 1) // 2
    layers = (
        ("conv", "conv1", 1, channels[0], kernel[0]), ("tanh", "tanh1"), ("max_pool", "pool1"),
        ("tanh", "tanh2"), ("conv", "conv2", channels[0], channels[1], kernel[1]),
        ("max_pool", "pool2"), ("flat", "reshape"),
        ("linear", "fc1", channels[1] * end * end, n_fc), ("tanh", "tanh3"),
        ("linear", "score", n_fc, n_classes), ("log_softmax", "classifier"),
    )
    return Model("lenet", (1, side, side), layers, "nll")


def _recurrent(kind: str, steps: int, n_input: int, n_hidden: int, n_classes: int) -> Model:
    wide = 2 * n_hidden if kind == "bilstm" else n_hidden
    layers = (
        (kind, "recurrent", n_input, n_hidden), ("last_step", "select"),
        ("linear", "score", wide, n_classes),
    )
    return Model(kind, (steps, n_input), layers, "cross_entropy")


def rnn(steps: int = 28, n_input: int = 28, n_hidden: int = 128, n_classes: int = 10) -> Model:
    return _recurrent("rnn", steps, n_input, n_hidden, n_classes)


def lstm(steps: int = 28, n_input: int = 28, n_hidden: int = 128, n_classes: int = 10) -> Model:
    return _recurrent("lstm", steps, n_input, n_hidden, n_classes)


def birnn(steps: int = 28, n_input: int = 28, n_hidden: int = 128, n_classes: int = 10) -> Model:
    return _recurrent("bilstm", steps, n_input, n_hidden, n_classes)


def autoencoder(n_input: int = 784, n_hidden: int = 32) -> Model:
    layers = (
        ("linear", "encoder", n_input, n_hidden), ("relu", "relu"),
        ("linear", "decoder", n_hidden, n_input), ("sigmoid", "out"),
    )
    return Model("autoencoder", (n_input,), layers, "mse")


def head(n_features: int, n_classes: int = 5) -> Model:
    """The new classification layer of a transfer-learned model."""
    layers = (("linear", "classifier", n_features, n_classes), ("log_softmax", "out"))
    return Model("head", (n_features,), layers, "nll")


@dataclass(frozen=True)
class Settings:
    """How a named model is trained."""

    optim: Optimizer
    epochs: int
    batch_size: int
    mode: str
    validation: tuple[str, ...] = field(default=("Top1Accuracy",))


#: Optimizer, epochs and batch size per model. Small batches run
#: as ``local_sgd``; ``sync`` is open to every model.
SETTINGS = {
    "softmax": Settings(SGD(0.2), 20, 2048, "sync"),
    "mlp": Settings(SGD(0.2), 15, 2048, "sync"),
    "lenet": Settings(SGD(0.4, 2e-4), 5, 2048, "sync"),
    "lenet_graph": Settings(SGD(0.4, 2e-4), 5, 256, "sync", ("Top1Accuracy", "Loss")),
    "rnn": Settings(Adam(), 5, 64, "local_sgd"),
    "lstm": Settings(Adam(), 5, 64, "local_sgd"),
    "bilstm": Settings(Adam(), 5, 64, "local_sgd"),
    "autoencoder": Settings(Adam(), 2, 128, "local_sgd", ()),
    "head": Settings(SGD(0.01, 2e-4), 2, 16, "local_sgd"),
}
