"""Gradients against finite differences, optimizers and initial values (no Spark)."""

import numpy as np
import pytest

from gradmill.plans import models
from gradmill.plans.optim import SGD, Adam

SMALL = [
    models.softmax(6, 4),
    models.mlp(6, (5, 7), 4),
    models.lenet(8, (3, 2), (2, 3), 5, 4),
    models.lenet(12, (5, 3), (2, 3), 5, 4),
    models.rnn(4, 3, 5, 4),
    models.lstm(4, 3, 5, 4),
    models.birnn(4, 3, 5, 4),
    models.autoencoder(6, 3),
    models.head(6, 4),
]


@pytest.mark.parametrize("model", SMALL, ids=lambda m: f"{m.name}{m.input_shape}")
def test_gradient_matches_finite_differences(model):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(5, int(np.prod(model.input_shape))))
    target = x if model.criterion == "mse" else rng.integers(1, 5, 5)
    vector = model.init(1) + rng.normal(scale=0.05, size=model.size)
    loss, gradient = model.loss_and_gradient(vector, x, target)
    eps = 1e-6
    for i in rng.permutation(model.size)[:60]:
        step = np.zeros(model.size)
        step[i] = eps
        up = model.loss_and_gradient(vector + step, x, target)[0]
        down = model.loss_and_gradient(vector - step, x, target)[0]
        assert gradient[i] == pytest.approx((up - down) / (2 * eps), abs=1e-5)
    assert loss > 0


def test_lenet_has_the_stated_parameters():
    shapes = models.lenet().shapes()
    assert shapes["conv1", "weight"] == (1, 6, 1, 5, 5)
    assert shapes["conv2", "weight"] == (1, 12, 6, 5, 5)
    assert shapes["fc1", "weight"] == (100, 192)
    assert models.lenet().size == 22278


def test_full_size_models_score():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2, 784))
    for model in (models.softmax(), models.mlp(), models.lenet(), models.rnn(), models.lstm(),
                  models.birnn()):
        assert model.forward(model.init(), x).shape == (2, 10)
    assert models.autoencoder().forward(models.autoencoder().init(), x).shape == (2, 784)


def test_split_and_join_are_inverse():
    model = models.birnn(4, 3, 5, 4)
    vector = np.arange(model.size, dtype=float)
    assert np.array_equal(model.join(model.split(vector)), vector)


def test_sgd_decay():
    optim = SGD(1.0, 0.5)
    v = np.zeros(1)
    for expected in (1.0, 1.0 + 1 / 1.5, 1.0 + 1 / 1.5 + 0.5):
        v = optim.step(v, np.array([-1.0]))
        assert v[0] == pytest.approx(expected)


def test_adam_first_step_is_the_rate_and_state_survives_packing():
    one, two = Adam(), Adam()
    one.start(2)
    two.start(2)
    v = one.step(np.zeros(2), np.array([3.0, -0.2]))
    assert v == pytest.approx([-1e-3, 1e-3], rel=1e-6)
    two.unpack(one.pack())
    g = np.array([0.5, 0.5])
    assert np.array_equal(one.step(v, g), two.step(v, g))
