"""Packed NumPy kernels: finite-difference gradient checks and hand-worked layers."""

import numpy as np
import pytest

from tessera.plans import kernels as K


def _loss(x, y, layers, params):
    p, _ = K.forward(x, layers, params)
    return float(K.ce_terms(p, y, "clip").sum())


def _num_grad(x, y, layers, params, eps=1e-6):
    flat = K.pack(params)
    g = np.zeros_like(flat)
    for i in range(flat.size):
        a, b = flat.copy(), flat.copy()
        a[i] += eps
        b[i] -= eps
        g[i] = (_loss(x, y, layers, K.unpack(a, params)) - _loss(x, y, layers, K.unpack(b, params))) / (2 * eps)
    return g


@pytest.mark.parametrize("pool_mode,act,stride,pad", [("avg", "relu", 1, 0), ("max", "tanh", 1, 1), ("avg", "tanh", 2, 1)])
def test_cnn_gradient_matches_finite_differences(pool_mode, act, stride, pad):
    rng = np.random.default_rng(0)
    layers = [K.conv(2, 2, 3, stride, pad), K.act(act), K.pool(2, 2, pool_mode), K.flatten()]
    shapes = K.output_shapes(layers, (7, 7, 2))
    layers.append(K.dense(shapes[-1][0], 3, "softmax"))
    params = K.init_params(layers, 1)
    x = rng.normal(size=(4, 7, 7, 2))
    y = np.array([0, 1, 2, 1])
    flat, _, _ = K.batch_gradients(x, y, layers, params, 3)
    assert np.allclose(flat, _num_grad(x, y, layers, params), atol=1e-5)


def test_mlp_gradient_matches_finite_differences():
    rng = np.random.default_rng(1)
    layers = [K.dense(5, 4, "relu"), K.dense(4, 4, "sigmoid"), K.dense(4, 3, "softmax")]
    params = K.init_params(layers, 3)
    x = rng.normal(size=(6, 5))
    y = rng.integers(0, 3, size=6)
    flat, _, _ = K.batch_gradients(x, y, layers, params, 3)
    assert np.allclose(flat, _num_grad(x, y, layers, params), atol=1e-5)


def test_conv_hand_worked():
    x = np.arange(16, dtype=float).reshape(1, 4, 4, 1)
    w = np.zeros((1, 1, 2, 2))
    w[0, 0] = [[1, 0], [0, -1]]
    out, _ = K.forward(x, [K.conv(1, 1, 2, stride=2)], [{"W": w, "b": np.array([0.5])}])
    # windows at (0,0),(0,2),(2,0),(2,2): x[y,x] - x[y+1,x+1] = -5 everywhere, + 0.5
    assert out.shape == (1, 2, 2, 1) and np.all(out == -4.5)


def test_max_pool_backward_ties_get_full_gradient():
    x = np.ones((1, 2, 2, 1))
    layers = [K.pool(2, 2, "max")]
    _, caches = K.forward(x, layers, [None])
    g = np.array([[[[3.0]]]])
    from tessera.plans.kernels import _scatter_windows, _windows  # noqa: F401

    a_in, out = caches[0]
    win = K._windows(a_in, 2, 2)
    mask = win == out[:, :, :, :, None, None]
    full = K._scatter_windows(a_in.shape, mask * g[:, :, :, :, None, None], 2, 2)
    assert np.all(full == 3.0)


def test_shapes_checked():
    with pytest.raises(ValueError):
        K.output_shapes([K.conv(2, 3, 3)], (8, 8, 1))
    with pytest.raises(ValueError):
        K.output_shapes([K.flatten(), K.dense(10, 2)], (8, 8, 1))


def test_lenet5_parameter_count():
    from tessera.plans.networks import lenet5, mlp

    layers = lenet5(33)
    assert K.n_params(K.init_params(layers)) == 156 + 2416 + 48120 + 10164 + 2805
    with pytest.raises(ValueError):
        mlp([8, 1])
    assert [ly["act"] for ly in mlp([8, 16, 8, 3])] == ["relu", "relu", "softmax"]


def test_init_scales():
    layers = [K.conv(8, 3, 5), K.flatten(), K.dense(8 * 4 * 4 * 0 + 128, 64)]
    p = K.init_params([layers[0]], 42)[0]
    assert abs(p["W"].std() - np.sqrt(2 / (3 * 25))) < 0.02 and np.all(p["b"] == 0)
    small = K.init_params([K.dense(200, 100)], 42, scheme="small")[0]
    assert abs(small["W"].std() - 0.01) < 0.001


def test_mlp_sequential_init_is_one_seeded_stream():
    layers = [K.dense(8, 16), K.dense(16, 3, "softmax")]
    p = K.init_params(layers, 42, scheme="mlp_sequential")
    np.random.seed(42)
    w1 = np.random.randn(8, 16) * 0.01
    w2 = np.random.randn(16, 3) * 0.01
    assert np.array_equal(p[0]["W"], w1) and np.array_equal(p[1]["W"], w2)
    assert p[1]["b"].shape == (3,) and not p[1]["b"].any()


@pytest.mark.parametrize("shape,k,stride", [((3, 8, 8, 6), 2, 2), ((2, 9, 7, 3), 3, 2), ((2, 5, 6, 1), 2, 1)])
def test_mean_windows(shape, k, stride):
    x = np.random.default_rng(2).random(shape)
    assert np.allclose(K._mean_windows(x, k, stride), K._windows(x, k, stride).mean(axis=(4, 5)), rtol=0, atol=1e-15)


def test_no_gradient_is_carried_to_the_input(monkeypatch):
    layers = [K.conv(2, 1, 3), K.act("relu"), K.pool(2, 2, "avg"), K.flatten(), K.dense(18, 3, "softmax")]
    params = K.init_params(layers, 1)
    spread = []
    real = K._scatter_windows
    monkeypatch.setattr(K, "_scatter_windows", lambda shape, *a: spread.append(shape) or real(shape, *a))
    K.batch_gradients(np.random.default_rng(3).random((4, 8, 8, 1)), np.array([0, 1, 2, 0]), layers, params, 3)
    assert spread == [(4, 6, 6, 2)]  # the pooling alone


def test_a_pass_is_bounded_by_the_widest_layer(monkeypatch):
    from tessera.plans.networks import lenet5, mlp

    layers = lenet5(10)
    assert K.pass_rows(layers, (32, 32, 1)) == K.PASS_VALUES // (28 * 28 * 25) < 64
    assert K.pass_rows(mlp([64, 32, 10]), (64,)) == K.PASS_VALUES // 32
    x, y, params = np.random.default_rng(4).random((7, 32, 32, 1)), np.arange(7), K.init_params(layers, 3)
    whole, probs = K.batch_gradients(x, y, layers, params, 10), K.predict_proba(x, layers, params)
    seen, real = [], K.forward
    monkeypatch.setattr(K, "PASS_VALUES", 3 * 28 * 28 * 25)
    monkeypatch.setattr(K, "forward", lambda x, *a: seen.append(len(x)) or real(x, *a))
    cut = K.batch_gradients(x, y, layers, params, 10)
    assert seen == [3, 3, 1] and cut[2] == whole[2] and np.isclose(cut[1], whole[1], rtol=1e-13)
    assert np.allclose(cut[0], whole[0], rtol=0, atol=1e-11) and np.allclose(K.predict_proba(x, layers, params), probs, rtol=0, atol=1e-14)
