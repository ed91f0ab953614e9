"""NumPy batch kernels run inside Arrow-batched tasks (packed tensor form).

A network is a list of layer specs (plain dicts) plus a parallel list of parameters
(``{"W": ndarray, "b": ndarray}`` or ``None``). ``forward`` keeps each layer's cache,
``backward`` returns per-layer gradient sums over the batch. These run per Arrow batch on
executors; Spark partitions the rows and combines the per-partition sums.

Layouts: images are (N, H, W, C) row-major; conv filters (F, C, KH, KW); dense (in, out).
Window matrices are ordered (C, KH, KW), matching the filter reshape.
"""

from __future__ import annotations

import numpy as np

CLIP_EPS = 1e-15


# ----------------------------------------------------------------------------- layer specs
def conv(filters: int, channels: int, size: int, stride: int = 1, padding: int = 0) -> dict:
    return {"type": "conv", "filters": filters, "channels": channels, "size": size, "stride": stride, "padding": padding}


def act(fn: str = "relu") -> dict:
    if fn not in ("relu", "tanh"):
        raise ValueError("activation layer supports 'relu' or 'tanh'")
    return {"type": "act", "fn": fn}


def pool(size: int = 2, stride: int | None = None, mode: str = "avg") -> dict:
    if mode not in ("avg", "max"):
        raise ValueError("mode must be 'avg' or 'max'")
    return {"type": "pool", "size": size, "stride": stride or size, "mode": mode}


def flatten() -> dict:
    return {"type": "flatten"}


def dense(n_in: int, n_out: int, activation: str = "relu") -> dict:
    if activation not in ("relu", "sigmoid", "softmax", "tanh"):
        raise ValueError("dense activation must be relu, sigmoid, softmax or tanh")
    return {"type": "dense", "in": n_in, "out": n_out, "act": activation}


def trainable(layer: dict) -> bool:
    return layer["type"] in ("conv", "dense")


def output_shapes(layers: list[dict], in_shape: tuple[int, int, int]) -> list[tuple]:
    """Shape after each layer, checking that consecutive layers fit together."""
    shapes = []
    s = tuple(in_shape)
    for ly in layers:
        t = ly["type"]
        if t == "conv":
            h, w, c = s
            if c != ly["channels"]:
                raise ValueError(f"conv expects {ly['channels']} channels, got {c}")
            hp, wp = h + 2 * ly["padding"], w + 2 * ly["padding"]
            s = ((hp - ly["size"]) // ly["stride"] + 1, (wp - ly["size"]) // ly["stride"] + 1, ly["filters"])
            if s[0] <= 0 or s[1] <= 0:
                raise ValueError("conv output would be empty")
        elif t == "pool":
            h, w, c = s
            s = ((h - ly["size"]) // ly["stride"] + 1, (w - ly["size"]) // ly["stride"] + 1, c)
        elif t == "flatten":
            s = (int(np.prod(s)),)
        elif t == "dense":
            if len(s) != 1 or s[0] != ly["in"]:
                raise ValueError(f"dense expects input width {ly['in']}, got {s}")
            s = (ly["out"],)
        shapes.append(s)
    return shapes


def init_params(layers: list[dict], seed: int = 42, scheme: str = "he") -> list[dict | None]:
    """Initial parameters with zero biases.

    'he': conv/dense weights ~ N(0, 2/fan_in), each trainable layer from its own generator
    (seed + layer index). 'small': 0.01·N(0, 1), same generators. 'mlp_sequential': the MLP
    rule of the reference — one legacy Mersenne-Twister stream seeded once, 0.01·randn drawn
    layer after layer — so a dense-only network starts from identical weights.
    """
    if scheme == "mlp_sequential":
        rs = np.random.RandomState(seed)
        out = []
        for ly in layers:
            if ly["type"] != "dense":
                raise ValueError("'mlp_sequential' initialises dense-only networks")
            out.append({"W": rs.randn(ly["in"], ly["out"]) * 0.01, "b": np.zeros(ly["out"])})
        return out
    if scheme not in ("he", "small"):
        raise ValueError("scheme must be 'he', 'small' or 'mlp_sequential'")
    out = []
    for i, ly in enumerate(layers):
        rng = np.random.default_rng(seed + i)
        if ly["type"] == "conv":
            fan_in = ly["channels"] * ly["size"] ** 2
            shape = (ly["filters"], ly["channels"], ly["size"], ly["size"])
            std = np.sqrt(2.0 / fan_in) if scheme == "he" else 0.01
            out.append({"W": rng.standard_normal(shape) * std, "b": np.zeros(ly["filters"])})
        elif ly["type"] == "dense":
            std = np.sqrt(2.0 / ly["in"]) if scheme == "he" else 0.01
            out.append({"W": rng.standard_normal((ly["in"], ly["out"])) * std, "b": np.zeros(ly["out"])})
        else:
            out.append(None)
    return out


def n_params(params: list[dict | None]) -> int:
    return int(sum(p["W"].size + p["b"].size for p in params if p is not None))


def pack(params: list[dict | None]) -> np.ndarray:
    parts = [np.concatenate([p["W"].ravel(), p["b"].ravel()]) for p in params if p is not None]
    return np.concatenate(parts) if parts else np.zeros(0)


def unpack(flat: np.ndarray, like: list[dict | None]) -> list[dict | None]:
    out, k = [], 0
    for p in like:
        if p is None:
            out.append(None)
            continue
        nw, nb = p["W"].size, p["b"].size
        out.append({"W": flat[k:k + nw].reshape(p["W"].shape), "b": flat[k + nw:k + nw + nb].reshape(p["b"].shape)})
        k += nw + nb
    return out


# ----------------------------------------------------------------------------- elementwise
def _act(fn: str, z: np.ndarray) -> np.ndarray:
    if fn == "relu":
        return np.maximum(0.0, z)
    if fn == "tanh":
        return np.tanh(z)
    if fn == "sigmoid":
        return 1.0 / (1.0 + np.exp(-z))
    if fn == "softmax":
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    raise ValueError(fn)


def _act_grad(fn: str, z: np.ndarray, a: np.ndarray) -> np.ndarray:
    if fn == "relu":
        return (z > 0).astype(float)
    if fn == "tanh":
        return 1.0 - np.tanh(z) ** 2
    if fn == "sigmoid":
        return a * (1.0 - a)
    raise ValueError(fn)


# ----------------------------------------------------------------------------- windows
def _windows(x: np.ndarray, k: int, stride: int) -> np.ndarray:
    """(N, H, W, C) → (N, OH, OW, C, K, K), NumPy's strided view of all windows (no copy)."""
    return np.lib.stride_tricks.sliding_window_view(x, (k, k), axis=(1, 2))[:, ::stride, ::stride]


def _mean_windows(x: np.ndarray, k: int, stride: int) -> np.ndarray:
    """Mean of each window, (N, H, W, C) → (N, OH, OW, C), added place by place over whole grids."""
    oh, ow = (x.shape[1] - k) // stride + 1, (x.shape[2] - k) // stride + 1
    out = np.zeros((x.shape[0], oh, ow, x.shape[3]))
    for dy in range(k):
        for dx in range(k):
            out += x[:, dy:dy + stride * oh:stride, dx:dx + stride * ow:stride, :]
    return out / (k * k)


def _scatter_windows(shape, dwin: np.ndarray, k: int, stride: int) -> np.ndarray:
    """Add window gradients (N, OH, OW, C, K, K) back onto an (N, H, W, C) grid (overlaps add)."""
    out = np.zeros(shape)
    _, oh, ow = dwin.shape[:3]
    for dy in range(k):
        for dx in range(k):
            out[:, dy:dy + stride * oh:stride, dx:dx + stride * ow:stride, :] += dwin[:, :, :, :, dy, dx]
    return out


# ----------------------------------------------------------------------------- forward
def forward(x: np.ndarray, layers: list[dict], params: list[dict | None]):
    """Run the chain; returns (output, caches). ``x`` is (N, H, W, C) or (N, D) for dense-only nets."""
    caches = []
    a = x
    for ly, p in zip(layers, params):
        t = ly["type"]
        if t == "conv":
            pd_ = ly["padding"]
            xp = np.pad(a, ((0, 0), (pd_, pd_), (pd_, pd_), (0, 0))) if pd_ else a
            win = _windows(xp, ly["size"], ly["stride"])
            n, oh, ow = win.shape[:3]
            cols = win.reshape(n * oh * ow, -1)
            wf = p["W"].reshape(p["W"].shape[0], -1)
            out = (cols @ wf.T + p["b"]).reshape(n, oh, ow, -1)
            caches.append((xp.shape, cols, a.shape))
            a = out
        elif t == "act":
            caches.append(a)
            a = _act(ly["fn"], a)
        elif t == "pool":
            out = _mean_windows(a, ly["size"], ly["stride"]) if ly["mode"] == "avg" else _windows(a, ly["size"], ly["stride"]).max(axis=(4, 5))
            caches.append((a, out))
            a = out
        elif t == "flatten":
            caches.append(a.shape)
            a = a.reshape(a.shape[0], -1)
        elif t == "dense":
            z = a @ p["W"] + p["b"]
            out = _act(ly["act"], z)
            caches.append((a, z, out))
            a = out
        else:
            raise ValueError(t)
    return a, caches


SCORE_ROWS = 128  # rows scored at a time, whatever the Arrow batch holds
PASS_VALUES = 5 << 16  # values of the widest layer's windows in one pass (2.5 MB): they stay in the processor's cache


def pass_rows(layers: list[dict], in_shape: tuple) -> int:
    """Rows of one forward (and backward) pass: as many as keep every layer within ``PASS_VALUES``."""
    widest, s = 1, tuple(in_shape)
    for ly, out in zip(layers, output_shapes(layers, s)):
        windows = s[-1] * ly["size"] ** 2 * out[0] * out[1] if ly["type"] == "conv" else 0
        widest, s = max(widest, windows, int(np.prod(out))), out
    return max(1, PASS_VALUES // widest)


def predict_proba(x: np.ndarray, layers: list[dict], params: list[dict | None]) -> np.ndarray:
    """Forward pass in slices of at most ``SCORE_ROWS`` rows; caches live for one slice only."""
    rows = min(SCORE_ROWS, pass_rows(layers, x.shape[1:]))
    if len(x) <= rows:
        return forward(x, layers, params)[0]
    return np.concatenate([forward(x[i : i + rows], layers, params)[0] for i in range(0, len(x), rows)])


# ----------------------------------------------------------------------------- backward
def backward(dout: np.ndarray, layers: list[dict], params: list[dict | None], caches) -> list[dict | None]:
    """Gradient sums over the batch for each layer. ``dout`` is dLoss/d(output); for a softmax
    output trained with cross-entropy pass ``p − y`` (it goes straight to the logits)."""
    grads: list[dict | None] = [None] * len(layers)
    g = dout
    first = next((i for i, ly in enumerate(layers) if trainable(ly)), len(layers))
    for i in range(len(layers) - 1, first - 1, -1):  # nothing before the first parameters needs a gradient
        ly, p, cache = layers[i], params[i], caches[i]
        t = ly["type"]
        if t == "dense":
            a_in, z, a_out = cache
            dz = g if ly["act"] == "softmax" else g * _act_grad(ly["act"], z, a_out)
            grads[i] = {"W": a_in.T @ dz, "b": dz.sum(axis=0)}
            if i > first:
                g = dz @ p["W"].T
        elif t == "flatten":
            g = g.reshape(cache)
        elif t == "pool":
            a_in, out = cache
            k, s = ly["size"], ly["stride"]
            if ly["mode"] == "avg":
                dwin = np.broadcast_to(g[:, :, :, :, None, None] / (k * k), g.shape + (k, k))
            else:
                win = _windows(a_in, k, s)
                mask = win == out[:, :, :, :, None, None]
                dwin = mask * g[:, :, :, :, None, None]
            full = _scatter_windows(a_in.shape, dwin, k, s)
            g = full
        elif t == "act":
            z = cache
            g = g * _act_grad(ly["fn"], z, None)
        elif t == "conv":
            xp_shape, cols, in_shape = cache
            f = p["W"].shape[0]
            gf = g.reshape(-1, f)
            grads[i] = {"W": (gf.T @ cols).reshape(p["W"].shape), "b": gf.sum(axis=0)}
            if i == first:
                break
            dcols = (gf @ p["W"].reshape(f, -1)).reshape(g.shape[:3] + p["W"].shape[1:])
            dxp = _scatter_windows(xp_shape, dcols, ly["size"], ly["stride"])
            pd_ = ly["padding"]
            g = dxp[:, pd_:-pd_, pd_:-pd_, :] if pd_ else dxp
        else:
            raise ValueError(t)
    return grads


# ----------------------------------------------------------------------------- losses
def onehot(labels: np.ndarray, k: int) -> np.ndarray:
    y = np.zeros((labels.shape[0], k))
    y[np.arange(labels.shape[0]), labels.astype(int)] = 1.0
    return y


def ce_terms(p: np.ndarray, labels: np.ndarray, eps_mode: str = "clip") -> np.ndarray:
    pt = p[np.arange(p.shape[0]), labels.astype(int)]
    if eps_mode == "clip":
        return -np.log(np.clip(pt, CLIP_EPS, 1.0 - CLIP_EPS))
    return -np.log(pt + CLIP_EPS)


def batch_gradients(x, labels, layers, params, n_classes, eps_mode="clip"):
    """Forward + backward on one batch, :func:`pass_rows` rows at a time: (flat gradient sum, loss sum,
    correct count)."""
    rows, flat, loss, correct = pass_rows(layers, x.shape[1:]), 0.0, 0.0, 0
    for i in range(0, max(1, len(x)), rows):
        p, caches = forward(x[i:i + rows], layers, params)
        at = labels[i:i + rows]
        flat = flat + pack(backward(p - onehot(at, n_classes), layers, params, caches))
        loss += float(ce_terms(p, at, eps_mode).sum())
        correct += int((p.argmax(axis=1) == at).sum())
    return flat, loss, correct
