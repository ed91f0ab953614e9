"""Layer-list builders for the reference's two model families."""

from __future__ import annotations

from . import kernels as K


def lenet5(n_classes: int, channels: int = 1, size: int = 32) -> list[dict]:
    """conv 6@5×5 → ReLU → avg 2×2 → conv 16@5×5 → ReLU → avg 2×2 → 120 → 84 → classes.

    With 32×32×1 input and 33 classes this has 156 + 2,416 + 48,120 + 10,164 + 2,805
    parameters, as in the reference notebook.
    """
    layers = [
        K.conv(6, channels, 5), K.act("relu"), K.pool(2, 2, "avg"),
        K.conv(16, 6, 5), K.act("relu"), K.pool(2, 2, "avg"),
        K.flatten(),
    ]
    flat = K.output_shapes(layers, (size, size, channels))[-1][0]
    layers += [K.dense(flat, 120, "relu"), K.dense(120, 84, "relu"), K.dense(84, n_classes, "softmax")]
    if len(layers) < 5:
        raise ValueError("a CNN needs at least five layers")
    return layers


def mlp(layer_sizes: list[int]) -> list[dict]:
    """[input, hidden…, output]: ReLU hidden layers, softmax output (at least two classes)."""
    if len(layer_sizes) < 2 or any(int(s) <= 0 for s in layer_sizes):
        raise ValueError("layer_sizes needs at least two positive sizes")
    if layer_sizes[-1] < 2:
        raise ValueError("softmax output needs at least two classes")
    out = [K.dense(a, b, "relu") for a, b in zip(layer_sizes[:-2], layer_sizes[1:-1])]
    return out + [K.dense(layer_sizes[-2], layer_sizes[-1], "softmax")]
