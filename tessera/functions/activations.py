"""Activation functions and derivatives as JVM expressions (scalars and arrays)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def relu(v: Column) -> Column:
    return F.greatest(F.lit(0.0), v)


def relu_grad(v: Column) -> Column:
    return (v > 0).cast("double")


def tanh(v: Column) -> Column:
    return F.tanh(v)


def tanh_grad(v: Column) -> Column:
    t = F.tanh(v)
    return F.lit(1.0) - t * t


def sigmoid(v: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-v))


def sigmoid_grad_from_output(a: Column) -> Column:
    """Derivative written in terms of the activation ``a = σ(z)``: ``a(1 − a)``."""
    return a * (F.lit(1.0) - a)


def sigmoid_grad(v: Column) -> Column:
    return sigmoid_grad_from_output(sigmoid(v))


_SCALAR = {
    "relu": relu,
    "relu_grad": relu_grad,
    "tanh": tanh,
    "tanh_grad": tanh_grad,
    "sigmoid": sigmoid,
    "sigmoid_grad": sigmoid_grad,
    "linear": lambda v: v,
}


def scalar(name: str, v: Column) -> Column:
    try:
        return _SCALAR[name](v)
    except KeyError:
        raise ValueError(f"unknown activation {name!r}") from None


def array_softmax(arr: Column) -> Column:
    """Max-shifted softmax over an array<double> column, in one projection.

    Row-level scalars (max, sum) enter the element-wise step through ``array_repeat`` +
    ``zip_with`` instead of being referenced inside a lambda, so each is evaluated once per
    row rather than once per element (linear, not quadratic, in the array length).
    """
    n = F.size(arr)
    e = F.zip_with(arr, F.array_repeat(F.array_max(arr), n), lambda z, m: F.exp(z - m))
    total = F.aggregate(e, F.lit(0.0), lambda acc, z: acc + z)
    return F.zip_with(e, F.array_repeat(total, F.size(e)), lambda z, t: z / t)
