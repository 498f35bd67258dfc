"""Vector and activation functions over arrays, in higher-order functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO = 0.0


def _fold(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once: what stands in the body of a lambda is computed again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def dot(a: Column, b: Column) -> Column:
    return _fold(F.zip_with(a, b, lambda x, y: x.cast("double") * y))


def norm(a: Column) -> Column:
    return F.sqrt(_fold(F.transform(a, lambda x: x.cast("double") * x)))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_fold(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y, 2))))


def manhattan(a: Column, b: Column) -> Column:
    return _fold(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y)))


#: Similarities by name; distances are negated.
SIMILARITIES = {"cosine": cosine, "dot": dot, "euclidean": lambda a, b: -euclidean(a, b), "manhattan": lambda a, b: -manhattan(a, b)}


def similarity(name: str, a: Column, b: Column) -> Column:
    if name not in SIMILARITIES:
        raise ValueError(f"unknown similarity {name}")
    return SIMILARITIES[name](a, b)


def cauchy(a: Column, b: Column, weights: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y, 2))
    return 1 / (1 + _fold(F.zip_with(squares, weights, lambda s, w: s * w)))


def angle(a: Column, b: Column) -> Column:
    """Absolute sum of the parts of the quotient of two vectors taken as complex numbers (first half real, second half imaginary), scaled by their lengths."""
    half = lambda v, k: F.slice(v, k * F.floor(F.size(v) / 2).cast("int") + 1, F.floor(F.size(v) / 2).cast("int"))
    re_a, im_a, re_b, im_b = half(a, 0), half(a, 1), half(b, 0), half(b, 1)
    both = _fold(F.zip_with(re_a, re_b, lambda x, y: x.cast("double") * y)) + _fold(F.zip_with(im_a, im_b, lambda x, y: x.cast("double") * y))
    cross = _fold(F.zip_with(im_a, re_b, lambda x, y: x.cast("double") * y)) - _fold(F.zip_with(re_a, im_b, lambda x, y: x.cast("double") * y))
    z = dot(b, b)
    return F.abs((both / z + cross / z) / (norm(a) / norm(b)))


def l2_normalize(a: Column) -> Column:
    return _once(F.greatest(norm(a), F.lit(1e-12)), lambda n: F.transform(a, lambda x: x / n))


def truncate(a: Column, dims: int) -> Column:
    return F.slice(a, 1, dims)


def keep_largest(a: Column, n: int) -> Column:
    """Zeroes all but the ``n`` largest components by magnitude; ties keep the earlier."""
    pairs = F.transform(a, lambda x, i: F.struct((-F.abs(x)).alias("m"), i.alias("i")))
    kept = F.transform(F.slice(F.array_sort(pairs), 1, n), lambda p: p["i"])
    return _once(kept, lambda k: F.transform(a, lambda x, i: F.when(F.array_contains(k, i), x).otherwise(0.0)))


def sparse(a: Column) -> Column:
    """(indices, values) of the components that are not 0."""
    kept = F.filter(F.transform(a, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda p: p["x"] != 0)
    return F.struct(F.transform(kept, lambda p: p["i"]).alias("indices"), F.transform(kept, lambda p: p["x"]).alias("values"))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def softmax(a: Column, temperature: float = 1.0) -> Column:
    e = _once(F.array_max(a), lambda top: F.transform(a, lambda x: F.exp((x.cast("double") - top) / temperature)))
    return _once(e, lambda e: _once(_fold(e), lambda total: F.transform(e, lambda x: x / total)))


def multi_softmax(a: Column, sizes: list[int]) -> Column:
    parts, at = [], 1
    for n in sizes:
        parts.append(softmax(F.slice(a, at, n)))
        at += n
    return F.concat(*parts)


def clipped_linear(x: Column, slope: float = 1.0, offset: float = 0.0, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(x * slope + offset, F.lit(low)), F.lit(high))


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def relu_k(x: Column, k: float = 6.0) -> Column:
    return F.least(relu(x), F.lit(k))


def hard_sigmoid(x: Column) -> Column:
    return clipped_linear(x, 0.2, 0.5)


def hard_tanh(x: Column) -> Column:
    return clipped_linear(x, 1.0, 0.0, -1.0, 1.0)


def erf(x: Column) -> Column:
    """Rational approximation with an error below 1.5e-7 (coefficients are fixed values)."""
    t = 1 / (1 + 0.3275911 * F.abs(x))
    poly = ((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t
    return F.signum(x) * (1 - poly * F.exp(-x * x))


def gelu(x: Column) -> Column:
    return 0.5 * x * (1 + erf(x / math.sqrt(2)))


def swish(x: Column) -> Column:
    return x * sigmoid(x)


def hard_swish(x: Column) -> Column:
    return x * hard_sigmoid(x)


def hard_swish_mobile(x: Column) -> Column:
    return x * F.least(relu(x + 3), F.lit(6.0)) / 6


def mish(x: Column) -> Column:
    return x * F.tanh(F.log1p(F.exp(x)))


def dish(x: Column) -> Column:
    return 0.5 * x * (x / F.sqrt(1 + x * x) + 1)


def maxout(a: Column, pieces: int) -> Column:
    n = (F.size(a) / pieces).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array_max(F.slice(a, i * pieces + 1, pieces)))


def layer_norm(a: Column, eps: float = 1e-8) -> Column:
    n = F.greatest(F.size(a), F.lit(1))
    centred = _once(_fold(F.transform(a, lambda x: x.cast("double"))) / n, lambda mean: F.transform(a, lambda x: x - mean))
    return _once(centred, lambda c: _once(F.sqrt(_fold(F.transform(c, lambda x: x * x)) / n + eps), lambda dev: F.transform(c, lambda x: x / dev)))


def linear(a: Column, weights: list[list[float]], bias: list[float]) -> Column:
    rows = [dot(a, F.array(*[F.lit(float(w)) for w in row])) + float(b) for row, b in zip(weights, bias, strict=True)]
    return F.array(*rows)


def each(f, a: Column, *args) -> Column:
    """``f`` on every element."""
    return F.transform(a, lambda x: f(x.cast("double"), *args))


def pad(a: Column, length: Column, value=0.0) -> Column:
    return F.concat(a, F.array_repeat(F.lit(value), F.greatest(F.lit(0), length - F.size(a))))
