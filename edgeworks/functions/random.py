"""Random numbers that depend only on seed, key and row id, so partitioning never changes them. All but the counted ones are columns of built-in functions."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = float(1 << 52)
#: Draws of a gamma number; each is taken with a probability of over 0.95.
TRIES = 24
#: Terms of the series of the normal distribution within one sd of the mean.
TERMS = 16
# fixed values: coefficients of algorithm AS 241 (Wichura 1988) for the middle of the normal distribution, from the lowest power on
QUANTILE_OVER = (3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125, 45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727)
QUANTILE_UNDER = (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077, 21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610)


def keyed_uniform(seed: int, key: int, row_id: Column | str, draw: Column | int | None = None) -> Column:
    """A double in [0, 1): the first 52 bits of a digest of seed, key, id and the number of the draw, if there are several."""
    parts = [F.lit(str(seed)), F.lit(str(key)), F.col(row_id).cast("string") if isinstance(row_id, str) else row_id.cast("string")]
    if draw is not None:
        parts.append(draw.cast("string") if isinstance(draw, Column) else F.lit(str(draw)))
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long") / F.lit(_SCALE)


_WORD = (1 << 32) - 1
# fixed values: rotations of eight rounds, and the parity word of the keys (Threefry 2x32, Salmon et al. 2011)
ROTATIONS, PARITY, ROUNDS = (13, 15, 26, 6, 17, 29, 16, 24), 0x1BD11BDA, 20


def _words(*words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two words of 32 bits from a key of two and a counter of two, given as longs whose upper halves don't count: rounds of addition, rotation and exclusive or, with a part of the key added every fourth."""
    # words of 32 bits wrap by themselves
    a, b, low, high = (np.asarray(w).astype(np.uint32) for w in words)
    keys = (a, b, a ^ b ^ np.uint32(PARITY))
    x, y = low + a, high + b
    for n in range(ROUNDS):
        r, k = ROTATIONS[n % len(ROTATIONS)], (n + 1) // 4
        x = x + y
        y = (y << np.uint32(r) | y >> np.uint32(32 - r)) ^ x
        if n % 4 == 3:
            x, y = x + keys[k % 3], y + keys[(k + 1) % 3] + np.uint32(k)
    return x, y


def counter_words(first: Column, second: Column, low: Column, high: Column) -> Column:
    """Two words of 32 bits, as a struct of longs x and y, from a key of two words and a counter of two; null where one of them is."""

    @F.arrow_udf("struct<x:long,y:long>")
    def run(a: pa.Array, b: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
        known = pc.and_(pc.and_(a.is_valid(), b.is_valid()), pc.and_(x.is_valid(), y.is_valid()))
        found = _words(*(np.asarray(pc.fill_null(c, 0)) for c in (a, b, x, y)))
        return pa.StructArray.from_arrays([pa.array(w.astype(np.int64)) for w in found], names=["x", "y"], mask=pc.invert(known))

    return run(*(c.cast("long") for c in (first, second, low, high)))


def keyed_counter(seed: int, key: int, row_id: Column | str, draw: int = 0) -> Column:
    """A double in [0, 1) with 52 random bits, counted and not digested: the key is seed and key, the counter the id's two halves, the upper one with the draw.

    Spark doesn't compile a value that is used twice a round, so the rounds run over whole Arrow batches.
    """
    one = lambda x: np.array([x & _WORD], np.int64)

    @F.arrow_udf("double")
    def run(ids: pa.Array) -> pa.Array:
        i = np.asarray(pc.fill_null(ids, 0))
        x, y = _words(one(seed), one(key), i & _WORD, i >> 32 & _WORD ^ draw << 16 & _WORD)
        return pa.array(((x.astype(np.int64) >> 6 << 26) + (y.astype(np.int64) >> 6)) / _SCALE, mask=np.asarray(ids.is_null()))

    return run((F.col(row_id) if isinstance(row_id, str) else row_id).cast("long"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _polynomial(coefficients: Sequence[float], x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def _known(mean: Column, sd: Column, wrong: Column, what: str, value: Column) -> Column:
    """value, null where a parameter is, and an error where no draw can satisfy them."""
    return F.when(mean.isNull() | sd.isNull(), F.lit(None).cast("double")).when(wrong, F.raise_error(F.lit(what)).cast("double")).otherwise(value)


def keyed_gamma(seed: int, key: int, row_id: Column, mean: Column, sd: Column) -> Column:
    """Gamma numbers by rejection from cubed normal ones (Marsaglia and Tsang): the first of TRIES draws that is taken. A shape under one is drawn one higher and scaled back."""
    shape, scale = mean * mean / (sd * sd), sd * sd / mean
    least = F.when(shape < 1, shape + 1).otherwise(shape) - F.lit(1 / 3)
    uniform = lambda k: keyed_uniform(seed, key, row_id, k)

    def attempt(d: Column, k: Column) -> Column:
        normal = F.sqrt(-2 * F.log(1 - uniform(3 * k))) * F.cos(F.lit(2) * F.pi() * uniform(3 * k + 1))
        return _let(normal, lambda z: _let(F.pow(1 + z / F.sqrt(9 * d), F.lit(3)), lambda v: F.when((v > 0) & (F.log(1 - uniform(3 * k + 2)) < 0.5 * z * z + d * (1 - v + F.log(v))), d * v)))

    drawn = _let(least, lambda d: F.coalesce(F.aggregate(F.sequence(F.lit(0), F.lit(TRIES - 1)), F.lit(None).cast("double"), lambda found, k: F.coalesce(found, attempt(d, k))), d))
    low = F.when(shape < 1, F.pow(1 - uniform(-1), 1 / shape)).otherwise(1.0)
    return _known(mean, sd, (mean <= 0) | (sd <= 0), "a gamma distribution needs positive mean and sd", drawn * low * scale)


def normal_cdf(x: Column) -> Column:
    """The standard normal distribution function for x within -1 to 1, by its series around 0."""

    def series(x: Column, square: Column) -> Column:
        out = F.lit(1.0)
        for k in range(TERMS, 0, -1):
            out = 1 + square / F.lit(2.0 * k + 1) * out
        return 0.5 + x * F.exp(-0.5 * square) / F.sqrt(2 * F.pi()) * out

    return _let(x, lambda x: _let(x * x, lambda square: series(x, square)))


def normal_quantile(p: Column) -> Column:
    """The inverse of normal_cdf(), for p within 0.075 to 0.925."""
    return _let(p - 0.5, lambda q: _let(F.lit(0.180625) - q * q, lambda r: q * _polynomial(QUANTILE_OVER, r) / _polynomial(QUANTILE_UNDER, r)))


def keyed_trunc_normal(seed: int, key: int, row_id: Column, mean: Column, sd: Column) -> Column:
    """Normal numbers within one sd of the mean and not below zero, by the inverse distribution function."""
    # one of the sd is 0 where all numbers are the mean
    low = F.greatest(F.lit(-1.0), F.coalesce(F.try_divide(-mean, sd), F.lit(-1.0)))
    b = F.lit(0.5 + 0.5 * math.erf(math.sqrt(0.5)))
    value = _let(normal_cdf(low), lambda a: F.greatest(F.lit(0.0), mean + sd * normal_quantile(a + keyed_uniform(seed, key, row_id) * (b - a))))
    return _known(mean, sd, (sd < 0) | (mean + sd < 0), "no value within one sd of the mean is zero or more", value)


def keyed_poisson(seed: int, key: int, row_id: Column, k: Column) -> Column:
    """1 + Poisson(k - 1) for k of 1 or more, else 1: how many sums of the terms a number is above, and one."""
    rate = F.greatest(F.lit(0.0), k - 1)
    # so many terms that the rest of the tail has no number in it
    most = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")

    def step(s: Column, n: Column) -> Column:
        term = s["term"] * rate / n
        return F.when(s["total"] >= s["u"], s).otherwise(F.struct(s["u"].alias("u"), term.alias("term"), (s["total"] + term).alias("total"), n.cast("long").alias("n")))

    start = F.struct(keyed_uniform(seed, key, row_id).alias("u"), F.exp(-rate).alias("term"), F.exp(-rate).alias("total"), F.lit(0).cast("long").alias("n"))
    return F.when(k.isNotNull(), F.aggregate(F.sequence(F.lit(1), most), start, step, lambda s: s["n"] + 1))


def check_params(mean: float, sd: float, distribution: str) -> None:
    """Reject parameters that no draw can satisfy."""
    if distribution == "gamma" and (mean <= 0 or sd <= 0):
        raise ValueError(f"a gamma distribution needs positive mean and sd, not {mean} and {sd}")
    if distribution == "truncated_normal" and (sd < 0 or mean + sd < 0):
        raise ValueError(f"no value within one sd of {mean} (sd {sd}) is zero or more")
