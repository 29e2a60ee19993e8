"""Student's t p-value and bootstrap weights."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def student_p_value() -> Callable[[float | None, float | None], float | None]:
    """Function of (t, degrees of freedom) giving the two-sided p-value of Student's t.

    Built inside a function so that it travels to the workers by value.
    """

    def beta_fraction(a: float, b: float, x: float) -> float:
        # Continued fraction of the incomplete beta function; takes about sqrt(max(a, b)) steps.
        tiny = 1e-300
        c = 1.0
        d = 1.0 / (1.0 - (a + b) * x / (a + 1.0) or tiny)
        value = d
        for m in range(1, 200_000):
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            for term in (even, odd):
                d = 1.0 / (1.0 + term * d or tiny)
                c = 1.0 + term / c or tiny
                value *= c * d
            if abs(c * d - 1.0) < 1e-15:
                break
        return value

    def incomplete_beta(a: float, b: float, x: float) -> float:
        if x <= 0.0 or x >= 1.0:
            return float(x >= 1.0)
        scale = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        front = math.exp(scale + a * math.log(x) + b * math.log1p(-x))
        if x < (a + 1.0) / (a + b + 2.0):
            return front * beta_fraction(a, b, x) / a
        return 1.0 - front * beta_fraction(b, a, 1.0 - x) / b

    def p_value(t: float | None, df: float | None) -> float | None:
        if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
            return None
        if math.isinf(t):
            return 0.0
        return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))

    return p_value


def t_p_value(t: Column, df: Column) -> Column:
    """P-value column; meant for the aggregated frame with one row per metric."""
    p_value = student_p_value()

    def series(ts: pd.Series, dfs: pd.Series) -> pd.Series:
        return pd.Series([p_value(a, b) for a, b in zip(ts, dfs)], dtype="object").astype("Float64")

    return F.pandas_udf(series, "double")(t, df)


def poisson_steps(limit: float = 2.0**-33) -> list[float]:
    """Cumulative Poisson(1) probabilities until the tail falls under ``limit``."""
    steps, term, total, k = [], math.exp(-1.0), 0.0, 0
    while 1.0 - total > limit:
        total += term
        steps.append(total)
        k += 1
        term /= k
    return steps


def number_from_md5(*parts: Column) -> Column:
    """Whole number below 2^32 from the first eight hex digits of md5; the same in any engine."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def uniform_from_hash(*parts: Column) -> Column:
    """Uniform in [0, 1) from xxhash64, as a column."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 32)).cast("double") / F.lit(4294967296.0)


def poisson_weight(uniform: Column) -> Column:
    """Poisson(1) count by inversion of a uniform, as a column."""
    expr = None
    steps = poisson_steps()
    for k, edge in enumerate(steps):
        expr = (F if expr is None else expr).when(uniform < F.lit(edge), F.lit(k))
    return expr.otherwise(F.lit(len(steps)))


#: Digests computed at a time: their words stay in a core's cache.
DIGESTS = 1 << 15


def md5_words() -> Callable[[Sequence[bytes], Sequence[bytes]], np.ndarray]:
    """Function of (heads, tails) giving the first four bytes of md5 of every head + tail as a number, heads x tails.

    Texts of one length share their layout, so each step of md5 is one array operation on a block of them; a text longer
    than one block of md5 is left to hashlib. Built inside a function so that it travels to the workers by value.
    """
    sines = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
    turns = (7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)
    start, at_once = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476), DIGESTS

    def block(words: list[np.ndarray | None]) -> np.ndarray:
        # ``words`` are the sixteen words of the texts, broadcast against each other; None is zero.
        shape = np.broadcast_shapes(*[w.shape for w in words if w is not None])
        a, b, c, d = (np.full(shape, s, "uint32") for s in start)
        f, high = np.empty(shape, "uint32"), np.empty(shape, "uint32")
        for i in range(61):  # the last three steps do not change the first word
            turn, kind = turns[i // 16][i % 4], i // 16
            if kind == 0:
                np.bitwise_xor(c, d, out=f)
                np.bitwise_and(f, b, out=f)
                np.bitwise_xor(f, d, out=f)
            elif kind == 1:
                np.bitwise_xor(b, c, out=f)
                np.bitwise_and(f, d, out=f)
                np.bitwise_xor(f, c, out=f)
            elif kind == 2:
                np.bitwise_xor(b, c, out=f)
                np.bitwise_xor(f, d, out=f)
            else:
                np.invert(d, out=f)
                np.bitwise_or(f, b, out=f)
                np.bitwise_xor(f, c, out=f)
            word = words[(i, 5 * i + 1, 3 * i + 5, 7 * i)[kind] % 16]
            f += a
            f += np.uint32(sines[i]) if word is None else word + np.uint32(sines[i])
            np.right_shift(f, np.uint32(32 - turn), out=high)
            np.left_shift(f, np.uint32(turn), out=f)
            f |= high
            f += b
            a, d, c, b, f = d, c, b, f, a
        return (b + np.uint32(start[0])).byteswap()

    def texts(parts: Sequence[bytes], size: int, at: int) -> np.ndarray:
        out = np.zeros((len(parts), 64), "uint8")
        out[:, at : at + size] = np.frombuffer(b"".join(parts), "uint8").reshape(len(parts), size)
        return out

    def words(heads: Sequence[bytes], tails: Sequence[bytes]) -> np.ndarray:
        out = np.empty((len(heads), len(tails)), "uint32")
        sizes, ends = np.array([len(h) for h in heads]), np.array([len(t) for t in tails])
        for size in np.unique(sizes):
            for end in np.unique(ends):
                rows, columns = np.flatnonzero(sizes == size), np.flatnonzero(ends == end)
                if size + end > 55:
                    for i in rows:
                        for j in columns:
                            out[i, j] = int.from_bytes(hashlib.md5(heads[i] + tails[j]).digest()[:4], "big")
                    continue
                right = texts([tails[j] for j in columns], end, size)
                right[:, size + end] = 0x80
                right[:, 56:58] = (size + end) * 8 % 256, (size + end) * 8 // 256
                right = right.view("<u4")
                step = max(1, at_once // len(columns))
                for first in range(0, len(rows), step):
                    own = rows[first : first + step]
                    left = texts([heads[i] for i in own], size, 0).view("<u4")
                    both = []
                    for w in range(16):
                        a, b = left[:, w, None], right[None, :, w]
                        both.append((a | b if b.any() else a) if a.any() else b if b.any() else None)
                    out[np.ix_(own, columns)] = block(both)
        return out

    return words


def uniforms(kind: str) -> Callable[[Sequence, np.ndarray], np.ndarray]:
    """Function of (seeds, replicates) giving a uniform in [0, 1) for each pair, seeds x replicates.

    ``md5`` takes texts and gives what any engine can: the first eight hex digits of md5 of ``seed|replicate``. ``hash``
    takes hashed seeds and mixes them with the replicate in 64 bits, which is much cheaper. Both travel by value.
    """

    digests = md5_words()

    def md5(seeds: Sequence[str | None], replicates: np.ndarray) -> np.ndarray:
        return digests([(seed or "").encode() for seed in seeds], [b"|%d" % r for r in replicates]) / 4294967296.0

    def mixed(seeds: np.ndarray, replicates: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = seeds.astype("int64").view("uint64")[:, None] + replicates.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
            x ^= x >> np.uint64(31)
        return (x >> np.uint64(32)) / 4294967296.0

    return {"md5": md5, "hash": mixed}[kind]


def poisson_counts() -> Callable[[np.ndarray], np.ndarray]:
    """Function from uniforms to Poisson(1) counts, as doubles; travels by value."""
    steps = poisson_steps()

    def counts(drawn: np.ndarray) -> np.ndarray:
        out = np.zeros(np.shape(drawn))
        for edge in steps:
            out += drawn >= edge
        return out

    return counts
