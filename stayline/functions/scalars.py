"""Scalar arithmetic: clamps, guarded ratios, activations, hash buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMIT = 1e8  # fixed value: feature values are clamped to ±LIMIT


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def number(text: Column | str) -> Column:
    """String → double, NULL for anything a JVM parser rejects (Spark also reads ``inf`` and ``nan``)."""
    text = _c(text)
    signed = lambda *names: [s + n for s in ("", "+", "-") for n in names]
    odd = F.lower(F.trim(text)).isin(signed("inf", "nan", "infinity")) & ~F.trim(text).isin(signed("NaN", "Infinity"))
    return F.when(~odd, text.try_cast("double"))


def clamp(x: Column | str, limit: float = LIMIT) -> Column:
    """x cut to ±limit; NULL stays NULL (``least`` and ``greatest`` alone would skip it)."""
    x = _c(x)
    return F.when(x > limit, F.lit(limit)).when(x < -limit, F.lit(-limit)).otherwise(x)


def guarded_ratio(n: Column | str, d: Column | str, guard: float = 0.001) -> Column:
    """n / d, or 0 where |d| is below the guard."""
    return F.when(F.abs(_c(d)) >= guard, F.try_divide(_c(n), _c(d))).otherwise(F.lit(0.0))


def sigmoid(x: Column | str) -> Column:
    return 1.0 / (1.0 + F.exp(-_c(x)))


def scaled_tanh(x: Column | str) -> Column:
    """1.7159·tanh(2x/3)."""
    return 1.7159 * F.tanh(_c(x) * (2.0 / 3.0))


def hash_number(key: Column | str, seed: int | str) -> Column:
    """A 32-bit number (bigint) from md5 of ``key:seed``: the same in any engine and any partitioning."""
    digest = F.md5(F.concat(_c(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def share_limit(share: float) -> int:
    """The bound below which ``share`` of all 32-bit hash numbers lie."""
    return round(share * 2**32)
