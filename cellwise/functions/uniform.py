"""Uniform numbers in [0, 1) that depend on a row's key, not on its place.

``rand(seed)`` draws by partition, so a retried task after an executor loss, or
another partition count, may see other rows.  Hashing ``(seed, stream, key)``
gives every row the same number on every attempt.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MANTISSA = 1 << 53


def keyed_uniform(key: Column | str, seed: int, stream: int | str = 0, rng: str = "xxhash64") -> Column:
    """Uniform double for ``key`` in the random stream ``(seed, stream)``.

    ``rng="xxhash64"`` is the fast default; ``rng="md5"`` is slower but can be
    reproduced by any SQL engine that has ``md5``.
    """
    key = F.col(key) if isinstance(key, str) else key
    if rng == "xxhash64":
        hashed = F.xxhash64(key, F.lit(seed), F.lit(stream))
        return F.pmod(hashed, F.lit(_MANTISSA)).cast("double") / F.lit(float(_MANTISSA))
    if rng == "md5":
        text = F.concat(F.lit(f"{seed}:{stream}:"), key.cast("string"))
        digits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10)
        return digits.cast("double") / F.lit(float(1 << 52))
    raise ValueError(f"unknown rng {rng!r}: use 'xxhash64' or 'md5'")


def keyed_normal(key: Column | str, seed: int, stream: int | str = 0, rng: str = "xxhash64") -> Column:
    """Standard normal double for ``key`` by the Box-Muller transform."""
    u1 = keyed_uniform(key, seed, f"{stream}/radius", rng)
    u2 = keyed_uniform(key, seed, f"{stream}/angle", rng)
    # 1 - u1 lies in (0, 1], so the logarithm is finite
    return F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u1)) * F.cos(F.lit(6.283185307179586) * u2)
