"""A keyed bijection on dense sample ids: a shuffle without sort or exchange.

Ids 0 .. n-1 are written as pairs (x, y) of an a-by-b grid that just holds n cells.
Each round adds a keyed function of one half to the other, modulo its width, which
can be undone, so the rounds together permute the grid. A result outside 0 .. n-1
is sent through again until it falls inside, which permutes the ids themselves.
Every row computes its own position; nothing is ranked, sorted or moved.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIME = 1_073_741_789  # the largest below 2**30: squares of sums stay in 64 bits
ROUNDS = 8  # even, so that both halves end where they began
WALK = 64  # the grid has at most 2 sqrt(n) + 1 cells too many, so more steps are needed with a chance below 1e-30


def round_keys(seed: int) -> list[tuple[int, int]]:
    """Two constants per round from the seed."""
    digest = hashlib.sha512(str(seed).encode()).digest()
    numbers = [int.from_bytes(digest[4 * i : 4 * i + 4], "big") % PRIME for i in range(2 * ROUNDS)]
    return list(zip(numbers[::2], numbers[1::2], strict=True))


def grid(n: int) -> tuple[int, int]:
    """Widths a and b of the smallest near-square grid with n cells or more."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _stir(y: Column, keys: Column) -> Column:
    """Squares a half twice, modulo the prime, with a key added each time."""
    return F.aggregate(F.array(keys["k"], keys["l"]), y, lambda v, k: ((v + k) * (v + k)) % PRIME)


def _permute(at: Column, a: Column, b: Column, keys: Column) -> Column:
    half = F.struct(
        F.call_function("div", at, b).alias("x"), (at % b).alias("y"), a.alias("m"), b.alias("w")
    )

    def turn(s: Column, k: Column) -> Column:
        moved = (s["x"] + _stir(s["y"], k)) % s["m"]
        return F.struct(s["y"].alias("x"), moved.alias("y"), s["w"].alias("m"), s["m"].alias("w"))

    return F.aggregate(keys, half, turn, lambda s: s["x"] * s["w"] + s["y"])


def permuted(at: Column, n: Column, a: Column, b: Column, seed: int) -> Column:
    """The position of id ``at`` among 0 .. n-1; n at most 2**60."""
    keys = F.array(
        *[F.struct(F.lit(k).cast("long").alias("k"), F.lit(v).cast("long").alias("l")) for k, v in round_keys(seed)]
    )
    at, a, b = (c.cast("long") for c in (at, a, b))
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        _permute(at, a, b, keys),
        lambda v, _: F.when(v < n, v).otherwise(_permute(v, a, b, keys)),
    )
    # One more field read of the aggregate, never a second evaluation of it.
    checked = F.transform(F.array(walked), lambda v: F.when(v < n, v).otherwise(F.raise_error(F.lit("no position found"))))
    return F.get(checked, F.lit(0)).cast("long")


def shuffle_positions(
    samples: DataFrame, sizes: Mapping[str, int], seed: int, order: str = "sample_id", split: str = "split", name: str = "shuffled"
) -> DataFrame:
    """Add dense pseudo-random positions 0 .. n-1 within each split.

    ``order`` holds dense ids from 0, ``sizes`` the number of ids of each split
    (see ``split_sizes``). Rows of a split without a size, or with a NULL or
    foreign id, get NULL.
    """
    if not sizes:
        return samples.withColumn(name, F.lit(None).cast("long"))
    known = {s: (n, *grid(n)) for s, n in sizes.items()}
    n, a, b = (
        F.create_map(*[F.lit(x) if i == 0 else F.lit(x).cast("long") for s, v in known.items() for i, x in ((0, s), (1, v[at]))])[F.col(split)]
        for at in range(3)
    )
    inside = (F.col(order) >= 0) & (F.col(order) < n)
    return samples.withColumn(name, F.when(inside, permuted(F.col(order), n, a, b, seed)))
