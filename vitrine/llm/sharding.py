"""Reproducible shuffle into shards by a Feistel permutation.

Rows are numbered 0 .. N - 1 in a given order; a keyed Feistel network over
``a * b >= N`` pairs permutes the numbers, walking along its cycle past results
from N on.  The permuted number gives the shard (modulo) and the slot
(quotient), so either is computable from the row number alone, and shard sizes
differ by at most one.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import row_numbers

ROUNDS = 3
PRIME = 2_147_483_647
#: Steps along a cycle.  A walk passes at most a * b - N < sqrt(N) + 1 foreign
#: numbers, so this is certain up to some 4,000 rows; beyond, a step misses with
#: a chance below 1 / sqrt(N), and raise_error() stands guard.
WALK = 64


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    """Two rounds of (factor, summand, summand) per step of the network."""
    out = []
    for k in range(2 * ROUNDS):
        d = hashlib.sha256(f"{seed}/{k}".encode()).digest()
        out.append(tuple(int.from_bytes(d[i:i + 4], "big") % (PRIME - 1) + 1 for i in (0, 4, 8)))
    return out


def domain(n: int) -> tuple[int, int]:
    """Sides of the network: the smallest near-square product of at least n."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def permute_number(x: int, n: int, seed: int) -> int:
    """The permutation on one number (to find a row's place without the table)."""
    a, b = domain(n)
    keys = round_keys(seed)
    scramble = lambda v, k: (((v * k[0] + k[1]) % PRIME) ** 2 + k[2]) % PRIME
    while True:
        left, right = divmod(x, b)
        for i in range(ROUNDS):
            left = (left + scramble(right, keys[2 * i])) % a
            right = (right + scramble(left, keys[2 * i + 1])) % b
        x = left * b + right
        if x < n:
            return x


def permuted(number: Column, n: int, seed: int) -> Column:
    """:func:`permute_number` as a column expression."""
    a, b = domain(n)
    keys = round_keys(seed)
    names = ("f1", "s1", "t1", "f2", "s2", "t2")
    steps = F.array(*(F.struct(*(F.lit(v).cast("long").alias(c) for c, v in zip(names, (*keys[2 * i], *keys[2 * i + 1]), strict=True))) for i in range(ROUNDS)))

    def scramble(v: Column, k: Column, i: int) -> Column:
        t = (v * k[f"f{i}"] + k[f"s{i}"]) % PRIME
        return (t * t + k[f"t{i}"]) % PRIME

    def step(pair: Column, k: Column) -> Column:
        left = (pair["left"] + scramble(pair["right"], k, 1)) % a
        return F.struct(left.alias("left"), ((pair["right"] + scramble(left, k, 2)) % b).alias("right"))

    def once(x: Column) -> Column:
        start = F.struct(F.call_function("div", x, F.lit(b)).alias("left"), (x % b).alias("right"))
        return F.aggregate(steps, start, step, lambda pair: pair["left"] * b + pair["right"])

    first = once(number)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, lambda x, _: F.when(x < n, x).otherwise(once(x)))
    sure = F.when(walked < n, walked).otherwise(F.raise_error(F.lit("the walk left the permutation's domain")).cast("long"))
    return F.when(first < n, first).otherwise(sure)


def shard(docs: DataFrame, n_shards: int, order: list[str], seed: int = 1) -> DataFrame:
    """All columns of ``docs`` plus ``shard`` (int) and ``slot`` (long).

    Rows are numbered in ascending ``order``, NULL first.  Rows that agree in
    all of ``order`` take consecutive numbers; name further columns to fix
    which is which.  Input columns named ``shard`` or ``slot`` are replaced.
    Texts, empty or long, play no part; an empty table gives an empty result,
    and fewer rows than shards leave the last ones empty.
    """
    given = [c for c in docs.columns if c not in ("shard", "slot")]
    inner = {c: f"__c{k}" for k, c in enumerate(given)}
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in inner.items()))
    numbered = row_numbers(rows, [inner[c] for c in order], "__number", "shards")
    n = numbered.count()
    placed = numbered.withColumn("__place", permuted(F.col("__number"), max(n, 1), seed))
    return placed.select(*(F.col(v).alias(c) for c, v in inner.items()),
                         (F.col("__place") % n_shards).cast("int").alias("shard"), F.expr(f"__place div {n_shards}").alias("slot"))
