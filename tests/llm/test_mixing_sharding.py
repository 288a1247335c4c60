"""Source mixing and sharding against plain Python, and their edge cases."""

import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from vitrine.llm import mixing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, weights, cap):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        rest = total - sum(cap * sizes[s] for s in full)
        target = {s: cap * sizes[s] if s in full else rest * weight[s] / sum(weight[x] for x in free) for s in names}
        over = {s for s in free if target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def corpus(seed=1, n=600):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        source = rng.choice(["hot"] * 6 + ["a", "Z", "é", "tiny", None])
        if source == "tiny" and i % 9:
            source = "hot"
        out.append((i, source, " ".join("w" for _ in range(rng.choice([0, 1, 3, 30, 30, 200])))))
    return out + [(n, "hot", None), (n + 1, "void", ""), (3, "a", "repeated id"), (3, "a", "repeated id"), (None, None, "x y"), (n + 2, "hot", "w " * 5_000)]


def test_targets_and_taken(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, source string, text string, size int, target string")
    out = mixing.mix(df)
    got = out.collect()
    sizes = collections.Counter()
    for _, s, t in rows:
        sizes[s] += len(WORD.findall(t or ""))
    target = water_fill(sizes, mixing.WEIGHTS, mixing.CAP)
    assert len(got) == len(rows) and out.columns[:3] == ["doc_id", "source", "text"]
    taken = collections.Counter()
    for r in got:
        size = len(WORD.findall(r["text"] or ""))
        assert r["size"] == size and r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], target[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * size
        taken[r["source"]] += r["taken"]
    for s, goal in target.items():
        assert abs(taken[s] - goal) <= max(3, 0.01 * goal), (s, taken[s], goal)
    again = collections.Counter((r["doc_id"], r["source"], r["copies"]) for r in mixing.mix(df.repartition(5)).collect())
    assert again == collections.Counter((r["doc_id"], r["source"], r["copies"]) for r in got)
    copies = mixing.repeat(out, ["doc_id", "text"])
    assert copies.count() == sum(r["copies"] for r in got)


def test_rates_meet_the_targets_before_rounding(spark):
    rows = [(i, "ab"[i % 3 == 0], "w " * (1 + i % 17)) for i in range(300)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    by = collections.defaultdict(float)
    tilt = collections.defaultdict(list)
    for r in got:
        by[r["source"]] += r["rate"] * r["size"]
        if 0 < r["rate"] < 3:
            tilt[r["source"]].append((r["size"], math.log(r["rate"])))
    for r in got:
        assert math.isclose(by[r["source"]], r["target"], rel_tol=1e-4)
    for pairs in tilt.values():  # the logarithm of a rate is proportional to the size
        slopes = [y / x for x, y in pairs]
        assert max(slopes) - min(slopes) < 1e-4


@pytest.mark.parametrize("rows", [[], [(1, "a", None)], [(1, None, "one")], [(1, "a", "x"), (2, "b", "y z")]])
def test_small_tables(spark, rows):
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    for r in got:
        assert r["taken"] <= 3 * r["size"]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 41, 1000, 4099])
def test_permutation_is_a_bijection(n):
    assert sorted(sharding.permute_number(x, n, 9) for x in range(n)) == list(range(n))


def test_column_form_equals_the_function(spark):
    for n in (1, 7, 997):
        got = spark.range(n).select("id", sharding.permuted(F.col("id"), n, 5).alias("p")).collect()
        assert all(r["p"] == sharding.permute_number(r["id"], n, 5) for r in got)


def test_shards_and_slots(spark):
    rows = [(i % 90, None if i % 11 == 0 else f"t{i % 7}", i) for i in range(211)] + [(None, "n", 1), (None, "n", 1), (5, "long" * 50_000, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    out = sharding.shard(df, 8, ["doc_id", "text"], seed=3)
    assert out.columns == ["doc_id", "text", "shard", "slot"]
    by = collections.defaultdict(list)
    got = out.collect()
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert sorted(by) == list(range(8)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "")
    groups = collections.defaultdict(list)
    for r in got:
        groups[key(r)].append((r["shard"], r["slot"]))
    number = 0
    for k in sorted(groups):  # rows alike in the order take consecutive numbers
        places = [sharding.permute_number(number + i, len(rows), 3) for i in range(len(groups[k]))]
        assert sorted(groups[k]) == sorted((p % 8, p // 8) for p in places)
        number += len(places)
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, sharding.shard(df.repartition(3), 8, ["doc_id", "text"], seed=3).collect()))
    assert sharding.shard(df.where("false"), 8, ["doc_id"]).collect() == []
