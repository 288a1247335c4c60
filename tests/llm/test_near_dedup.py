"""MinHash near-dedup against brute force, and its defined edge cases."""

import random
import re

import numpy as np
import pytest

from vitrine.llm import common, minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= width:
        return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}
    return {tuple(words)} if words else set()


def brute(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def corpus(seed=3, n=160):
    """Copies, near copies by a few replaced words, and unrelated texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(500)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 9, 40, 200, 400]))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 5, 9])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i * 7 % 1000, " ".join(words).upper() if i % 5 == 0 else "\t".join(words)))
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_components_equal_brute_force(spark, percent):
    rows = corpus()
    got = minhash.duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, percent)


def test_clusters_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 7)
    rows = corpus(seed=5)
    got = minhash.duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 85)


def test_defined_edge_cases(spark):
    long = " ".join(f"x{k}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One TWO"), (6, "one three"), (7, long), (8, long + " end"),
            (None, "one two"), (None, "alone here"), (9, "same id text a b c d"), (9, "same id text a b c d")]
    df = spark.createDataFrame([(i, t, 0, "q") for i, t in rows], "doc_id long, text string, kept int, component_id string")
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.duplicate_classes(df).collect()]
    by = {}
    for r in got:
        by.setdefault(r[0], []).append(r[1:])
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[4] == [(1, 4, True)] and by[5] == [(1, 4, False)] and by[6] == [(1, 6, True)]
    assert by[7] == [(59_996, 7, True)] and by[8] == [(59_997, 7, False)]
    assert by[9] == [(3, 9, True)] * 2
    assert sorted(by[None], key=str) == sorted([(1, 4, False), (1, None, True)], key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.duplicate_classes(df).collect() == []


def test_sketch_fills_every_coordinate_and_estimates_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 62, 900, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:800], rng.integers(0, 1 << 62, 100, dtype=np.uint64)]))
    s = minhash.sketch([a, b, a[:1], a[:3]], 352)
    assert not (s == minhash._EMPTY).any()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((s[0] == s[1]).mean() - true) < 0.1


def test_plan_meets_the_miss_rate():
    for percent in (80, 85, 90):
        r, b = minhash.plan(percent)
        assert (1 - (percent / 100) ** r) ** b <= minhash.MISS and r * b <= minhash.MAX_COORDINATES


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 2000), (2000, 1500), (5000, 5000)]
    got = common.components(spark.createDataFrame(edges, "a long, b long"))
    label = {r["id"]: r["component"] for r in got.collect()}
    assert all(label[k] == 0 for k in range(301)) and label[1500] == label[2000] == 1000


def test_too_little_similarity_raises():
    import pytest
    with pytest.raises(ValueError, match="no band plan"):
        minhash.plan(3)
    assert minhash.plan(4)[0] >= 1
