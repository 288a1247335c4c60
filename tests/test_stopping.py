"""Early stopping with a least improvement against the rule step by step."""

import random

import pytest

from vitrine.operators.stopping import early_stop_min_delta, range_map


def plain(scores, patience, min_delta, mode):
    best = best_epoch = None
    for epoch, x in enumerate(scores, 1):
        if best is None or (x > best + min_delta if mode == "max" else x < best - min_delta):
            best, best_epoch = x, epoch
        elif epoch - best_epoch >= patience:
            return epoch, best_epoch, best, len(scores)
    return None, best_epoch, best, len(scores)


def test_a_range_knows_every_way_through_it():
    rng = random.Random(1)
    for _ in range(300):
        scores = [round(rng.random(), 2) for _ in range(rng.randrange(1, 25))]
        epochs = list(range(7, 7 + len(scores)))
        for record, epoch, best, best_epoch, stop in range_map(epochs, scores, 4, 0.1):
            at = epoch - 7
            assert scores[at] == record and all(x < record for x in scores[:at])
            want_stop, want_epoch, want, _ = plain(scores[at:], 4, 0.1, "max")
            left = want_stop if want_stop is not None and want_stop + at + 6 < epochs[-1] + 1 and any(x > want + 0.1 for x in scores[at + want_epoch:]) else None
            if left is not None:
                assert (best, best_epoch, stop) == (want, want_epoch + at + 6, want_epoch + at + 6 + 4)
            elif stop is None:
                assert best_epoch >= epoch


@pytest.mark.parametrize("mode", ["max", "min"])
@pytest.mark.parametrize("min_delta, patience", [(0.0, 2), (0.05, 3), (0.3, 40)])
def test_runs_equal_the_rule(spark, mode, min_delta, patience):
    rng = random.Random(3)
    runs = {f"r{k}": [round(rng.random(), 2) for _ in range(rng.randrange(1, 30))] for k in range(40)}
    runs["rising"] = [k * 0.03 for k in range(400)]
    runs["long"] = [round(0.001 * k + rng.random() * 0.2, 3) for k in range(600)]  # over a third of all rows
    runs["flat"] = [0.5] * 50
    runs[None] = [0.1, 0.9, 0.2]
    rows = [(n, e, x, 1) for n, xs in runs.items() for e, x in enumerate(xs, 1)]
    rng.shuffle(rows)
    log = spark.createDataFrame(rows, "name string, epoch int, val_f1 double, part int").repartition(6)
    got = {r["name"]: tuple(r)[1:] for r in early_stop_min_delta(log, patience, min_delta, mode=mode).collect()}
    assert got == {n: plain(xs, patience, min_delta, mode) for n, xs in runs.items()}


def test_empty_log(spark):
    assert early_stop_min_delta(spark.createDataFrame([], "name string, epoch int, val_f1 double")).collect() == []
