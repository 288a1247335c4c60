"""Evaluation / ensembling / split properties."""

import math

from pyspark.sql import functions as F

from vitrine.operators import ensemble as ens
from vitrine.operators import evaluate as ev
from vitrine.operators import history as hist
from vitrine.operators import split as sp
from vitrine.sources import views
from conftest import SF_MED


def test_probabilities_sum_to_one(spark):
    p = views.predictions(spark, SF_MED)
    sums = p.select(F.aggregate("probs", F.lit(0.0), lambda a, v: a + v).alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-9 for r in sums)


def test_argmax_first_index_on_ties(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],), ([0.5, 0.5, 0.0],)], "p array<double>")
    assert [r.a for r in df.select(ev.argmax(F.col("p")).alias("a")).collect()] == [1, 0]


def test_ensemble_of_one_model_is_that_model(spark):
    p = views.predictions(spark, SF_MED).filter("split = 'val'")
    g = ens.gather(p, ["model_a"])
    out = g.select(F.element_at("by_model", F.lit("model_a")).alias("a"),
                   ens.weighted_average(F.col("by_model"), ["model_a"]).alias("b")).collect()
    assert all(all(math.isclose(x, y) for x, y in zip(r.a, r.b)) for r in out)


def test_metrics_match_hand_computation(spark):
    rows = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 1)]
    df = spark.createDataFrame(rows, "y_true int, y_pred int").withColumn("g", F.lit(1))
    m = ev.metrics(ev.confusion(df, ["g"]), ["g"]).first()
    # labels {0,1,2}: p=(1, .5, 0) r=(.5, 1, 0) f1=(2/3, 2/3, 0)
    assert math.isclose(m.accuracy, 0.6)
    assert math.isclose(m.f1_macro, (2 / 3 + 2 / 3) / 3)
    assert math.isclose(m.f1_weighted, (2 / 3 * 2 + 2 / 3 * 2) / 5)


def test_stratified_quotas_are_exact(spark):
    lst = views.listing_doc(spark, SF_MED).select("row_id", "prdtypecode")
    s = sp.stratified_split(lst, "row_id", "prdtypecode", 0.15, 42)
    n = lst.count()
    assert s.filter("split = 'test'").count() == math.ceil(0.15 * n)
    per = s.groupBy("prdtypecode").agg(F.sum((F.col("split") == "test").cast("int")).alias("t"), F.count("*").alias("n")).collect()
    n_test = math.ceil(0.15 * n)
    for r in per:
        assert abs(r.t - r.n * n_test / n) < 1.0


def _plain_split(rows, test_size, seed):
    """(label, id) -> number of test rows, by the rule of the split on plain lists."""
    import hashlib
    key = lambda i: (0, 0, 0) if i is None else (1, int(hashlib.md5(f"{i}_{seed}".encode()).hexdigest()[:15], 16), i)
    by_class = {}
    for i, c, _ in rows:
        by_class.setdefault(c, []).append(i)
    n_test = math.ceil(test_size * len(rows))
    share = {c: len(x) * n_test / len(rows) for c, x in by_class.items()}
    quota = {c: math.floor(v) for c, v in share.items()}
    for c in sorted(share, key=lambda c: (-(share[c] - quota[c]), c))[:n_test - sum(quota.values())]:
        quota[c] += 1
    out = {}
    for c, ids in by_class.items():
        for i in sorted(ids, key=key)[:quota[c]]:
            out[c, i] = out.get((c, i), 0) + 1
    return out


def test_split_of_repeated_and_null_ids(spark):
    rows = [(None if k % 9 == 0 and k < 200 else k // 5, "abc"[k % 7 % 3], f"text {k}") for k in range(400)] + [(5000, "d", "one")] + [(None, "e", f"n {k}") for k in range(30)]
    df = spark.createDataFrame(rows, "id long, label string, text string").repartition(3)
    for test_size, seed in ((0.15, 42), (0.5, 1), (0.31, 7)):
        got = sp.stratified_split(df, "id", "label", test_size, seed)
        assert got.columns == ["id", "label", "text", "split"]
        seen = got.collect()
        assert sorted(r.text for r in seen) == sorted(t for _, _, t in rows)
        per = {}
        for r in seen:
            if r.split == "test":
                per[r.label, r.id] = per.get((r.label, r.id), 0) + 1
        assert per == _plain_split(rows, test_size, seed)


def test_split_moves_ids_and_labels_alone(spark, monkeypatch):
    """Texts stay where they are: the ranked rows have no other column."""
    from vitrine.operators import ranking
    written, ranges = [], ranking.range_parts
    monkeypatch.setattr(ranking, "range_parts", lambda df, *a: (written.append(df.columns), ranges(df, *a))[1])
    df = spark.range(500).select(F.col("id"), (F.col("id") % 4).alias("label"), F.repeat(F.lit("long text "), 50).alias("text"))
    got = sp.stratified_split(df, "id", "label", 0.2, 42)
    assert written == [["id", "label", "__key"]]
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.where("split = 'test'").count() == 100


def test_early_stop_fold_matches_distributed(spark):
    log = views.epoch_log(spark, SF_MED)
    dist = {r.name: r.stop_epoch for r in hist.early_stop_epoch(log, patience=3).collect()}
    arrs = log.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("epoch", "val_f1"))).alias("h"))
    fold = arrs.select("name", hist.early_stop_fold(F.transform("h", lambda x: x["val_f1"]), 3, 0.0).alias("s")).collect()
    for r in fold:
        assert r.s == dist[r.name], r.name
