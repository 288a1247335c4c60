"""Ridge, SVM path and boosted trees against closed forms and plain Python."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vitrine.operators import boosting, experiments as X, linear
from vitrine.operators import models as mdl

N, D, K = 240, 500, 3


@pytest.fixture(scope="module")
def sparse(spark):
    rng = np.random.default_rng(0)
    x = np.where(rng.random((N, D)) < 0.03, rng.normal(size=(N, D)), 0)
    y = rng.integers(0, K, N)
    x[:, :3] += np.eye(3)[y] * 2
    x[7] = 0  # a row without entries
    rows = [(float(y[i]), Vectors.sparse(D, np.flatnonzero(x[i]).tolist(), x[i][np.flatnonzero(x[i])].tolist())) for i in range(N)]
    return x, y, spark.createDataFrame(rows, ["label", "features"]).repartition(3).cache()


def signs(y):
    return np.where(y[:, None] == np.arange(K), 1.0, -1.0)


def test_ridge_equals_the_closed_form_at_500_terms(sparse, monkeypatch):
    monkeypatch.setattr(linear, "BLOCK_ROWS", 50)
    x, y, df = sparse
    blocks = linear.row_blocks(df, K)
    model = linear.fit_ridge(blocks, alpha=2.0)
    xc, yc = x - x.mean(0), signs(y) - signs(y).mean(0)
    want = np.linalg.solve(xc.T @ xc + 2.0 * np.eye(D), xc.T @ yc)
    assert model.residual <= 1e-8 and np.allclose(model.weights, want, atol=1e-6)
    assert np.allclose(model.intercepts, signs(y).mean(0) - x.mean(0) @ want, atol=1e-6)
    got = linear.predict(model, df).select("label", "prediction").toPandas()
    assert (got.label == got.prediction).mean() > 0.95


def test_svm_path_reaches_the_optimum(sparse):
    x, y, df = sparse
    rows = np.hstack([x, np.ones((N, 1))])
    s = signs(y)
    weights = np.array([1.0, 2.0, 0.5])

    def objective(w, c):
        return (w ** 2).sum(0) / 2 + c * (weights[y][:, None] * np.maximum(1 - s * (rows @ w), 0) ** 2).sum(0)

    def newton(c):
        w = np.zeros((D + 1, K))
        for _ in range(60):
            for k in range(K):
                inside = s[:, k] * (rows @ w[:, k]) < 1
                a = rows[inside] * weights[y[inside]][:, None]
                w[:, k] = np.linalg.solve(np.eye(D + 1) + 2 * c * rows[inside].T @ a, 2 * c * a.T @ s[inside, k])
        return w
    blocks = linear.row_blocks(df, K)
    path = linear.svm_path(blocks, [0.3, 0.03], tol=1e-3, class_weights=weights)
    for c, model in zip((0.03, 0.3), path):
        assert model.residual <= 1e-3 and model.passes > 0
        got, best = objective(np.vstack([model.weights, model.intercepts]), c), objective(newton(c), c)
        at_zero = np.linalg.norm(2 * c * rows.T @ (weights[y][:, None] * s), axis=0)
        assert (got - best <= (1e-3 * at_zero) ** 2 / 2).all()  # the objective is 1-strongly convex


def test_wide_models_are_refused(spark):
    with pytest.raises(ValueError, match="exceed"):
        linear.RowBlocks(spark.range(1), 1 << 27, 27)


def test_rows_are_never_multiplied_into_a_square(sparse):
    """Every product is features x classes."""
    _, _, df = sparse
    blocks = linear.row_blocks(df, K)
    seen = []
    totals = blocks.totals
    blocks.totals = lambda work, n, width, **sent: (seen.append(width), totals(work, n, width, **sent))[1]
    linear.fit_ridge(blocks, tol=1e-2)
    assert max(seen) <= K + 2


def brute_trees(bins, y, n_classes, rounds, depth, rate=0.3, reg=1.0, least=1.0):
    """Scores of a plain booster on binned values."""
    n = len(y)
    scores = np.zeros((n, n_classes))
    for _ in range(rounds):
        e = np.exp(scores - scores.max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        g, h = p - (y[:, None] == np.arange(n_classes)), np.maximum(2 * p * (1 - p), 1e-16)
        after = scores.copy()
        for c in range(n_classes):
            def grow(rows, level):
                sg, sh = g[rows, c].sum(), h[rows, c].sum()
                best, parts = 0.0, None
                for f in range(bins.shape[1]) if level < depth else ():
                    for b in np.unique(bins[rows, f])[:-1]:
                        left = bins[rows, f] <= b
                        lg, lh = g[rows[left], c].sum(), h[rows[left], c].sum()
                        if lh < least or sh - lh < least:
                            continue
                        gain = round((lg ** 2 / (lh + reg) + (sg - lg) ** 2 / (sh - lh + reg) - sg ** 2 / (sh + reg)) / 2, boosting.DIGITS)
                        if gain > best:
                            best, parts = gain, (rows[left], rows[~left])
                if parts is None:
                    after[rows, c] -= rate * sg / (sh + reg)
                else:
                    grow(parts[0], level + 1)
                    grow(parts[1], level + 1)
            grow(np.arange(n), 0)
        scores = after
    return scores


def test_trees_equal_a_plain_booster(spark, monkeypatch):
    monkeypatch.setattr(boosting, "KEEP_ROUNDS", 2)
    monkeypatch.setattr(boosting, "RANGE", 8)
    rng = np.random.default_rng(4)
    n, d = 150, 20
    x = np.where(rng.random((n, d)) < 0.25, np.round(rng.normal(size=(n, d)), 1), 0)
    y = (x[:, 0] > 0.2).astype(int) + (x[:, 1] + x[:, 2] > 0.3)
    rows = [(float(y[i]), Vectors.sparse(d, np.flatnonzero(x[i]).tolist(), x[i][np.flatnonzero(x[i])].tolist())) for i in range(n)]
    df = spark.createDataFrame(rows, ["label", "features"]).repartition(3)
    model = boosting.fit(df, 3, n_rounds=4, max_depth=3, n_bins=8)
    binned = np.stack([model.bins.of(np.full(n, f), x[:, f]) for f in range(d)], axis=1)
    at = [np.flatnonzero(r) for r in x]
    got = model.scores(np.array([len(a) for a in at]), np.concatenate(at).astype(np.int32), np.concatenate([x[i][a] for i, a in enumerate(at)]))
    assert np.allclose(got, brute_trees(binned, y, 3, 4, 3), atol=1e-9)
    seen = boosting.predict(model, df).select("label", "prediction").toPandas()
    assert (seen.label == seen.prediction).mean() > 0.9


def test_trees_of_many_tasks_and_class_groups(spark, monkeypatch):
    """Small blocks, more tasks than cores and a job for each class give the same trees."""
    monkeypatch.setattr(boosting, "BLOCK_ENTRIES", 40)
    monkeypatch.setattr(boosting, "RANGE", 1)
    monkeypatch.setattr(boosting, "TASK_ENTRIES", 30)
    monkeypatch.setattr(boosting, "HELD_NUMBERS", 130)
    rng = np.random.default_rng(6)
    n, d = 120, 12
    x = np.where(rng.random((n, d)) < 0.3, np.round(rng.normal(size=(n, d)), 1), 0)
    x[:, 7] = x[:, 2]  # ties go to the smaller feature
    x[:5] = 0
    y = (x[:, 2] > 0.1).astype(int) + (x[:, 1] > 0.3)
    rows = [(float(y[i]), Vectors.sparse(d, np.flatnonzero(x[i]).tolist(), x[i][np.flatnonzero(x[i])].tolist())) for i in range(n)]
    model = boosting.fit(spark.createDataFrame(rows, ["label", "features"]).repartition(3), 3, n_rounds=2, max_depth=3, n_bins=8)
    assert model.jobs > 2 * 3  # levels
    assert not any(f == 7 for trees in model.rounds for t in trees for f, left in zip(t.feature, t.left) if left)
    binned = np.stack([model.bins.of(np.full(n, f), x[:, f]) for f in range(d)], axis=1)
    at = [np.flatnonzero(r) for r in x]
    got = model.scores(np.array([len(a) for a in at]), np.concatenate(at).astype(np.int32), np.concatenate([x[i][a] for i, a in enumerate(at)]))
    assert np.allclose(got, brute_trees(binned, y, 3, 2, 3), atol=1e-9)


def test_a_level_moves_rows_times_classes(spark):
    """What goes to the tasks of features does not grow with the rows' entries."""
    class Sent:
        value = (np.zeros(4000, np.int32), [], [boosting.Tree.root() for _ in range(3)], [[0]] * 3, [0, 1, 2], {0: 0})

    def moved(width):
        counts = np.full(10, width)
        rows = boosting.Rows.of(counts, np.tile(np.arange(width), 10), np.ones(10 * width, int), Sent.value[0])
        block = boosting._block(0, 10, [x.astype("<i4").tobytes() for x in (rows.row, rows.column, rows.bin, np.zeros(10))] + [np.zeros((10, 3)).tobytes()])
        return sum(len(x.as_buffer()) for b in boosting._state_batches(Sent, 3)(iter([block])) for c in b.columns[1:] for x in c)
    assert moved(4) == moved(4000) == 10 * (3 * (8 + 2) + 4)


def test_trees_without_rows(spark):
    empty = spark.createDataFrame([(0.0, Vectors.sparse(3, [], []))], ["label", "features"]).where("label > 0")
    assert boosting.fit(empty, 2, n_features=3).rounds == []


def test_models_beat_the_largest_class(spark):
    from vitrine.sources import views
    data = X.with_labels(views.listing_doc(spark, SF_SMALL))
    common = {"max_features": 2000, "ngram_range": (1, 1), "clean": {"lowercase": True}}
    cfgs = [X.ExperimentConfig("gbt", model="gbt", params={"n_estimators": 3, "max_depth": 3}, **common), X.ExperimentConfig("svm", model="svm", **common),
            X.ExperimentConfig("svm_balanced", model="svm", balanced=True, **common), X.ExperimentConfig("logreg_balanced", model="logreg", balanced=True, **common)]
    rows = X.run_all(spark, data, cfgs).collect()
    train = data.where("split = 'train'")
    largest = train.groupBy("label").count().agg(F.max("count")).first()[0] / train.count()
    assert all(0 <= r["f1_weighted"] <= 1 for r in rows)
    assert all(r["f1_train"] > largest for r in rows)


def test_naive_bayes_refuses_scaled_features(spark):
    from vitrine.sources import views
    data = X.with_labels(views.listing_doc(spark, SF_SMALL))
    with pytest.raises(ValueError, match="negative"):
        X.run_experiment(data, X.ExperimentConfig("nb", model="nb", use_features=True), 27)


def test_a_sweep_computes_each_text_once(spark):
    """Six configurations, two cleanings: texts, counts and vocabularies are shared."""
    from vitrine.sources import views
    data = X.with_labels(views.listing_doc(spark, SF_SMALL)).cache()
    cache = X.BlockCache(data)
    tables = {}
    for clean in ({}, {"lowercase": True}):
        for weight in (1.0, 2.0, 3.0):
            cfg = X.ExperimentConfig("w", clean=clean, title_weight=weight, max_features=50, ngram_range=(1, 1))
            tables[weight, bool(clean)] = X.feature_table(data, cfg, cache)
    assert [len(cache.keys(k)) for k in ("text", "counts", "vocabulary", "block")] == [2, 4, 4, 4]
    one, three = ({(r.row_id, r.idx): r.weight for r in tables[w, True].long.where("block = 'title'").collect()} for w in (1.0, 3.0))
    assert one.keys() == three.keys() and all(abs(three[k] - 3 * v) < 1e-12 for k, v in one.items())
    cache.release()


def test_three_splits_are_stratified(spark):
    from vitrine.sources import views
    data = X.three_way(views.listing_doc(spark, SF_SMALL))
    n = {r["split"]: r["count"] for r in data.groupBy("split").count().collect()}
    total = sum(n.values())
    assert set(n) == {"train", "val", "test"} and data.select("row_id").distinct().count() == total
    assert n["test"] == -(-15 * total // 100) and abs(n["val"] - 0.15 * total) <= 2


def test_version_configs_add_up():
    cfgs = {c.name: c for c in X.version_configs()}
    assert len(cfgs) == 13
    on = lambda n: {k for k, v in cfgs[n].clean.items() if v}
    assert on("v0_no_cleaning") == set() and on("v1_basic") < on("v2_structural") < on("v3_boilerplate")
    assert on("v4_no_digits") - on("v3_boilerplate") == {"remove_single_digit"} and on("v5_no_letters") - on("v3_boilerplate") == {"remove_single_letter"}
    assert mdl.build_model("svm", 10) is None


def test_classes_solved_in_groups_equal_all_together(sparse, monkeypatch):
    """No matrix that the driver sends or gets exceeds the group's numbers."""
    _, _, df = sparse
    blocks = linear.row_blocks(df, K)
    fits = lambda: [linear.fit_ridge(blocks, max_iter=2), linear.fit_svm(blocks, 0.3, max_newton=1, max_inner=2)]
    whole = fits()
    monkeypatch.setattr(linear, "GROUP_NUMBERS", D + 1)
    sent_widths = []
    totals = blocks.totals
    blocks.totals = lambda work, n, width, **sent: (sent_widths.extend(m.shape[1] for m in sent.values()), totals(work, n, width, **sent))[1]
    for want, got in zip(whole, fits(), strict=True):
        assert got.iterations == want.iterations and np.allclose(got.weights, want.weights, atol=1e-9) and np.allclose(got.intercepts, want.intercepts, atol=1e-9)
    assert set(sent_widths) == {1}


def test_products_hold_no_entries_times_classes():
    """A block of 200,000 entries and 400 classes: entries x classes doubles would be 640 MB."""
    import tracemalloc
    rng = np.random.default_rng(3)
    n, width, k = 500, 400, 400
    columns = np.concatenate([np.sort(rng.choice(3000, width, replace=False)) for _ in range(n - 1)])
    counts, values = np.append(np.full(n - 1, width), 0), rng.normal(size=len(columns))
    used, own = np.unique(columns, return_inverse=True)
    block = linear.Block(counts, own, values, used, np.argsort(own, kind="stable"), np.zeros(n))
    x = np.zeros((n, 3000))
    x[np.repeat(np.arange(n), counts), columns] = values
    m, r = rng.normal(size=(3000, k)), rng.normal(size=(n, k))
    tracemalloc.start()
    through, back = block.times(m), block.back(r)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(through, x @ m) and np.allclose(back, (x.T @ r)[used]) and np.allclose(block.back_squared(), (x ** 2).sum(0)[used])
    assert peak < 100e6


def test_predictions_are_scored_in_parts(sparse, monkeypatch):
    x, _, df = sparse
    monkeypatch.setattr(linear, "SCORE_ENTRIES", 40)
    rng = np.random.default_rng(5)
    model = linear.LinearModel(rng.normal(size=(D, K)), rng.normal(size=K))
    got = linear.predict(model, df).select("features", "prediction").collect()
    assert len(got) == N and all(r.prediction == (r.features.toArray() @ model.weights + model.intercepts).argmax() for r in got)


def test_logistic_regression_reaches_the_optimum(sparse):
    """Its value is at most Spark ML's at a hundredth of the tolerance and more, with and without class weights."""
    from pyspark.ml.classification import LogisticRegression
    x, y, df = sparse
    blocks = linear.row_blocks(df, K)
    for weights in (np.ones(K), np.array([1.0, 2.0, 0.5])):
        own = weights[y] / weights[y].sum()

        def value(w, b):
            s = x @ w + b
            s = s - s.max(axis=1, keepdims=True)
            return own @ (np.log(np.exp(s).sum(axis=1)) - s[np.arange(N), y]) + 0.02 / 2 * (w ** 2).sum()

        model = linear.fit_logistic(blocks, 0.02, tol=1e-6, class_weights=weights)
        weighted = df.withColumn("w", F.element_at(F.array(*map(F.lit, weights.tolist())), F.col("label").cast("int") + 1))
        ml = LogisticRegression(family="multinomial", regParam=0.02, standardization=False, maxIter=300, tol=1e-8, weightCol="w").fit(weighted)
        assert value(model.weights, model.intercepts) <= value(ml.coefficientMatrix.toArray().T, ml.interceptVector.toArray()) + 1e-5
        assert 0 < model.iterations <= 100 and model.passes > model.iterations


def test_a_sweep_fits_no_spark_logistic_regression(sparse, monkeypatch):
    from pyspark.ml import classification
    _, _, df = sparse
    monkeypatch.setattr(classification, "LogisticRegression", None)
    rows = df.withColumn("row_id", F.monotonically_increasing_id())
    res = mdl.train_and_evaluate("logreg", rows, rows, K, C=1.0, balanced=True)
    assert res["predictions"].where("y_true = y_pred").count() > 0.9 * N


def test_classes_solved_in_tasks_of_their_own(sparse, monkeypatch):
    """No job for a pass, and the models of all tasks together."""
    _, _, df = sparse
    blocks = linear.row_blocks(df, K)
    fits = lambda: [linear.fit_ridge(blocks, max_iter=3), *linear.svm_path(blocks, [0.03, 0.3], max_newton=1, max_inner=3)]
    want = fits()
    monkeypatch.setattr(linear, "TASK_NUMBERS", 1)
    blocks.totals = None
    for got, model in zip(fits(), want, strict=True):
        assert np.allclose(got.weights, model.weights, atol=1e-9) and np.allclose(got.intercepts, model.intercepts, atol=1e-9) and got.passes > 0


def test_large_sums_are_added_up_by_range(sparse, monkeypatch):
    x, y, df = sparse
    monkeypatch.setattr(linear, "GATHERED_NUMBERS", 1)
    monkeypatch.setattr(linear, "RANGE", 64)
    got, n = linear.row_blocks(df, K).totals(lambda b, s: (b.back(b.times(s["p"])), np.array([len(b.labels)])), 1, 2, p=np.ones((D, 2)))
    assert n[0] == N and np.allclose(got, x.T @ (x @ np.ones((D, 2))))
