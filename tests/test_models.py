"""Model fitting helpers: ridge against the closed form, absent classes,
aligned fusion, experiment rows."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from vitrine.operators import ensemble as ens
from vitrine.operators import experiments as X
from vitrine.operators import linear
from vitrine.operators import models as mdl
from vitrine.operators import vectorize as V


def points(spark, n=200, classes=(0, 3, 5)):
    rng = np.random.default_rng(0)
    centres = {c: rng.normal(size=4) * 4 for c in classes}
    rows = [(i, float(c), Vectors.dense(centres[c] + rng.normal(size=4))) for i in range(n) for c in [classes[i % len(classes)]]]
    return rows, spark.createDataFrame(rows, ["row_id", "label", "features"]).repartition(5)


def test_ridge_equals_the_closed_form(spark):
    rows, _ = points(spark)
    x = np.array([r[2].toArray() for r in rows])
    dense = {0.0: 0, 3.0: 1, 5.0: 2}
    y = np.array([[1.0 if dense[r[1]] == k else -1.0 for k in range(3)] for r in rows])
    df = spark.createDataFrame([(i, float(dense[c]), v) for i, c, v in rows], ["row_id", "label", "features"]).repartition(5)
    model = linear.fit_ridge(linear.row_blocks(df, 3), alpha=2.0)
    xc, yc = x - x.mean(0), y - y.mean(0)
    want = np.linalg.solve(xc.T @ xc + 2.0 * np.eye(4), xc.T @ yc)
    assert np.allclose(model.weights, want, atol=1e-6) and np.allclose(model.intercepts, y.mean(0) - x.mean(0) @ want, atol=1e-6)


@pytest.mark.parametrize("name", ["ridge", "logreg", "svm"])
def test_absent_classes_are_left_out(spark, name):
    _, df = points(spark)
    res = mdl.train_and_evaluate(name, df, df, 27)
    got = res["predictions"].agg(F.avg((F.col("y_true") == F.col("y_pred")).cast("double")), F.collect_set("y_pred")).first()
    assert got[0] > 0.95 and set(got[1]) <= {0, 3, 5}


def test_fusion_raises_on_misaligned_models(spark):
    rows = [("a", "val", 1, [0.1, 0.9], 1, [7, 8]), ("b", "val", 1, [0.2, 0.8], 1, [7, 8]), ("a", "val", 2, [0.1, 0.9], 1, [7, 8])]
    df = spark.createDataFrame(rows, "model string, split string, idx long, probs array<double>, y_true int, classes array<int>")
    assert ens.gather(df.where("idx = 1"), ["a", "b"]).count() == 1
    with pytest.raises(Exception, match="not aligned"):
        ens.gather(df, ["a", "b"]).collect()


def test_vectors_keep_every_document(spark):
    long = spark.createDataFrame([(1, 3, 0.5), (1, 0, 2.0)], "row_id long, idx int, weight double")
    base = spark.createDataFrame([(1,), (2,)], "row_id long")
    got = {r.row_id: r.features for r in V.to_vectors(long, "row_id", 5, base=base).collect()}
    assert got[1] == Vectors.sparse(5, [0, 3], [2.0, 0.5]) and got[2] == Vectors.sparse(5, [], [])
    plan = V.to_vectors(long, "row_id", 5)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_strategies_give_metrics_in_range(spark):
    from vitrine.sources import views
    data = X.with_labels(views.listing_doc(spark, SF_SMALL))
    cfgs = [X.ExperimentConfig(s, strategy=s, max_features=50, max_iter=5) for s in ("split", "merged", "features")]
    rows = X.run_all(spark, data, cfgs).collect()
    assert [r["experiment"] for r in rows] == ["split", "merged", "features"]
    assert all(0 <= r["f1_weighted"] <= 1 and 0 <= r["accuracy"] <= 1 and r["n_features"] > 0 for r in rows)


def test_sweep_lists_every_configuration():
    names = [c.name for c in X.cleaning_configs()]
    assert len(names) == len(set(names)) == 24 and names[0] == "baseline_raw"


def test_importance_names_terms_and_averages_zeros(spark):
    rows = E.queries()["coefficient_importance"](spark, SF_SMALL).collect()
    top = [r for r in rows if r["rank"] is not None]
    assert top and all(r["term"] for r in top) and {r["block"] for r in rows} == {"title", "description"}
    largest = {}
    for r in top:
        largest[r["class_idx"]] = max(largest.get(r["class_idx"], 0), abs(r["weight"]))
    assert all(r["mean_abs"] <= largest[r["class_idx"]] + 1e-12 for r in rows if r["rank"] is None)


def test_a_cluster_needs_a_shared_folder():
    from vitrine.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"getCheckpointDir": lambda self: None})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
