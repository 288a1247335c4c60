"""What the configurations of a sweep share."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vitrine.operators import experiments as X


def test_a_sweep_keeps_no_long_table(spark, monkeypatch):
    """Terms are fitted once per text and cleaning; vectors of several models are built once."""
    from vitrine.operators import rowvec
    from vitrine.sources import views
    data = X.with_labels(views.listing_doc(spark, SF_SMALL))
    fits, built = [], []
    fit_block, row_vectors = rowvec.fit_block, rowvec.row_vectors
    monkeypatch.setattr(rowvec, "fit_block", lambda *a, **kw: (fits.append(a[1]), fit_block(*a, **kw))[1])
    monkeypatch.setattr(rowvec, "row_vectors", lambda *a, **kw: (built.append(1), row_vectors(*a, **kw))[1])
    monkeypatch.setattr(X, "BlockCache", None)
    cfgs = [X.ExperimentConfig(f"{n}_{m}", max_features=n, ngram_range=(1, 1), max_iter=3, model=m) for n in (40, 90) for m in ("logreg", "nb")]
    rows = {r["experiment"]: r for r in X.run_all(spark, data, cfgs).collect()}
    assert sorted(fits) == ["description", "title"] and len(built) == 2
    assert {n: r["n_features"] for n, r in rows.items()} == {"40_logreg": 80, "40_nb": 80, "90_logreg": 180, "90_nb": 180}


def test_fewer_terms_are_the_first_of_more(spark):
    from vitrine.operators import rowvec, vectorize as V
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["b a a c", "c b d d", "e a c b", "d e f"])], "row_id long, t string")
    fit = lambda n: rowvec.fit_block(docs, "t", F.col("t"), V.build_vectorizer("tfidf", analyzer="whitespace", ngram_range=(1, 1), min_df=1, max_df=1.0, max_features=n))
    for n in (1, 2, 3, 4, 5):
        got, want = rowvec.most_frequent(fit(6), n), fit(n)
        assert (got.terms, got.idf, got.totals) == (want.terms, want.idf, want.totals)


def test_texts_are_counted_once_for_weights_and_sizes(spark, monkeypatch):
    """Vectors from shared counts are those of each configuration alone."""
    from vitrine.operators import rowvec
    rows = [(i, float(i % 2), "val" if i % 5 == 0 else "train", t, d) for i, (t, d) in enumerate([("red car car", "fast red car"), ("blue car", None), ("red bus red", "slow bus bus"), (None, "blue bus fast"), ("", ""), ("blue red", "car red red bus")] * 3)]
    data = spark.createDataFrame(rows, "row_id long, label double, split string, designation string, description string").cache()
    counted = []
    count_columns = rowvec.count_columns
    monkeypatch.setattr(rowvec, "count_columns", lambda *a, **kw: (counted.append(1), count_columns(*a, **kw))[1])
    cfgs = [X.ExperimentConfig(f"{v}_{n}_{w}_{f}", vectorizer=v, max_features=n, title_weight=w, use_features=f) for v, n, w, f in (("tfidf", 3, 1.0, False), ("tfidf", 9, 2.0, True), ("count", 5, 1.0, False))]
    terms = X.TermCache(cfgs)
    counts = X.CountCache(data, cfgs, terms)
    for cfg in cfgs:
        shared, n = X.row_vectors(data, cfg, terms, counts), len(counted)
        assert n == 1  # that of the first configuration
        alone = X.row_vectors(data, cfg)
        counted.clear()
        counted.append(1)
        found, want = ({r.row_id: r.features for r in v.rows.collect()} for v in (shared, alone))
        assert len(found) == 18 and found.keys() == want.keys() and shared.names == alone.names
        for k, v in found.items():  # the scaler's sums are added in another order
            assert list(v.indices) == list(want[k].indices) and np.allclose(v.values, want[k].values, rtol=1e-12)
    assert not counts._kept


def test_feature_columns_are_computed_once_for_a_sweep(spark, monkeypatch):
    """Sets of feature columns without texts share one computation, and have the vectors of each alone."""
    rows = [(i, float(i % 2), "val" if i % 5 == 0 else "train", t, d) for i, (t, d) in enumerate([("red car 12", "fast red car 3 cm"), ("blue car", None), (None, "n° 5"), ("", "")] * 4)]
    data = spark.createDataFrame(rows, "row_id long, label double, split string, designation string, description string").cache()
    made = []
    feature_columns = X.feature_columns
    monkeypatch.setattr(X, "feature_columns", lambda *a, **kw: (made.append(1), feature_columns(*a, **kw))[1])
    cfgs = [X.ExperimentConfig(f"f{k}", strategy="features", feature_cols=cols) for k, cols in enumerate((X.UNITS, X.UNITS + X.LENGTHS, X.LENGTHS))]
    terms = X.TermCache(cfgs)
    counts = X.CountCache(data, cfgs, terms)
    shared = [X.row_vectors(data, cfg, terms, counts) for cfg in cfgs]
    assert len(made) == 1 and not counts._kept
    for cfg, got in zip(cfgs, shared, strict=True):
        want = {r.row_id: r.features.toArray() for r in X.row_vectors(data, cfg).rows.collect()}
        found = {r.row_id: r.features.toArray() for r in got.rows.collect()}
        assert found.keys() == want.keys() and all(np.allclose(v, want[k], rtol=1e-12, atol=1e-12) for k, v in found.items())
