"""Splits, training histories, joins / projections, experiment comparisons.

(MDL01, MDL02, MDL09, QC03, AGG14, WIN01-04, JON01, JON06, JON08, PRJ02,
PRJ03, PRJ05, PRJ09, PRJ10, SRC03, SRC04, SET01-03, AGG11, AGG12, ORD02,
EXP11-14)
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from vitrine.functions import fixed
from vitrine.operators import ensemble as ens
from vitrine.operators import evaluate as ev
from vitrine.operators import history as hist
from vitrine.operators import split as sp
from vitrine.plans import sqlkit as S
from vitrine.plans.q_eval import PRED_CTES, metrics_sql, MODELS
from vitrine.plans.registry import query
from vitrine.sources import views
from vitrine.sources.tables import table

R = 6
TEST_SIZE = 0.15
SEED = 42


def _key_sql(e: str, seed: int) -> str:
    return f"substr(md5(CAST({e} AS VARCHAR) || '_{seed}'), 1, 15)"


def _strat_ctes() -> list[str]:
    return [S.LISTING_DOC,
                    "cnt AS (SELECT prdtypecode, count(*) AS n FROM listing_doc GROUP BY prdtypecode)",
                    f"tot AS (SELECT sum(n) AS total, CAST(ceil(CAST({TEST_SIZE} AS DOUBLE) * sum(n)) AS BIGINT) AS n_test FROM cnt)",
                    "e AS (SELECT prdtypecode, n, n * n_test / total AS ex, n_test FROM cnt, tot)",
                    "b AS (SELECT prdtypecode, floor(ex) AS base, ex - floor(ex) AS frac, n_test FROM e)",
                    "l AS (SELECT n_test - sum(base) AS left_over FROM b GROUP BY n_test)",
                    "q AS (SELECT prdtypecode, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, prdtypecode) <= left_over "
                    "THEN 1 ELSE 0 END AS quota FROM b, l)",
                    f"r AS (SELECT row_id, prdtypecode, row_number() OVER (PARTITION BY prdtypecode ORDER BY "
                    f"{_key_sql('row_id', SEED)}, row_id) AS rn FROM listing_doc)"]


_STRAT_SELECT = ("SELECT r.row_id, r.prdtypecode, CASE WHEN rn <= quota THEN 'test' ELSE 'train' END AS split "
                 "FROM r JOIN q USING (prdtypecode)")


def _strat_sql() -> str:
    return S.with_(*_strat_ctes()) + _STRAT_SELECT


@query("stratified_holdout", ops=("MDL01", "SRC05"), sql=_strat_sql())
def stratified_holdout(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir).select("row_id", "prdtypecode")
    return sp.stratified_split(lst, "row_id", "prdtypecode", TEST_SIZE, SEED).select("row_id", "prdtypecode", "split")


def _balance_sql() -> str:
    return (S.with_(*_strat_ctes(), f"sp AS ({_STRAT_SELECT})",
                    "per AS (SELECT prdtypecode, sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS n_test, "
                    "sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS n_train FROM sp GROUP BY prdtypecode)")
            + "SELECT prdtypecode, CAST(n_test AS BIGINT) AS n_test, CAST(n_train AS BIGINT) AS n_train, "
              "CASE WHEN n_test = 0 AND n_train = 0 THEN 'test,train' WHEN n_test = 0 THEN 'test' "
              "WHEN n_train = 0 THEN 'train' END AS missing_in, (SELECT count(DISTINCT prdtypecode) FROM sp) AS num_classes FROM per")


@query("split_class_balance", ops=("MDL01", "QC03", "AGG14", "JON08"), sql=_balance_sql())
def split_class_balance(spark, sf_dir):
    """Rows per class and side, and the sides a class is missing in: all from
    one count per class."""
    s = stratified_holdout(spark, sf_dir)
    per = s.groupBy("prdtypecode").agg(F.sum((F.col("split") == "test").cast("long")).alias("n_test"),
                                       F.sum((F.col("split") == "train").cast("long")).alias("n_train"))
    sides = F.array(*[F.when(F.col(f"n_{x}") == 0, F.lit(x)) for x in ("test", "train")])
    missing = F.array_join(F.filter(sides, lambda x: x.isNotNull()), ",")
    classes = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))  # one row per class
    return per.select("prdtypecode", "n_test", "n_train", F.when(missing != "", missing).alias("missing_in"), classes.alias("num_classes"))


@query("random_holdout", ops=("MDL02",),
       sql=S.with_(S.LISTING_DOC) + "SELECT split, count(*) AS n FROM (SELECT CASE WHEN CAST(('0x' || "
       + _key_sql("row_id", SEED) + ") AS BIGINT) / CAST(16 ^ 15 AS DOUBLE) < 0.2 THEN 'test' ELSE 'train' END AS split "
       "FROM listing_doc) GROUP BY split")
def random_holdout(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir).select("row_id")
    return sp.random_split(lst, "row_id", 0.2, SEED).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("class_weights_balanced", ops=("MDL09",),
       sql=S.with_(S.LISTING_DOC) + f"SELECT prdtypecode, round(sum(n) OVER () / (count(*) OVER () * n), {R}) AS weight "
       "FROM (SELECT prdtypecode, count(*) AS n FROM listing_doc GROUP BY prdtypecode)")
def class_weights_balanced(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    return sp.balanced_weights(lst, "prdtypecode").select("prdtypecode", F.round("weight", R).alias("weight"))


# ---------------------------------------------------------------------------
# training histories
# ---------------------------------------------------------------------------

EPOCH_LOG_SQL = ("ev_b AS (SELECT min(value) AS lo, max(value) AS hi FROM events)",
                 "epoch_log AS (SELECT 'run_' || CAST(user_id AS VARCHAR) AS name, "
                 "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch, "
                 "(value - lo) / (hi - lo) AS val_f1, 1 - (value - lo) / (hi - lo) AS val_loss FROM events, ev_b)")


@query("best_epoch_per_run", ops=("WIN01",),
       sql=S.with_(*EPOCH_LOG_SQL) + f"SELECT name, epoch, round(val_f1, {R}) AS val_f1, round(val_loss, {R}) AS val_loss "
       "FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY val_f1 DESC, epoch) AS rk FROM epoch_log) WHERE rk = 1")
def best_epoch_per_run(spark, sf_dir):
    b = hist.best_epoch(views.epoch_log(spark, sf_dir))
    return b.select("name", "epoch", F.round("val_f1", R).alias("val_f1"), F.round("val_loss", R).alias("val_loss"))


@query("best_epoch_values", ops=("WIN01",),
       sql=S.with_(*EPOCH_LOG_SQL, "gaps AS (SELECT name, epoch, val_f1, CASE WHEN epoch % 3 <> 0 THEN val_loss END AS val_loss, CASE WHEN epoch % 5 = 0 THEN epoch * 10 END AS seconds FROM epoch_log)")
       + "SELECT name, " + ", ".join(f"{'round(' if c.startswith('val') else ''}first({c} ORDER BY val_f1 DESC, epoch) FILTER ({c} IS NOT NULL){f', {R})' if c.startswith('val') else ''} AS {c}"
                                     for c in ("epoch", "val_f1", "val_loss", "seconds")) + " FROM gaps GROUP BY name")
def best_epoch_values(spark, sf_dir):
    """Best epoch of a log with gaps: each column's first value that is there."""
    log = views.epoch_log(spark, sf_dir)
    gaps = log.select("name", "epoch", "val_f1", F.when(F.col("epoch") % 3 != 0, F.col("val_loss")).alias("val_loss"), F.when(F.col("epoch") % 5 == 0, F.col("epoch") * 10).alias("seconds"))
    b = hist.best_epoch_values(gaps)
    return b.select("name", "epoch", F.round("val_f1", R).alias("val_f1"), F.round("val_loss", R).alias("val_loss"), "seconds")


PATIENCE = 3


@query("early_stopping", ops=("WIN02",),
       sql=S.with_(*EPOCH_LOG_SQL,
                   "pm AS (SELECT *, max(val_f1) OVER (PARTITION BY name ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM epoch_log)",
                   "imp AS (SELECT name, epoch, val_f1, lead(epoch) OVER (PARTITION BY name ORDER BY epoch) AS nxt FROM pm WHERE prev IS NULL OR val_f1 > prev)",
                   "last AS (SELECT name, max(epoch) AS n_epochs FROM epoch_log GROUP BY name)")
       + f"SELECT name, CAST(min(CASE WHEN (nxt IS NULL OR nxt - epoch > {PATIENCE}) AND epoch + {PATIENCE} <= n_epochs "
         f"THEN epoch + {PATIENCE} END) AS BIGINT) AS stop_epoch, CAST(arg_max(epoch, val_f1) AS BIGINT) AS best_epoch, "
         f"round(max(val_f1), {R}) AS best_score, CAST(any_value(n_epochs) AS BIGINT) AS n_epochs FROM imp JOIN last USING (name) GROUP BY name")
def early_stopping(spark, sf_dir):
    out = hist.early_stop_epoch(views.epoch_log(spark, sf_dir), patience=PATIENCE)
    return out.select("name", "stop_epoch", "best_epoch", F.round("best_score", R).alias("best_score"), "n_epochs")


MIN_DELTA = 0.05


def _stop_sql(score: str, mode: str) -> str:
    """The rule step by step: one epoch of every run a recursion."""
    better = f"e.{score} > w.best + {MIN_DELTA}" if mode == "max" else f"e.{score} < w.best - {MIN_DELTA}"
    return (f"walk_{mode} AS (SELECT name, CAST(1 AS BIGINT) AS epoch, {score} AS best, CAST(1 AS BIGINT) AS best_epoch, CAST(NULL AS BIGINT) AS stop_epoch "
            f"FROM epoch_log WHERE epoch = 1 UNION ALL "
            f"SELECT w.name, e.epoch, CASE WHEN {better} THEN e.{score} ELSE w.best END, CASE WHEN {better} THEN e.epoch ELSE w.best_epoch END, "
            f"CASE WHEN NOT ({better}) AND e.epoch - w.best_epoch >= {PATIENCE} THEN e.epoch END "
            f"FROM walk_{mode} w JOIN epoch_log e ON e.name = w.name AND e.epoch = w.epoch + 1 WHERE w.stop_epoch IS NULL)")


@query("early_stopping_min_delta", ops=("WIN02",),
       sql="WITH RECURSIVE " + ", ".join([*EPOCH_LOG_SQL, _stop_sql("val_f1", "max"), _stop_sql("val_loss", "min"),
                                          "last AS (SELECT name, count(*) AS n_epochs FROM epoch_log GROUP BY name)"])
       + " " + " UNION ALL ".join(
           f"SELECT '{mode}' AS mode, name, max(stop_epoch) AS stop_epoch, CAST(arg_max(best_epoch, epoch) AS BIGINT) AS best_epoch, "
           f"round(arg_max(best, epoch), {R}) AS best_score, any_value(n_epochs) AS n_epochs FROM walk_{mode} JOIN last USING (name) GROUP BY name" for mode in ("max", "min")))
def early_stopping_min_delta(spark, sf_dir):
    """Early stopping by validation F1 (mode max) and loss (mode min), with a
    least improvement."""
    from vitrine.operators.stopping import early_stop_min_delta
    log = views.epoch_log(spark, sf_dir).cache()
    parts = [early_stop_min_delta(log, PATIENCE, MIN_DELTA, score=score, mode=mode).withColumn("mode", F.lit(mode)) for score, mode in (("val_f1", "max"), ("val_loss", "min"))]
    both = parts[0].unionByName(parts[1])
    return both.select("mode", "name", "stop_epoch", "best_epoch", F.round("best_score", R).alias("best_score"), "n_epochs")


# ---------------------------------------------------------------------------
# joins and projections on listings
# ---------------------------------------------------------------------------

@query("listing_label_join", ops=("JON01", "PRJ05", "PRJ04"),
       sql=S.with_(S.LISTING_DOC) + "SELECT l.row_id, l.category, y.quality, y.toxic, "
       "NOT (coalesce(y.toxic = 1, false) OR coalesce(y.quality = 0, false)) AS keep "
       "FROM listing_doc l JOIN labels y ON l.row_id = y.doc_id")
def listing_label_join(spark, sf_dir):
    x = views.listing_doc(spark, sf_dir).select("row_id", "category")
    y = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "row_id")
    j = x.join(y, "row_id", "inner")
    tags = [(F.col("toxic") == 1), (F.col("quality") == 0)]
    keep = ~(F.coalesce(tags[0], F.lit(False)) | F.coalesce(tags[1], F.lit(False)))
    return j.select("row_id", "category", "quality", "toxic", keep.alias("keep"))


@query("tag_mask_filter", ops=("PRJ05",),
       sql=S.with_(S.LISTING_DOC) + "SELECT l.row_id, l.designation FROM listing_doc l LEFT JOIN labels y ON l.row_id = y.doc_id "
       "WHERE NOT (coalesce(y.toxic = 1, false) OR coalesce(y.quality = 0, false))")
def tag_mask_filter(spark, sf_dir):
    from functools import reduce
    x = views.listing_doc(spark, sf_dir).select("row_id", "designation")
    t = views.tags(spark, sf_dir)
    j = x.join(t, "row_id", "left")
    drop = reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(False)) for c in ("is_toxic", "is_low_quality")])
    return j.filter(~drop).select("row_id", "designation")


@query("merged_text_fallback", ops=("PRJ01", "PRJ02", "PRJ03", "CLN17"),
       sql=S.with_(S.LISTING_DOC) + "SELECT row_id, coalesce(designation, '') || ' [SEP] ' || coalesce(description, '') AS merged_sep, "
       "CASE WHEN length(trim(trim(coalesce(designation, '')) || ' ' || trim(coalesce(description, '')))) > 0 "
       "THEN trim(trim(coalesce(designation, '')) || ' ' || trim(coalesce(description, ''))) ELSE '[EMPTY]' END AS text_model, "
       "coalesce(description, '') AS description_filled FROM listing_doc")
def merged_text_fallback(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    d, s = F.coalesce("designation", F.lit("")), F.coalesce("description", F.lit(""))
    both = F.trim(F.concat(F.trim(d), F.lit(" "), F.trim(s)))
    return lst.select("row_id", F.concat(d, F.lit(" [SEP] "), s).alias("merged_sep"),
                      F.when(F.length(both) > 0, both).otherwise(F.lit("[EMPTY]")).alias("text_model"),
                      s.alias("description_filled"))


@query("seeded_sample", ops=("PRJ09",),
       sql=S.with_(S.LISTING_DOC) + "SELECT row_id, designation FROM listing_doc ORDER BY md5(CAST(row_id AS VARCHAR) || '_42'), row_id LIMIT 5")
def seeded_sample(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    key = F.md5(F.concat(F.col("row_id").cast("string"), F.lit("_42")))
    return lst.orderBy(key, "row_id").limit(5).select("row_id", "designation")


@query("label_encoding", ops=("JON06", "PRJ10", "SRC10"),
       sql=S.with_(S.LISTING_DOC, S.category_dim_sql()) + "SELECT l.row_id, l.prdtypecode, d.class_idx, d2.code AS decoded, "
       "d.code IS NOT NULL AS is_valid FROM listing_doc l LEFT JOIN category_dim d ON l.prdtypecode = d.code "
       "LEFT JOIN category_dim d2 ON d.class_idx = d2.class_idx")
def label_encoding(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir).select("row_id", "prdtypecode")
    dim = F.broadcast(views.category_dim(spark).select(F.col("code").alias("prdtypecode"), "class_idx"))
    enc = lst.join(dim, "prdtypecode", "left")
    dec = F.broadcast(views.category_dim(spark).select("class_idx", F.col("code").alias("decoded")))
    return enc.join(dec, "class_idx", "left").select(
        "row_id", "prdtypecode", "class_idx", "decoded", F.col("prdtypecode").isin(fixed.CANONICAL_CLASSES).alias("is_valid"))


@query("image_paths", ops=("SRC03", "SRC04"),
       sql=S.with_(S.LISTING_DOC) + "SELECT row_id, path, CAST(regexp_extract(path, 'image_(\\d+)_product_(\\d+)\\.jpg$', 1) AS BIGINT) AS imageid_parsed, "
       "CAST(regexp_extract(path, 'image_(\\d+)_product_(\\d+)\\.jpg$', 2) AS BIGINT) AS productid_parsed FROM "
       "(SELECT row_id, 'images/image_' || CAST(imageid AS VARCHAR) || '_product_' || CAST(productid AS VARCHAR) || '.jpg' AS path FROM listing_doc)")
def image_paths(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    path = F.format_string("images/image_%d_product_%d.jpg", F.col("imageid"), F.col("productid"))
    files = lst.select("row_id", path.alias("path"))
    pat = r"image_(\d+)_product_(\d+)\.jpg$"
    return files.select("row_id", "path", F.regexp_extract("path", pat, 1).cast("bigint").alias("imageid_parsed"),
                        F.regexp_extract("path", pat, 2).cast("bigint").alias("productid_parsed"))


# ---------------------------------------------------------------------------
# experiment results derived from the data: fusion methods scored on val
# ---------------------------------------------------------------------------

FUSION = {
    "single_model_a": ("single", None), "single_model_b": ("single", None), "single_model_c": ("single", None),
    "simple_average": ("average", None), "weighted_average": ("average", None),
    "geometric_mean": ("mean", None), "harmonic_mean": ("mean", None), "voting": ("vote", None),
}
BASELINE = "single_model_a"


def fusion_experiments(spark, sf_dir):
    """(experiment, grp, accuracy, f1_weighted) — one scan of the gathered predictions."""
    p = views.predictions(spark, sf_dir).filter(F.col("split") == "val")
    g = ens.gather(p, MODELS)
    bym = F.col("by_model")
    pa, pb, pc = [F.element_at(bym, F.lit(m)) for m in MODELS]
    methods = {"single_model_a": pa, "single_model_b": pb, "single_model_c": pc,
               "simple_average": ens.weighted_average(bym, ["model_a", "model_b"]),
               "weighted_average": ens.weighted_average(bym, ["model_a", "model_b"], [1.0, 3.0]),
               "geometric_mean": ens.geometric(pa, pb), "harmonic_mean": ens.harmonic(pa, pb),
               "voting": ens.voting(bym, MODELS, F.size("classes"))}
    x = g.select("y_true", "classes", F.explode(F.array(*[F.struct(F.lit(k).alias("experiment"), e.alias("p"))
                                                         for k, e in methods.items()])).alias("m"))
    scored = x.select(F.col("m.experiment").alias("experiment"), "y_true",
                      ev.predicted_class(F.col("m.p"), F.col("classes")).alias("y_pred"))
    m = ev.metrics(ev.confusion(scored, ["experiment"]), ["experiment"])
    grp = F.lit(None).cast("string")
    for k, (gname, _) in FUSION.items():
        grp = F.when(F.col("experiment") == k, F.lit(gname)).otherwise(grp)
    return m.select("experiment", grp.alias("grp"), "accuracy", "f1_weighted")


def _fusion_sql_ctes() -> list[str]:
    methods = {
        "single_model_a": "pa", "single_model_b": "pb", "single_model_c": "pc",
        "simple_average": "list_transform(list_zip(pa, pb), lambda t: (t[1] + t[2]) / 2)",
        "weighted_average": "list_transform(list_zip(pa, pb), lambda t: 0.25 * t[1] + 0.75 * t[2])",
        "geometric_mean": "list_transform(list_zip(pa, pb), lambda t: sqrt(t[1] * t[2]))",
        "harmonic_mean": "list_transform(list_zip(pa, pb), lambda t: 2 / (1 / (t[1] + 1e-10) + 1 / (t[2] + 1e-10)))",
        "voting": "list_transform(range(0, len(pa)), lambda c: ((list_position(pa, list_max(pa)) - 1 = c)::INT + "
                  "(list_position(pb, list_max(pb)) - 1 = c)::INT + (list_position(pc, list_max(pc)) - 1 = c)::INT) / 3.0)",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{k}' AS experiment, y_true, classes[list_position({e}, list_max({e}))] AS y_pred FROM fg"
        for k, e in methods.items())
    grp = "CASE " + " ".join(f"WHEN experiment = '{k}' THEN '{g}'" for k, (g, _) in FUSION.items()) + " END"
    return [*PRED_CTES,
            "fg AS (SELECT idx, any_value(y_true) AS y_true, any_value(classes) AS classes, "
            "max(CASE WHEN model = 'model_a' THEN probs END) AS pa, max(CASE WHEN model = 'model_b' THEN probs END) AS pb, "
            "max(CASE WHEN model = 'model_c' THEN probs END) AS pc FROM predictions WHERE split = 'val' GROUP BY idx)",
            f"ff AS ({rows})", *metrics_sql("ff", ["experiment"], prefix="fx"),
            f"results AS (SELECT experiment, {grp} AS grp, accuracy, f1_weighted FROM fx_metrics)"]


@query("experiment_deltas", ops=("WIN03", "EXP11", "SET01"),
       sql=S.with_(*_fusion_sql_ctes(), f"b AS (SELECT f1_weighted AS base FROM results WHERE experiment = '{BASELINE}')")
       + f"SELECT experiment, grp, round(f1_weighted, {R}) AS f1_weighted, round(accuracy, {R}) AS accuracy, "
         f"round(f1_weighted - base, {R}) AS delta_f1, round((f1_weighted - base) / base * 100, {R}) AS delta_pct FROM results, b")
def experiment_deltas(spark, sf_dir):
    res = fusion_experiments(spark, sf_dir)
    d = hist.delta_vs_baseline(res, BASELINE)
    return d.select("experiment", "grp", *[F.round(c, R).alias(c) for c in ("f1_weighted", "accuracy", "delta_f1", "delta_pct")])


@query("experiment_group_stats", ops=("AGG11", "AGG12", "EXP11"),
       sql=S.with_(*_fusion_sql_ctes(), f"b AS (SELECT f1_weighted AS base FROM results WHERE experiment = '{BASELINE}')")
       + f"SELECT grp, round(avg(f1_weighted - base), {R}) AS mean, round(max(f1_weighted - base), {R}) AS max, "
         f"round(min(f1_weighted - base), {R}) AS min, count(*) AS count FROM results, b GROUP BY grp")
def experiment_group_stats(spark, sf_dir):
    d = hist.delta_vs_baseline(fusion_experiments(spark, sf_dir), BASELINE)
    st = hist.group_stats(d, "grp", "delta_f1")
    return st.select("grp", *[F.round(c, R).alias(c) for c in ("mean", "max", "min")], "count")


@query("experiment_extremes", ops=("ORD02", "EXP11"),
       sql=S.with_(*_fusion_sql_ctes(), f"b AS (SELECT f1_weighted AS base FROM results WHERE experiment = '{BASELINE}')",
                   f"d AS (SELECT experiment, f1_weighted - base AS delta_f1 FROM results, b WHERE experiment <> '{BASELINE}')")
       + f"(SELECT experiment, round(delta_f1, {R}) AS delta_f1, 'largest' AS side FROM d ORDER BY round(d.delta_f1, 12) DESC, experiment LIMIT 3) "
         f"UNION ALL (SELECT experiment, round(delta_f1, {R}), 'smallest' FROM d ORDER BY round(d.delta_f1, 12), experiment LIMIT 3)")
def experiment_extremes(spark, sf_dir):
    d = hist.delta_vs_baseline(fusion_experiments(spark, sf_dir), BASELINE)
    e = hist.extremes(d, "delta_f1", 3, exclude=BASELINE)
    return e.select("experiment", F.round("delta_f1", R).alias("delta_f1"), "side")


STEPS = [("v0", "single_model_a", "single_model_a"), ("v1", "single_model_b", "single_model_a"),
         ("v2", "simple_average", "single_model_b"), ("v3", "weighted_average", "simple_average"),
         ("v4", "geometric_mean", "weighted_average"), ("v5", "harmonic_mean", "weighted_average")]


@query("experiment_steps", ops=("WIN04",),
       sql=S.with_(*_fusion_sql_ctes(), "st AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in STEPS)
                   + ") t(step, experiment, reference))")
       + f"SELECT st.step, st.experiment, st.reference, round(c.f1_weighted, {R}) AS score, round(r.f1_weighted, {R}) AS ref_score, "
         f"round(c.f1_weighted - r.f1_weighted, {R}) AS diff, CASE WHEN c.f1_weighted - r.f1_weighted > 1e-4 THEN 'improved' "
         "WHEN c.f1_weighted - r.f1_weighted < -1e-4 THEN 'degraded' ELSE 'neutral' END AS verdict "
         "FROM st LEFT JOIN results c ON st.experiment = c.experiment LEFT JOIN results r ON st.reference = r.experiment")
def experiment_steps(spark, sf_dir):
    res = fusion_experiments(spark, sf_dir)
    out = hist.step_comparison(res, STEPS)
    return out.select("step", "experiment", "reference", *[F.round(c, R).alias(c) for c in ("score", "ref_score", "diff")], "verdict")


@query("score_tracking", ops=("SET01", "EXP12", "EXP13"),
       sql=S.with_(*_fusion_sql_ctes(), *metrics_sql("pr", ["model", "split"], prefix="mm"))
       + f"SELECT * FROM (SELECT experiment, grp AS strategy, NULL AS split, round(f1_weighted, {R}) AS f1_score, "
         f"round(accuracy, {R}) AS accuracy FROM results UNION ALL BY NAME SELECT model AS experiment, split, "
         f"round(f1_weighted, {R}) AS f1_score, round(accuracy, {R}) AS accuracy FROM mm_metrics)")
def score_tracking(spark, sf_dir):
    res = fusion_experiments(spark, sf_dir).select("experiment", F.col("grp").alias("strategy"),
                                                    F.round("f1_weighted", R).alias("f1_score"), F.round("accuracy", R).alias("accuracy"))
    p = views.predictions(spark, sf_dir)
    s = p.select("model", "split", "y_true", ev.predicted_class(F.col("probs"), F.col("classes")).alias("y_pred"))
    mm = ev.metrics(ev.confusion(s, ["model", "split"]), ["model", "split"]).select(
        F.col("model").alias("experiment"), "split", F.round("f1_weighted", R).alias("f1_score"), F.round("accuracy", R).alias("accuracy"))
    return res.unionByName(mm, allowMissingColumns=True).orderBy(F.desc("f1_score"))


FINDINGS = [("fusion_vs_single", "single_model_a", "simple_average"),
            ("weighted_vs_simple", "simple_average", "weighted_average"),
            ("geometric_vs_simple", "simple_average", "geometric_mean"),
            ("voting_vs_single", "single_model_a", "voting")]


@query("experiment_report", ops=("EXP12", "EXP13"),
       sql=S.with_(*_fusion_sql_ctes(), "f AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in FINDINGS)
                   + ") t(finding, from_exp, to_exp))",
                   "best AS (SELECT max(f1_weighted) AS best FROM results)",
                   "bw AS (SELECT f1_weighted AS w FROM results WHERE experiment = 'weighted_average')")
       + f"SELECT f.finding, f.from_exp, f.to_exp, round(a.f1_weighted, {R}) AS from_score, round(b.f1_weighted, {R}) AS to_score, "
         f"round((b.f1_weighted - a.f1_weighted) / a.f1_weighted * 100, {R}) AS improvement_pct, "
         "(SELECT abs(best - w) <= 1e-4 FROM best, bw) AS weighted_is_best "
         "FROM f LEFT JOIN results a ON f.from_exp = a.experiment LEFT JOIN results b ON f.to_exp = b.experiment")
def experiment_report(spark, sf_dir):
    res = fusion_experiments(spark, sf_dir)
    exported = res.filter(F.col("experiment") == "weighted_average").first()["f1_weighted"]
    ok = hist.verify_best(res, exported)
    rep = hist.improvement_report(res, FINDINGS)
    return rep.select("finding", "from_exp", "to_exp", *[F.round(c, R).alias(c) for c in ("from_score", "to_score", "improvement_pct")],
                      F.lit(ok).alias("weighted_is_best"))


@query("run_score_histogram", ops=("AGG15", "EXP12"),
       sql=S.with_(*EPOCH_LOG_SQL, "b AS (SELECT min(val_f1) AS lo, max(val_f1) AS hi FROM epoch_log)")
       + "SELECT CAST(CASE WHEN b.hi = b.lo THEN 0 ELSE least(floor((val_f1 - b.lo) / ((b.hi - b.lo) / 20)), 19) END AS INTEGER) AS bin, "
         "count(*) AS count FROM epoch_log, b GROUP BY ALL")
def run_score_histogram(spark, sf_dir):
    """Scores of all runs in 20 equal bins."""
    from vitrine.operators.eda import histogram
    return histogram(views.epoch_log(spark, sf_dir), "val_f1", 20).select("bin", "count")
