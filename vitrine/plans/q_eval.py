"""Evaluation, ensembling and contract queries over the predictions view
(EVA01-12, ENS01-09, QC01-04, MDL12, JON05-08, ORD01-04, AGG15)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from vitrine.functions import fixed
from vitrine.operators import ensemble as ens
from vitrine.operators import evaluate as ev
from vitrine.operators import quality as qc
from vitrine.operators.ranking import top_k_per_group
from vitrine.plans import sqlkit as S
from vitrine.plans.registry import query
from vitrine.sources import views

R = 6
MODELS = list(views.MODEL_SLICES)

# ---------------------------------------------------------------------------
# SQL restatement of the predictions view
# ---------------------------------------------------------------------------

_MODELS_SQL = ", ".join(f"('{m}', {lo}, {hi})" for m, (lo, hi) in views.MODEL_SLICES.items())
PRED_CTES = [
    "emb_x AS (SELECT vec_id, label, CAST(f AS DOUBLE) AS f, d FROM (SELECT vec_id, label, "
    "unnest(embedding) AS f, unnest(range(1, len(embedding) + 1)) AS d FROM embeddings))",
    "cent AS (SELECT label AS c_label, d, avg(f) AS m FROM emb_x GROUP BY label, d)",
    f"mdl AS (SELECT * FROM (VALUES {_MODELS_SQL}) t(model, lo, hi))",
    "dist AS (SELECT m.model, e.vec_id, e.label, c.c_label, sqrt(sum((e.f - c.m) * (e.f - c.m))) AS dist "
    "FROM emb_x e JOIN cent c ON e.d = c.d JOIN mdl m ON e.d BETWEEN m.lo AND m.hi "
    "GROUP BY m.model, e.vec_id, e.label, c.c_label)",
    "sc AS (SELECT *, 1.0 / (1.0 + dist) AS s FROM dist)",
    "predictions AS (SELECT model, CASE WHEN vec_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, vec_id AS idx, "
    "list(s / tot ORDER BY c_label) AS probs, CAST(label AS INTEGER) AS y_true, "
    "(SELECT list(DISTINCT label ORDER BY label) FROM embeddings) AS classes "
    "FROM (SELECT *, sum(s) OVER (PARTITION BY model, vec_id) AS tot FROM sc) GROUP BY model, vec_id, label)",
    "pr AS (SELECT *, list_position(probs, list_max(probs)) - 1 AS pred_idx, "
    "classes[list_position(probs, list_max(probs))] AS y_pred, list_max(probs) AS max_prob FROM predictions)",
]


def metrics_sql(src: str, group: list[str], prefix: str = "m") -> list[str]:
    """CTEs ending in {prefix}_per (per label) and {prefix}_metrics (per group)."""
    g = ", ".join(group)
    gc = (g + ", ") if group else ""
    using = ", ".join(group + ["label"])
    return [
        f"{prefix}_cm AS (SELECT {gc}y_true, y_pred, count(*) AS n FROM {src} GROUP BY ALL)",
        f"{prefix}_tp AS (SELECT {gc}y_true AS label, sum(n) AS tp FROM {prefix}_cm WHERE y_true = y_pred GROUP BY ALL)",
        f"{prefix}_sup AS (SELECT {gc}y_true AS label, sum(n) AS support FROM {prefix}_cm GROUP BY ALL)",
        f"{prefix}_prd AS (SELECT {gc}y_pred AS label, sum(n) AS predicted FROM {prefix}_cm GROUP BY ALL)",
        f"{prefix}_st AS (SELECT {using}, coalesce(tp, 0) AS tp, coalesce(support, 0) AS support, "
        f"coalesce(predicted, 0) AS predicted FROM ({prefix}_sup FULL JOIN {prefix}_prd USING ({using})) "
        f"LEFT JOIN {prefix}_tp USING ({using}))",
        f"{prefix}_per AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) "
        f"ELSE 0.0 END AS f1 FROM (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision, "
        f"CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM {prefix}_st))",
        f"{prefix}_metrics AS (SELECT {gc}sum(tp) / sum(support) AS accuracy, avg(f1) AS f1_macro, "
        f"sum(f1 * support) / sum(support) AS f1_weighted, avg(precision) AS precision_macro, "
        f"avg(recall) AS recall_macro FROM {prefix}_per GROUP BY ALL)",
    ]


def _rnd(cols):
    return [F.round(c, R).alias(c) for c in cols]


METRIC_COLS = ["accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro"]


def _scored(spark, sf_dir):
    p = views.predictions(spark, sf_dir)
    return p.select("*", ev.predicted_class(F.col("probs"), F.col("classes")).alias("y_pred"),
                    ev.argmax(F.col("probs")).alias("pred_idx"), F.array_max("probs").alias("max_prob"))


# ---------------------------------------------------------------------------

@query("predictions_scored", ops=("MDL12", "JON07", "SRC06"),
       sql=S.with_(*PRED_CTES) + f"SELECT model, split, idx, y_true, y_pred, pred_idx, round(max_prob, {R}) AS max_prob, "
       f"list_transform(probs, lambda p: round(p, {R})) AS probs FROM pr")
def predictions_scored(spark, sf_dir):
    s = _scored(spark, sf_dir)
    canon = ens.reorder_to_canonical(F.col("probs"), F.col("classes"), sorted_labels(s))
    return s.select("model", "split", "idx", "y_true", "y_pred", "pred_idx", F.round("max_prob", R).alias("max_prob"),
                    F.transform(canon, lambda p: F.round(p, R)).alias("probs"))


def sorted_labels(df):
    """The class list of a prediction set (bounded: one array)."""
    return list(df.select("classes").first()["classes"])


@query("model_metrics", ops=("EVA01", "EVA06", "EVA07", "ORD01", "ENS09"),
       sql=S.with_(*PRED_CTES, *metrics_sql("pr", ["model", "split"]))
       + "SELECT model, split, " + ", ".join(f"round({c}, {R}) AS {c}" for c in METRIC_COLS)
       + ", CASE " + " ".join(f"WHEN lower(model) LIKE '%{p}%' THEN {i}" for i, p in enumerate(fixed.MODEL_ORDER))
       + f" ELSE {len(fixed.MODEL_ORDER)} END AS order_key, CASE WHEN "
       + " OR ".join(f"lower(model) LIKE '%{k}%'" for k in fixed.TEXT_MODEL_KEYWORDS)
       + " THEN 'text' ELSE 'image' END AS family FROM m_metrics")
def model_metrics(spark, sf_dir):
    s = _scored(spark, sf_dir)
    m = ev.metrics(ev.confusion(s, ["model", "split"]), ["model", "split"])
    return m.select("model", "split", *_rnd(METRIC_COLS), ens.model_order_key(F.col("model")).alias("order_key"),
                    ens.categorize(F.col("model")).alias("family")).orderBy("order_key", F.desc("accuracy"))


@query("per_class_report", ops=("EVA02", "EVA04", "SET03"),
       sql=S.with_(*PRED_CTES, "v AS (SELECT * FROM pr WHERE split = 'val')", *metrics_sql("v", ["model"]),
                   "lab AS (SELECT DISTINCT label FROM embeddings)",
                   "full_st AS (SELECT g.model, lab.label, coalesce(p.precision, 0.0) AS precision, "
                   "coalesce(p.recall, 0.0) AS recall, coalesce(p.f1, 0.0) AS f1, coalesce(p.support, 0) AS support "
                   "FROM (SELECT DISTINCT model FROM v) g CROSS JOIN lab LEFT JOIN m_per p ON p.model = g.model AND p.label = lab.label)")
       + f"SELECT model, CAST(label AS VARCHAR) AS row, round(precision, {R}) AS precision, round(recall, {R}) AS recall, "
         f"round(f1, {R}) AS f1, CAST(support AS BIGINT) AS support FROM full_st UNION ALL "
         f"SELECT model, 'macro avg', round(avg(precision), {R}), round(avg(recall), {R}), round(avg(f1), {R}), "
         f"CAST(sum(support) AS BIGINT) FROM full_st GROUP BY model UNION ALL "
         f"SELECT model, 'weighted avg', round(sum(precision * support) / sum(support), {R}), "
         f"round(sum(recall * support) / sum(support), {R}), round(sum(f1 * support) / sum(support), {R}), "
         f"CAST(sum(support) AS BIGINT) FROM full_st GROUP BY model")
def per_class_report(spark, sf_dir):
    s = _scored(spark, sf_dir).filter(F.col("split") == "val")
    labels = sorted_labels(s)
    rep = ev.report(ev.confusion(s, ["model"]), ["model"], labels)
    return rep.select("model", "row", *_rnd(["precision", "recall", "f1"]), "support")


@query("confusion_normalized", ops=("EVA03",),
       sql=S.with_(*PRED_CTES) + f"SELECT model, split, y_true, y_pred, n, round(n / sum(n) OVER (PARTITION BY model, split, y_true), {R}) "
       "AS rate FROM (SELECT model, split, y_true, y_pred, count(*) AS n FROM pr GROUP BY ALL)")
def confusion_normalized(spark, sf_dir):
    s = _scored(spark, sf_dir)
    cm = ev.normalized_confusion(ev.confusion(s, ["model", "split"]), ["model", "split"])
    return cm.select("model", "split", "y_true", "y_pred", "n", F.round("rate", R).alias("rate"))


@query("error_report", ops=("EVA05", "EVA12", "ORD04"),
       sql=S.with_(*PRED_CTES, "v AS (SELECT * FROM pr WHERE split = 'val')", *metrics_sql("v", ["model"]),
                   "wc AS (SELECT model, 'class' AS kind, label AS y_true, label AS y_pred, f1 AS score, "
                   "row_number() OVER (PARTITION BY model ORDER BY f1, label) AS rank FROM m_per)",
                   "nc AS (SELECT model, y_true, y_pred, n / sum(n) OVER (PARTITION BY model, y_true) AS rate FROM m_cm)",
                   "wf AS (SELECT model, 'confusion' AS kind, y_true, y_pred, round(rate * 100, 1) AS score, "
                   "row_number() OVER (PARTITION BY model ORDER BY rate DESC, y_true, y_pred) AS rank FROM nc WHERE y_true <> y_pred)")
       + f"SELECT model, kind, y_true, y_pred, round(score, {R}) AS score, rank FROM wc WHERE rank <= 3 "
         f"UNION ALL SELECT model, kind, y_true, y_pred, score, rank FROM wf WHERE rank <= 5")
def error_report(spark, sf_dir):
    s = _scored(spark, sf_dir).filter(F.col("split") == "val")
    cm = ev.confusion(s, ["model"])
    wc = ev.worst_classes(ev.per_label_stats(cm, ["model"]), ["model"], 3).select(
        "model", F.lit("class").alias("kind"), F.col("label").alias("y_true"), F.col("label").alias("y_pred"),
        F.round("f1", R).alias("score"), "rank")
    wf = ev.worst_confusions(cm, ["model"], 5).select(
        "model", F.lit("confusion").alias("kind"), "y_true", "y_pred", F.col("pct").alias("score"), "rank")
    return wc.unionByName(wf)


@query("model_agreement", ops=("EVA08", "JON05"),
       sql=S.with_(*PRED_CTES) + f"SELECT a.model AS model_a, b.model AS model_b, round(avg(CASE WHEN a.y_pred = b.y_pred "
       f"THEN 1.0 ELSE 0.0 END), {R}) AS agreement, count(*) AS n FROM pr a JOIN pr b ON a.split = b.split AND a.idx = b.idx "
       "WHERE a.model < b.model AND a.split = 'val' GROUP BY a.model, b.model")
def model_agreement(spark, sf_dir):
    g = _gathered(spark, sf_dir, MODELS)
    bym = F.col("by_model")
    # model pairs come from the (fixed, small) model list, not from the data
    pairs = [(a, b) for i, a in enumerate(MODELS) for b in MODELS[i + 1:]]
    same = [F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"),
                     (ev.argmax(F.element_at(bym, F.lit(a))) == ev.argmax(F.element_at(bym, F.lit(b)))).alias("same"))
            for a, b in pairs]
    x = g.select(F.explode(F.array(*same)).alias("p"))
    return x.groupBy(F.col("p.model_a").alias("model_a"), F.col("p.model_b").alias("model_b")).agg(
        F.round(F.avg(F.col("p.same").cast("double")), R).alias("agreement"), F.count(F.lit(1)).alias("n"))


@query("confidence_by_correctness", ops=("EVA09", "AGG15"),
       sql=S.with_(*PRED_CTES) + f"SELECT model, y_true = y_pred AS correct, count(*) AS n, round(avg(max_prob), {R}) AS mean_conf, "
       f"round(min(max_prob), {R}) AS min_conf, round(max(max_prob), {R}) AS max_conf FROM pr GROUP BY ALL")
def confidence_by_correctness(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.groupBy("model", (F.col("y_true") == F.col("y_pred")).alias("correct")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("max_prob"), R).alias("mean_conf"),
        F.round(F.min("max_prob"), R).alias("min_conf"), F.round(F.max("max_prob"), R).alias("max_conf"))


@query("confidence_histogram", ops=("AGG15", "EVA09"),
       sql=S.with_(*PRED_CTES, "b AS (SELECT model, min(max_prob) AS lo, max(max_prob) AS hi FROM pr GROUP BY model)")
       + "SELECT pr.model, CAST(CASE WHEN b.hi = b.lo THEN 0 ELSE least(floor((max_prob - b.lo) / ((b.hi - b.lo) / 50)), 49) END AS INTEGER) AS bin, "
         "count(*) AS count FROM pr JOIN b USING (model) GROUP BY ALL")
def confidence_histogram(spark, sf_dir):
    from vitrine.operators.eda import histogram
    s = _scored(spark, sf_dir)
    return histogram(s, "max_prob", 50, by=["model"]).select("model", "bin", "count")


# ---------------------------------------------------------------------------
# ensembles
# ---------------------------------------------------------------------------

def _gathered(spark, sf_dir, models):
    p = views.predictions(spark, sf_dir).filter(F.col("split") == "val")
    return ens.gather(p, models)


def _fused_metrics(df, method, probs_col):
    scored = df.select(F.lit(method).alias("method"), "y_true",
                       ev.predicted_class(probs_col, F.col("classes")).alias("y_pred"))
    return ev.metrics(ev.confusion(scored, ["method"]), ["method"])


_A, _B = "model_a", "model_b"
_BYM = "map_from_entries(list(struct_pack(k := model, v := probs)))"


def _ens_ctes() -> list[str]:
    methods = {
        "simple_average": "list_transform(list_zip(pa, pb), lambda t: (t[1] + t[2]) / 2)",
        "weighted_average": "list_transform(list_zip(pa, pb), lambda t: 0.25 * t[1] + 0.75 * t[2])",
        "three_model_average": "list_transform(list_zip(pa, pb, pc), lambda t: t[1] / 3 + t[2] / 3 + t[3] / 3)",
        "geometric_mean": "list_transform(list_zip(pa, pb), lambda t: sqrt(t[1] * t[2]))",
        "harmonic_mean": "list_transform(list_zip(pa, pb), lambda t: 2 / (1 / (t[1] + 1e-10) + 1 / (t[2] + 1e-10)))",
        "voting": "list_transform(range(0, len(pa)), lambda c: ((list_position(pa, list_max(pa)) - 1 = c)::INT + "
                  "(list_position(pb, list_max(pb)) - 1 = c)::INT + (list_position(pc, list_max(pc)) - 1 = c)::INT) / 3.0)",
        "single_model_a": "pa",
        "single_model_b": "pb",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{k}' AS method, y_true, classes[list_position({e}, list_max({e}))] AS y_pred FROM g"
        for k, e in methods.items())
    return [*PRED_CTES,
            "g AS (SELECT idx, any_value(y_true) AS y_true, any_value(classes) AS classes, "
            "max(CASE WHEN model = 'model_a' THEN probs END) AS pa, max(CASE WHEN model = 'model_b' THEN probs END) AS pb, "
            "max(CASE WHEN model = 'model_c' THEN probs END) AS pc FROM predictions WHERE split = 'val' GROUP BY idx)",
            f"f AS ({rows})", *metrics_sql("f", ["method"])]


def _ens_sql() -> str:
    return (S.with_(*_ens_ctes(),
                    "best AS (SELECT max(f1_weighted) AS best_single FROM m_metrics WHERE method LIKE 'single_%')")
            + f"SELECT method, round(accuracy, {R}) AS accuracy, round(f1_weighted, {R}) AS f1_weighted, "
              f"round(f1_weighted - best_single, {R}) AS gain_abs, round((f1_weighted - best_single) / best_single * 100, {R}) "
              f"AS gain_pct, round(f1_weighted, 12) = max(round(f1_weighted, 12)) OVER () AS is_best FROM m_metrics, best")


def _ensemble_metrics(spark, sf_dir):
    """Metrics of every fusion method and of the single models (val)."""
    g = _gathered(spark, sf_dir, MODELS)
    bym = F.col("by_model")
    pa, pb = F.element_at(bym, F.lit(_A)), F.element_at(bym, F.lit(_B))
    methods = {
        "simple_average": ens.weighted_average(bym, [_A, _B]),
        "weighted_average": ens.weighted_average(bym, [_A, _B], [1.0, 3.0]),
        "three_model_average": ens.weighted_average(bym, MODELS),
        "geometric_mean": ens.geometric(pa, pb),
        "harmonic_mean": ens.harmonic(pa, pb),
        "voting": ens.voting(bym, MODELS, F.size("classes")),
        "single_model_a": pa,
        "single_model_b": pb,
    }
    # all methods read the same gathered rows: one scan, one shuffle
    fused = g.select("y_true", "classes", F.explode(F.array(*[
        F.struct(F.lit(k).alias("method"), e.alias("p")) for k, e in methods.items()])).alias("m"))
    scored = fused.select(F.col("m.method").alias("method"), "y_true",
                          ev.predicted_class(F.col("m.p"), F.col("classes")).alias("y_pred"))
    return ev.metrics(ev.confusion(scored, ["method"]), ["method"])


@query("ensemble_methods", ops=("ENS01", "ENS02", "ENS03", "ENS05", "ENS06", "ENS07", "ENS08", "JON05"), sql=_ens_sql())
def ensemble_methods(spark, sf_dir):
    m = _ensemble_metrics(spark, sf_dir)
    best_single = m.filter(F.col("method").startswith("single_")).agg(F.max("f1_weighted")).first()[0]
    w = Window.partitionBy(F.lit(0))  # over the method table (8 rows)
    return m.select("method", *_rnd(["accuracy", "f1_weighted"]),
                    F.round(F.col("f1_weighted") - F.lit(best_single), R).alias("gain_abs"),
                    F.round((F.col("f1_weighted") - F.lit(best_single)) / F.lit(best_single) * 100, R).alias("gain_pct"),
                    (F.round("f1_weighted", 12) == F.max(F.round("f1_weighted", 12)).over(w)).alias("is_best"))


@query("ensemble_gain_by_metric", ops=("ENS08", "EVA01"),
       sql=S.with_(*_ens_ctes(), *(f"{n} AS (SELECT * FROM m_metrics WHERE method {op} 'single_%' ORDER BY round(f1_weighted, 12) DESC, method LIMIT 1)"
                                   for n, op in (("single", "LIKE"), ("fused", "NOT LIKE"))))
       + " UNION ALL ".join(f"SELECT '{c}' AS metric, s.method AS single_method, e.method AS ensemble_method, round(s.{c}, {R}) AS single_value, "
                            f"round(e.{c}, {R}) AS ensemble_value, round(e.{c} - s.{c}, {R}) AS gain FROM single s, fused e" for c in METRIC_COLS))
def ensemble_gain_by_metric(spark, sf_dir):
    """Best single model against the best fusion (by weighted F1, tie: name), a row
    per metric."""
    m = _ensemble_metrics(spark, sf_dir)
    order = F.struct((-F.round("f1_weighted", 12)).alias("o"), F.col("method").alias("m"))
    best = m.groupBy(F.col("method").startswith("single_").alias("is_single")).agg(F.min_by(F.struct("method", *METRIC_COLS), order).alias("b"))
    pair = best.agg(*(F.max(F.when(F.col("is_single") == single, F.col("b"))).alias(n) for n, single in (("s", True), ("e", False))))
    rows = F.array(*(F.struct(F.lit(c).alias("metric"), F.col("s.method").alias("single_method"), F.col("e.method").alias("ensemble_method"),
                              F.round(f"s.{c}", R).alias("single_value"), F.round(f"e.{c}", R).alias("ensemble_value"),
                              F.round(F.col(f"e.{c}") - F.col(f"s.{c}"), R).alias("gain")) for c in METRIC_COLS))
    return pair.select(F.explode(rows).alias("r")).select("r.*")


#: Model names of every family and order key, dealt to the predictions by label.
_NAMES = ["LeNet-5", "resnet50_v2", "vit_base", "SWIN-tiny", "CamemBERT", "xlmr-large", "mdeberta_v3", "flaubert", "distilbert", "densenet"]


@query("model_families", ops=("ORD01", "ENS09"),
       sql=S.with_(*PRED_CTES, f"named AS (SELECT [{', '.join(S.q(n) for n in _NAMES)}][1 + y_true % {len(_NAMES)}] || '_' || model AS name FROM predictions)")
       + "SELECT name, count(*) AS n, CASE " + " ".join(f"WHEN lower(name) LIKE '%{p}%' THEN {i}" for i, p in enumerate(fixed.MODEL_ORDER))
       + f" ELSE {len(fixed.MODEL_ORDER)} END AS order_key, CASE WHEN " + " OR ".join(f"lower(name) LIKE '%{k}%'" for k in fixed.TEXT_MODEL_KEYWORDS)
       + " THEN 'text' ELSE 'image' END AS family FROM named GROUP BY name")
def model_families(spark, sf_dir):
    """Order key and family of models whose names match the patterns, and of ones
    that match none."""
    p = views.predictions(spark, sf_dir)
    name = F.concat(F.get(F.array(*map(F.lit, _NAMES)), F.col("y_true") % len(_NAMES)), F.lit("_"), F.col("model"))
    counted = p.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("name", "n", ens.model_order_key(F.col("name")).alias("order_key"), ens.categorize(F.col("name")).alias("family"))


@query("top_classes_by_support", ops=("ORD03", "EVA04"),
       sql=S.with_(*PRED_CTES) + "SELECT * FROM (SELECT model, y_true, count(*) AS support, CAST(row_number() OVER (PARTITION BY model ORDER BY count(*) DESC, y_true) AS INTEGER) AS rank "
       "FROM predictions WHERE split = 'val' GROUP BY model, y_true) WHERE rank <= 5")
def top_classes_by_support(spark, sf_dir):
    p = views.predictions(spark, sf_dir).where("split = 'val'")
    support = p.groupBy("model", "y_true").agg(F.count(F.lit(1)).alias("support"))
    return top_k_per_group(support, ["model"], [F.desc("support"), F.asc("y_true")], 5).withColumn("rank", F.col("rank").cast("int"))


def _grid_sql() -> str:
    return (S.with_(*PRED_CTES,
                    "g AS (SELECT idx, any_value(y_true) AS y_true, any_value(classes) AS classes, "
                    "max(CASE WHEN model = 'model_a' THEN probs END) AS pa, max(CASE WHEN model = 'model_b' THEN probs END) AS pb "
                    "FROM predictions WHERE split = 'val' GROUP BY idx)",
                    "f AS (SELECT i AS weight_pct, y_true, classes[list_position(fp, list_max(fp))] AS y_pred FROM "
                    "(SELECT i, y_true, classes, list_transform(list_zip(pa, pb), lambda t: (i / 100.0) * t[1] + (1 - i / 100.0) * t[2]) AS fp "
                    "FROM g, range(0, 101) r(i)))", *metrics_sql("f", ["weight_pct"]),
                    "ranked AS (SELECT *, row_number() OVER (ORDER BY round(f1_weighted, 12) DESC, weight_pct) AS rank FROM m_metrics)")
            + f"SELECT weight_pct, round(accuracy, {R}) AS accuracy, round(f1_weighted, {R}) AS f1_weighted, rank, "
              "rank = 1 AS is_best FROM ranked WHERE rank <= 5")


@query("fusion_weight_grid", ops=("ENS04", "ORD03"), sql=_grid_sql())
def fusion_weight_grid(spark, sf_dir):
    g = _gathered(spark, sf_dir, [_A, _B])
    bym = F.col("by_model")
    pa, pb = F.element_at(bym, F.lit(_A)), F.element_at(bym, F.lit(_B))
    # 101 weights per sample, consumed straight into the confusion aggregate
    x = g.select("y_true", "classes", pa.alias("pa"), pb.alias("pb"),
                 F.explode(F.sequence(F.lit(0), F.lit(100))).alias("weight_pct"))
    fp = ens.blend(F.col("pa"), F.col("pb"), F.col("weight_pct") / F.lit(100.0))
    scored = x.select("weight_pct", "y_true", ev.predicted_class(fp, F.col("classes")).alias("y_pred"))
    m = ev.metrics(ev.confusion(scored, ["weight_pct"]), ["weight_pct"])
    w = Window.orderBy(F.round("f1_weighted", 12).desc(), F.asc("weight_pct"))  # 101 rows
    r = m.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 5)
    return r.select(F.col("weight_pct").cast("bigint").alias("weight_pct"), *_rnd(["accuracy", "f1_weighted"]), "rank",
                    (F.col("rank") == 1).alias("is_best"))


# ---------------------------------------------------------------------------
# contracts
# ---------------------------------------------------------------------------

def _fp_sql(e: str) -> str:
    return f"substr(sha256('[' || array_to_string({e}, ', ') || ']'), 1, 16)"


@query("prediction_contract", ops=("QC01", "QC04", "SRC10"),
       sql=S.with_(*PRED_CTES, "fp AS (SELECT " + _fp_sql("list(DISTINCT label ORDER BY label)") + " AS want, "
                   "count(DISTINCT label) AS k FROM embeddings)")
       + "SELECT model, split, count(*) AS num_samples, sum(CASE WHEN len(probs) <> k THEN 1 ELSE 0 END) AS bad_prob_length, "
         "sum(CASE WHEN len(classes) <> k THEN 1 ELSE 0 END) AS bad_class_length, "
         f"sum(CASE WHEN {_fp_sql('classes')} <> want THEN 1 ELSE 0 END) AS bad_fingerprint, "
         "sum(CASE WHEN idx IS NULL THEN 1 ELSE 0 END) AS null_idx, sum(CASE WHEN y_true IS NULL THEN 1 ELSE 0 END) AS null_y_true, "
         "sum(CASE WHEN len(list_filter(probs, lambda p: p IS NULL OR p < 0 OR p > 1)) > 0 THEN 1 ELSE 0 END) AS bad_prob_value, "
         f"max({_fp_sql('classes')}) AS classes_fp FROM predictions, fp GROUP BY model, split")
def prediction_contract(spark, sf_dir):
    p = views.predictions(spark, sf_dir)
    labels = sorted_labels(p)
    want = p.sparkSession.range(1).select(qc.class_fingerprint(F.array(*[F.lit(int(x)) for x in labels]))).first()[0]
    return qc.prediction_contract(p, len(labels), want)


@query("canonical_fingerprint", ops=("QC04", "SRC10", "JON06"),
       sql=S.with_(S.LISTING_DOC) + "SELECT " + _fp_sql("[" + ", ".join(str(c) for c in fixed.CANONICAL_CLASSES) + "]")
       + " AS classes_fp, 27 AS num_classes, count(*) AS n_listings, "
       "count(DISTINCT prdtypecode) AS n_codes_used FROM listing_doc")
def canonical_fingerprint(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    canon = F.array(*[F.lit(c) for c in fixed.CANONICAL_CLASSES])
    return lst.agg(F.count(F.lit(1)).alias("n_listings"), F.countDistinct("prdtypecode").alias("n_codes_used")).select(
        qc.class_fingerprint(canon).alias("classes_fp"), F.lit(len(fixed.CANONICAL_CLASSES)).alias("num_classes"),
        "n_listings", "n_codes_used")


@query("split_signatures", ops=("QC02", "QC04"),
       sql=S.with_(*PRED_CTES, "sig AS (SELECT model, split, CAST(count(*) AS VARCHAR) || '-' || CAST(sum(CAST(('0x' || "
                   "substr(md5(CAST(idx AS VARCHAR)), 1, 12)) AS HUGEINT)) AS VARCHAR) AS split_signature FROM predictions GROUP BY ALL)")
       + "SELECT model, split, split_signature, count(DISTINCT split_signature) OVER (PARTITION BY split) = 1 AS aligned FROM sig")
def split_signatures(spark, sf_dir):
    p = views.predictions(spark, sf_dir)
    sig = qc.split_signature(p, ["model", "split"])
    n = sig.groupBy("split").agg(F.countDistinct("split_signature").alias("__k"))
    return sig.join(n, "split").select("model", "split", "split_signature", (F.col("__k") == 1).alias("aligned"))


@query("one_listing_probabilities", ops=("EVA11",),
       sql=S.with_(*PRED_CTES, "pick AS (SELECT min(idx) AS idx FROM predictions WHERE split = 'val')")
       + f"SELECT model, pos - 1 AS class_idx, classes[pos] AS class, round(probs[pos], {R}) AS prob, classes[pos] = y_true AS is_true "
         "FROM predictions JOIN pick USING (idx), range(1, len(probs) + 1) r(pos) WHERE split = 'val'")
def one_listing_probabilities(spark, sf_dir):
    p = views.predictions(spark, sf_dir).filter(F.col("split") == "val")
    first = p.agg(F.min("idx")).first()[0]
    one = p.filter(F.col("idx") == first)
    x = one.select("model", "y_true", "classes", F.posexplode("probs").alias("class_idx", "prob"))
    return x.select("model", F.col("class_idx").cast("bigint").alias("class_idx"),
                    F.element_at("classes", F.col("class_idx") + 1).alias("class"),
                    F.round("prob", R).alias("prob"),
                    (F.element_at("classes", F.col("class_idx") + 1) == F.col("y_true")).alias("is_true"))
