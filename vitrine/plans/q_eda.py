"""Exploratory aggregate queries (AGG01-15, JON02-04, JON09, CLN25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import features as tf
from vitrine.functions import fixed
from vitrine.functions import text as tx
from vitrine.operators import eda
from vitrine.plans import sqlkit as S
from vitrine.plans.registry import query
from vitrine.sources import views

R = 6
LISTING_COLS = ["designation", "description", "productid", "imageid", "category", "prdtypecode"]


@query("null_rates_listing", ops=("AGG01", "PRJ06"),
       sql=S.with_(S.LISTING_DOC) + "SELECT * FROM (SELECT " + ", ".join(
           f"round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), {R}) AS {c}" for c in LISTING_COLS)
       + " FROM listing_doc) UNPIVOT (null_rate FOR column_name IN (" + ", ".join(LISTING_COLS) + "))")
def null_rates_listing(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    return eda.null_rates(lst, LISTING_COLS).select("column_name", F.round("null_rate", R).alias("null_rate"))


@query("description_null_rate_by_category", ops=("AGG01",),
       sql=S.with_(S.LISTING_DOC) + f"SELECT category, round(avg(CASE WHEN description IS NULL THEN 1.0 ELSE 0.0 END), {R}) "
           "AS null_rate, count(*) AS n_rows FROM listing_doc GROUP BY category")
def description_null_rate_by_category(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    return (eda.null_rate_by(lst, "description", "category")
               .select("category", F.round("null_rate", R).alias("null_rate"), "n_rows")
               .orderBy(F.desc("null_rate"), "category"))


@query("rows_with_any_null", ops=("PRJ06", "PRJ04"),
       sql=S.with_(S.LISTING_DOC) + "SELECT row_id, designation FROM listing_doc WHERE "
           + " OR ".join(f"{c} IS NULL" for c in LISTING_COLS))
def rows_with_any_null(spark, sf_dir):
    from functools import reduce
    lst = views.listing_doc(spark, sf_dir)
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in LISTING_COLS])
    return lst.filter(any_null).select("row_id", "designation")


@query("category_distribution", ops=("AGG02", "JON02", "JON03", "CLN26"),
       sql=S.with_(S.LISTING_DOC, S.category_dim_sql()) + f"""
SELECT c.code, c.count, c.percentage, coalesce(d.short_name, CAST(c.code AS VARCHAR)) AS category_name,
       d.grp AS category_group,
       CASE WHEN length(CAST(c.code AS VARCHAR) || ': ' || coalesce(d.name, CAST(c.code AS VARCHAR))) > 30
            THEN substr(CAST(c.code AS VARCHAR) || ': ' || coalesce(d.name, CAST(c.code AS VARCHAR)), 1, 27) || '...'
            ELSE CAST(c.code AS VARCHAR) || ': ' || coalesce(d.name, CAST(c.code AS VARCHAR)) END AS label
FROM (SELECT prdtypecode AS code, count(*) AS count,
             round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percentage
      FROM listing_doc GROUP BY prdtypecode) c
LEFT JOIN category_dim d ON c.code = d.code""")
def category_distribution(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    dim = views.category_dim(spark)
    dist = eda.category_distribution(lst, "prdtypecode", dim, short=True)
    full = F.broadcast(dim.select("code", F.col("name").alias("full_name"), F.col("grp").alias("category_group")))
    out = dist.join(full, "code", "left")
    name = F.coalesce("full_name", F.col("code").cast("string"))
    return out.select("code", "count", "percentage", "category_name", "category_group",
                      tx.format_category_label(F.col("code"), name, max_length=30).alias("label"))


@query("category_lookup_fallback", ops=("JON02", "JON03", "PRJ10"),
       sql=S.with_(S.category_dim_sql()) + """
SELECT n.n_nationkey * 10 AS code, coalesce(d.name, CAST(n.n_nationkey * 10 AS VARCHAR)) AS category_name,
       d.grp AS category_group, (d.code IS NOT NULL) AS is_valid_code
FROM nation n LEFT JOIN category_dim d ON n.n_nationkey * 10 = d.code""")
def category_lookup_fallback(spark, sf_dir):
    from vitrine.sources.tables import table
    nat = table(spark, sf_dir, "nation").select((F.col("n_nationkey") * 10).cast("int").alias("code"))
    dim = views.category_dim(spark)
    valid = F.col("code").isin(fixed.CANONICAL_CLASSES)
    return (nat.join(F.broadcast(dim), "code", "left")
               .select("code", F.coalesce("name", F.col("code").cast("string")).alias("category_name"),
                       F.col("grp").alias("category_group"), valid.alias("is_valid_code")))


def _word_freq_sql(lower: bool, stop: bool, n: int) -> str:
    e = S.coalesce_text("description")
    if lower:
        e = f"lower({e})"
    cond = "w <> ''"
    if stop:
        cond += " AND NOT list_contains([" + ", ".join(S.q(w) for w in fixed.STOPWORDS_FR_EN) + "], w)"
    return (S.with_(S.LISTING_DOC) + f"SELECT word, count(*) AS count FROM (SELECT unnest(list_filter("
            f"regexp_split_to_array({e}, '{S.WS}+'), lambda w: {cond})) AS word FROM listing_doc) "
            f"GROUP BY word ORDER BY count DESC, word LIMIT {n}")


@query("word_frequency_top", ops=("AGG03",), sql=_word_freq_sql(False, False, 50))
def word_frequency_top(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    return eda.word_frequency(F.coalesce("description", F.lit("")), lst, 50)


@query("word_frequency_no_stopwords", ops=("AGG04",), sql=_word_freq_sql(True, True, 50))
def word_frequency_no_stopwords(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    return eda.word_frequency(F.coalesce("description", F.lit("")), lst, 50, lower=True,
                              stopwords=fixed.STOPWORDS_FR_EN)


def _ngram_sql(n_lo, n_hi, top_n, min_df) -> str:
    toks = "regexp_extract_all(lower(coalesce(designation, '') || ' ' || coalesce(description, '')), '[\\pL\\pN_]{2,}')"
    parts = []
    for n in range(n_lo, n_hi + 1):
        if n == 1:
            parts.append("SELECT row_id, unnest(toks) AS ngram FROM tk")
        else:
            parts.append(f"SELECT row_id, array_to_string(toks[i:i + {n - 1}], ' ') AS ngram FROM tk, "
                         f"range(1, len(toks) - {n - 2}) r(i)")
    return (S.with_(S.LISTING_DOC, f"tk AS (SELECT row_id, {toks} AS toks FROM listing_doc)",
                    "g AS (" + " UNION ALL ".join(parts) + ")",
                    "pd AS (SELECT row_id, ngram, count(*) AS tf FROM g GROUP BY row_id, ngram)")
            + f"SELECT ngram, sum(tf) AS count FROM pd GROUP BY ngram HAVING count(*) >= {min_df} "
              f"ORDER BY count DESC, ngram LIMIT {top_n}")


@query("top_ngrams_2_3", ops=("AGG05", "VEC01", "VEC03"), sql=_ngram_sql(2, 3, 30, 5))
def top_ngrams_2_3(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    text = F.concat(F.coalesce("designation", F.lit("")), F.lit(" "), F.coalesce("description", F.lit("")))
    out = eda.top_ngrams(lst, text, (2, 3), top_n=30, min_df=5)
    return out.select("ngram", F.col("count").cast("long").alias("count"))


KEYWORDS = ["the", "and", "eau", "der", "la", "que", "ment"]


@query("keyword_rate_by_category", ops=("AGG06", "AGG07", "JON09"),
       sql=S.with_(S.LISTING_DOC) + "SELECT * FROM (SELECT category, " + ", ".join(
           f"round(avg(CASE WHEN regexp_matches(coalesce(designation, '') || ' ' || coalesce(description, ''), "
           f"'(^|[^\\pL\\pN_]){k}([^\\pL\\pN_]|$)') THEN 1.0 ELSE 0.0 END), {R}) AS \"{k}\"" for k in KEYWORDS)
       + " FROM listing_doc GROUP BY category) UNPIVOT (rate FOR keyword IN (" + ", ".join(f'"{k}"' for k in KEYWORDS) + "))")
def keyword_rate_by_category(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    text = F.concat(F.coalesce("designation", F.lit("")), F.lit(" "), F.coalesce("description", F.lit("")))
    out = eda.keyword_rate_by(lst, text, KEYWORDS, "category")
    return out.select("category", "keyword", F.round("rate", R).alias("rate"))


@query("keyword_rows", ops=("PRJ07",),
       sql=S.with_(S.LISTING_DOC, "t AS (SELECT row_id, coalesce(designation, '') || ' ' || coalesce(description, '') AS txt FROM listing_doc)")
       + " UNION ALL ".join(f"SELECT row_id, '{k}' AS keyword, length(txt) AS n_chars FROM t WHERE regexp_matches(txt, '(^|[^\\pL\\pN_]){k}([^\\pL\\pN_]|$)')" for k in KEYWORDS))
def keyword_rows(spark, sf_dir):
    """The rows that hold a keyword as a whole word, once per keyword."""
    lst = views.listing_doc(spark, sf_dir)
    text = F.concat(F.coalesce("designation", F.lit("")), F.lit(" "), F.coalesce("description", F.lit("")))
    hits = lst.select("row_id", text.alias("txt"))
    held = F.filter(F.array(*(F.when(F.col("txt").rlike(rf"(?U)\b{k}\b"), F.lit(k)) for k in KEYWORDS)), lambda k: k.isNotNull())
    return hits.select("row_id", F.explode(held).alias("keyword"), F.length("txt").cast("long").alias("n_chars"))


@query("duplicate_groups_doc", ops=("AGG08", "JON04"),
       sql=S.with_(S.LISTING_DOC, f"c AS (SELECT row_id, {S.native_clean('designation')} AS title_clean, "
                   f"{S.native_clean('description')} AS desc_clean FROM listing_doc)") + """
SELECT row_id, title_clean, desc_clean, count(*) OVER (PARTITION BY title_clean, desc_clean) AS dup_count,
       count(*) OVER (PARTITION BY title_clean, desc_clean) > 1 AS is_duplicate FROM c""")
def duplicate_groups_doc(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    c = lst.select("row_id", tx.native_final_cleaner(F.col("designation")).alias("title_clean"),
                   tx.native_final_cleaner(F.col("description")).alias("desc_clean"))
    return eda.duplicate_groups(c, ["title_clean", "desc_clean"])


FEATS = tf.feature_names()


@query("describe_features", ops=("AGG09", "TXF03"),
       sql=S.with_(S.LISTING_DOC, "f AS (SELECT " + ", ".join(
           f"{e} AS {n}" for col in ("designation", "description") for n, e in S.text_features(col))
           + " FROM listing_doc)",
           "l AS (SELECT feature, CAST(value AS DOUBLE) AS value FROM f UNPIVOT (value FOR feature IN ("
           + ", ".join(FEATS) + ")))")
       + f"SELECT feature, count(*) AS count, round(avg(value), {R}) AS mean, round(stddev_samp(value), {R}) AS std, "
         f"round(min(value), {R}) AS min, round(quantile_cont(value, 0.25), {R}) AS p25, "
         f"round(quantile_cont(value, 0.5), {R}) AS p50, round(quantile_cont(value, 0.75), {R}) AS p75, "
         f"round(max(value), {R}) AS max FROM l GROUP BY feature")
def describe_features(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    feats = lst.select(*tf.text_feature_columns())
    d = eda.exact_describe(feats, FEATS)
    return d.select("feature", "count", *[F.round(c, R).alias(c) for c in
                                          ("mean", "std", "min", "p25", "p50", "p75", "max")])


_CONFIGS = {
    "raw": {},
    "lowercase": {"lowercase": True},
    "remove_html_tags": {"remove_html_tags": True},
    "remove_punctuation": {"remove_punctuation": True},
    "remove_boilerplate": {"remove_boilerplate": True},
    "remove_stopwords": {"remove_stopwords": True},
    "traditional": {"remove_html_tags": True, "lowercase": True, "remove_punctuation": True,
                    "remove_stopwords": True, "remove_single_letters": True, "remove_single_digits": True,
                    "remove_pure_punct_tokens": True},
}


def _config_sql() -> str:
    from vitrine.plans.q_text import _sql_token_filter, _sql_boilerplate
    t = "text"
    exprs = {
        "raw": S.collapse_ws(t),
        "lowercase": S.collapse_ws(S.lower(t)),
        "remove_html_tags": S.collapse_ws(S.html_tags(t)),
        "remove_punctuation": S.collapse_ws(S.punctuation(t)),
        "remove_boilerplate": S.collapse_ws(_sql_boilerplate(t)),
        "remove_stopwords": S.collapse_ws(_sql_token_filter(t, stop=True)),
        "traditional": S.collapse_ws(_sql_token_filter(S.punctuation(S.lower(S.html_tags(t))), True, True, True, True)),
    }
    cols = ", ".join(f"round(avg(length({e})), {R}) AS \"{k}\"" for k, e in exprs.items())
    return (S.with_(S.LISTING_DOC, f"d AS (SELECT coalesce(designation, '') || ' ' || coalesce(description, '') AS text FROM listing_doc)")
            + f"SELECT * FROM (SELECT {cols} FROM d) UNPIVOT (avg_length FOR config IN ("
            + ", ".join(f'"{k}"' for k in exprs) + "))")


@query("cleaning_config_lengths", ops=("CLN25", "AGG13", "CLN23"), sql=_config_sql())
def cleaning_config_lengths(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    text = F.concat(F.coalesce("designation", F.lit("")), F.lit(" "), F.coalesce("description", F.lit("")))
    # n configurations in ONE projection: the scan happens once
    wide = lst.select(*[F.length(tx.clean_text(text, **flags)).alias(k) for k, flags in _CONFIGS.items()])
    aggd = wide.agg(*[F.avg(k).alias(k) for k in _CONFIGS])
    stack = ", ".join(f"'{k}', `{k}`" for k in _CONFIGS)
    return aggd.selectExpr(f"stack({len(_CONFIGS)}, {stack}) AS (config, avg_length)").select(
        "config", F.round("avg_length", R).alias("avg_length"))


#: Rules and combinations beside ``_CONFIGS`` that SQL can state.
_MERGE_FLAGS = {"merge_dimensions": "dims", "merge_units": "units", "merge_durations": "durations", "merge_age_ranges": "ages", "tag_years": "years"}
_RULE_CONFIGS = {
    "raw": {},
    "normalize_unicode": {"normalize_unicode": True},
    **{flag: {flag: True} for flag in _MERGE_FLAGS},
    "remove_single_letters": {"remove_single_letters": True},
    "remove_single_digits": {"remove_single_digits": True},
    "remove_pure_punct_tokens": {"remove_pure_punct_tokens": True},
    "all_merges": {flag: True for flag in _MERGE_FLAGS if flag.startswith("merge")},
}


def _rule_lengths_sql() -> str:
    from vitrine.plans.q_text import _sql_rules, _sql_token_filter
    t = "text"
    merged = t
    for flag in _RULE_CONFIGS["all_merges"]:
        merged = _sql_rules(merged, fixed.MERGE_RULES[_MERGE_FLAGS[flag]])
    exprs = {"raw": t, "normalize_unicode": f"nfc_normalize({t})", **{flag: _sql_rules(t, fixed.MERGE_RULES[k]) for flag, k in _MERGE_FLAGS.items()},
             "remove_single_letters": _sql_token_filter(t, letters=True), "remove_single_digits": _sql_token_filter(t, digits=True),
             "remove_pure_punct_tokens": _sql_token_filter(t, punct=True), "all_merges": merged}
    cols = ", ".join(f"round(avg(length({S.collapse_ws(e)})), {R}) AS \"{k}\"" for k, e in exprs.items())
    return (S.with_(S.LISTING_PART, "d AS (SELECT coalesce(description, '') AS text FROM listing_part)")
            + f"SELECT * FROM (SELECT {cols} FROM d) UNPIVOT (avg_length FOR config IN (" + ", ".join(f'"{k}"' for k in exprs) + "))")


@query("cleaning_rule_lengths", ops=("AGG13", "CLN25"), sql=_rule_lengths_sql())
def cleaning_rule_lengths(spark, sf_dir):
    """Average length per rule on the number-rich listings, where the merges fire."""
    text = F.coalesce("description", F.lit(""))
    lengths = views.listing_part(spark, sf_dir).select(*[F.length(tx.clean_text(text, **flags)).alias(k) for k, flags in _RULE_CONFIGS.items()])
    wide = lengths.agg(*[F.avg(k).alias(k) for k in _RULE_CONFIGS])
    stack = ", ".join(f"'{k}', `{k}`" for k in _RULE_CONFIGS)
    return wide.selectExpr(f"stack({len(_RULE_CONFIGS)}, {stack}) AS (config, avg_length)").select("config", F.round("avg_length", R).alias("avg_length"))


def _summary_sql() -> str:
    feats = {n: e for col in ("designation", "description") for n, e in S.text_features(col)}
    cols = []
    for col in ("designation", "description"):
        for k in ("len_char", "len_words", "num_digits", "num_punctuation"):
            cols.append(f"round(avg({col}_{k}), {R}) AS mean_{col}_{k}")
        for k in ("uppercase_ratio", "digit_ratio"):
            cols.append(f"round(avg({col}_{k}) * 100, {R}) AS pct_{col}_{k}")
    return (S.with_(S.LISTING_DOC, "f AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in feats.items()) + " FROM listing_doc)")
            + "SELECT " + ", ".join(cols) + " FROM f")


@query("feature_summary", ops=("AGG10", "TXF03"), sql=_summary_sql())
def feature_summary(spark, sf_dir):
    """AGG10: mean lengths / counts and the two ratios in percent, one row."""
    feats = views.listing_doc(spark, sf_dir).select(*tf.text_feature_columns())
    aggs = []
    for col in ("designation", "description"):
        for k in ("len_char", "len_words", "num_digits", "num_punctuation"):
            aggs.append(F.round(F.avg(f"{col}_{k}"), R).alias(f"mean_{col}_{k}"))
        for k in ("uppercase_ratio", "digit_ratio"):
            aggs.append(F.round(F.avg(f"{col}_{k}") * 100, R).alias(f"pct_{col}_{k}"))
    return feats.agg(*aggs)
