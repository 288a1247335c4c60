"""Vectorisation queries (VEC01-13) with DuckDB restatements of the scikit rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import features as tf
from vitrine.operators import vectorize as V
from vitrine.plans import sqlkit as S
from vitrine.plans.registry import query
from vitrine.sources import views

R = 6


def sql_terms(src: str, text: str, analyzer: str, lo: int, hi: int, lowercase: bool, prefix: str) -> list[str]:
    """CTEs: {prefix}_g(row_id, term) with all n-grams of the analyzer."""
    t = f"coalesce({text}, '')"
    if lowercase:
        t = f"lower({t})"
    if analyzer == "char":
        t = f"regexp_replace({t}, '{S.WS}{S.WS}+', ' ', 'g')"
        toks = f"CASE WHEN {t} = '' THEN []::VARCHAR[] ELSE string_split({t}, '') END"
        join = "''"
    elif analyzer == "whitespace":
        toks = f"list_filter(regexp_split_to_array({t}, '{S.WS}+'), lambda w: w <> '')"
        join = "' '"
    else:
        toks = f"regexp_extract_all({t}, '[\\pL\\pN_]{{2,}}')"
        join = "' '"
    parts = []
    for n in range(lo, hi + 1):
        later = "".join(f" || {join} || lead(tok, {k}) OVER w" for k in range(1, n))
        parts.append(f"SELECT row_id, tok{later} AS term FROM {prefix}_p WINDOW w AS (PARTITION BY row_id ORDER BY pos)")
    # one row per token; an n-gram that runs over the end is NULL
    return [f"{prefix}_tk AS (SELECT row_id, {toks} AS toks FROM {src})",
            f"{prefix}_p AS (SELECT row_id, generate_subscripts(toks, 1) AS pos, unnest(toks) AS tok FROM {prefix}_tk)",
            f"{prefix}_g AS (SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE term IS NOT NULL)",
            f"{prefix}_c AS (SELECT row_id, term, count(*) AS tf FROM {prefix}_g GROUP BY row_id, term)"]


def sql_tfidf(src: str, text: str, cfg: V.VectorizerConfig, prefix: str) -> list[str]:
    """CTEs ending in {prefix}_w(row_id, term, idx, weight) and {prefix}_v(term, df, total, idx, idf)."""
    lo, hi = cfg.ngram_range
    ctes = sql_terms(src, text, cfg.analyzer, lo, hi, cfg.lowercase, prefix)
    maxdf = cfg.max_df if isinstance(cfg.max_df, int) else f"{cfg.max_df} * n"
    ctes += [
        f"{prefix}_n AS (SELECT count(*) AS n FROM {src})",
        f"{prefix}_s AS (SELECT term, count(*) AS df, sum(tf) AS total FROM {prefix}_c GROUP BY term)",
        f"{prefix}_f AS (SELECT term, df, total FROM {prefix}_s, {prefix}_n WHERE df >= {cfg.min_df} "
        f"AND df <= {maxdf} ORDER BY total DESC, term LIMIT {cfg.max_features})",
        f"{prefix}_v AS (SELECT term, df, total, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, "
        f"ln((1.0 + n) / (1.0 + df)) + 1 AS idf FROM {prefix}_f, {prefix}_n)",
    ]
    tfx = "1.0" if cfg.binary else ("(1 + ln(c.tf))" if cfg.sublinear_tf else "CAST(c.tf AS DOUBLE)")
    w = f"{tfx} * v.idf" if cfg.kind == "tfidf" else tfx
    ctes.append(f"{prefix}_r AS (SELECT c.row_id, c.term, v.idx, {w} AS weight FROM {prefix}_c c "
                f"JOIN {prefix}_v v ON c.term = v.term)")
    if cfg.kind == "tfidf" and cfg.norm == "l2":
        ctes.append(f"{prefix}_w AS (SELECT row_id, term, idx, weight / sqrt(sum(weight * weight) "
                    f"OVER (PARTITION BY row_id)) AS weight FROM {prefix}_r)")
    else:
        ctes.append(f"{prefix}_w AS (SELECT * FROM {prefix}_r)")
    return ctes


TFIDF_DESC = V.build_vectorizer("tfidf", ngram_range=(1, 2), min_df=2, max_df=0.95, max_features=500)


@query("tfidf_description", ops=("VEC01", "VEC03", "VEC05", "VEC07", "VEC08"),
       sql=S.with_(S.LISTING_DOC, *sql_tfidf("listing_doc", "description", TFIDF_DESC, "d"))
       + f"SELECT row_id, term, idx, round(weight, {R}) AS weight FROM d_w")
def tfidf_description(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    _, long = V.fit_transform(lst, "row_id", F.col("description"), TFIDF_DESC)
    return long.select("row_id", "term", "idx", F.round("weight", R).alias("weight"))


COUNT_TITLE = V.build_vectorizer("count", preset="small", binary=True, lowercase=True)


@query("count_vocabulary_title", ops=("VEC05", "VEC06", "VEC08"),
       sql=S.with_(S.LISTING_DOC, *sql_tfidf("listing_doc", "designation", COUNT_TITLE, "t"))
       + "SELECT term, df, total, idx FROM t_v")
def count_vocabulary_title(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    fitted = V.fit(lst, "row_id", F.col("designation"), COUNT_TITLE)
    return fitted.vocab.select("term", "df", F.col("total").cast("long").alias("total"), "idx")


@query("count_binary_title", ops=("VEC06",),
       sql=S.with_(S.LISTING_DOC, *sql_tfidf("listing_doc", "designation", COUNT_TITLE, "t"))
       + "SELECT row_id, idx, weight FROM t_w")
def count_binary_title(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    _, long = V.fit_transform(lst, "row_id", F.col("designation"), COUNT_TITLE)
    return long.select("row_id", "idx", "weight")


CHAR_TITLE = V.build_vectorizer("tfidf", analyzer="char", ngram_range=(3, 5), max_df=1.0, min_df=2,
                                max_features=2000, lowercase=True)


@query("char_ngrams_title", ops=("VEC04", "VEC07"),
       sql=S.with_(S.LISTING_DOC, *sql_tfidf("listing_doc", "designation", CHAR_TITLE, "ch"))
       + f"SELECT row_id, term, idx, round(weight, {R}) AS weight FROM ch_w")
def char_ngrams_title(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    _, long = V.fit_transform(lst, "row_id", F.col("designation"), CHAR_TITLE)
    return long.select("row_id", "term", "idx", F.round("weight", R).alias("weight"))


WS_VOCAB = V.build_vectorizer("count", analyzer="whitespace", ngram_range=(1, 1), min_df=3, max_df=0.5,
                              max_features=300)


@query("whitespace_vocabulary", ops=("VEC02", "VEC05"),
       sql=S.with_(S.LISTING_DOC, *sql_tfidf("listing_doc", "description", WS_VOCAB, "ws"))
       + "SELECT term, df, total, idx FROM ws_v")
def whitespace_vocabulary(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    fitted = V.fit(lst, "row_id", F.col("description"), WS_VOCAB)
    return fitted.vocab.select("term", "df", F.col("total").cast("long").alias("total"), "idx")


# split pipeline: title block x weight, description block, scaled features
SPLIT_TITLE = V.build_vectorizer("tfidf", ngram_range=(1, 1), min_df=2, max_df=0.95, max_features=300)
SPLIT_DESC = V.build_vectorizer("tfidf", ngram_range=(1, 1), min_df=2, max_df=0.95, max_features=400)
TITLE_WEIGHT = 1.5
SCALED = ["designation_len_char", "designation_len_words", "description_len_char", "description_len_words"]


def _split_sql() -> str:
    feats = {n: e for col in ("designation", "description") for n, e in S.text_features(col)}
    fsel = ", ".join(f"{feats[n]} AS {n}" for n in SCALED)
    scaled = " UNION ALL ".join(
        f"SELECT row_id, 'features' AS block, {300 + 400 + i} AS idx, "
        f"({n} - avg({n}) OVER ()) / CASE WHEN stddev_pop({n}) OVER () > 0 THEN stddev_pop({n}) OVER () ELSE 1 END AS weight FROM fe"
        for i, n in enumerate(SCALED))
    return (S.with_(S.LISTING_DOC, *sql_tfidf("listing_doc", "designation", SPLIT_TITLE, "ti"),
                    *sql_tfidf("listing_doc", "description", SPLIT_DESC, "de"),
                    f"fe AS (SELECT row_id, {fsel} FROM listing_doc)")
            + f"SELECT row_id, block, idx, round(weight, {R}) AS weight FROM ("
              f"SELECT row_id, 'title' AS block, idx, weight * {TITLE_WEIGHT} AS weight FROM ti_w UNION ALL "
              f"SELECT row_id, 'description' AS block, idx + 300 AS idx, weight FROM de_w UNION ALL "
              f"SELECT * FROM ({scaled}) WHERE weight <> 0)")


@query("split_weighted_blocks", ops=("VEC09", "VEC11", "TXF09", "TXF10"), sql=_split_sql())
def split_weighted_blocks(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    _, ti = V.fit_transform(lst, "row_id", F.col("designation"), SPLIT_TITLE)
    _, de = V.fit_transform(lst, "row_id", F.col("description"), SPLIT_DESC)
    fe = lst.select("row_id", *[tf.feature_column(n) for n in SCALED])
    stats = tf.fit_standard_scaler(fe, SCALED)
    scaled = fe.select("row_id", *tf.apply_standard_scaler(stats))
    blocks = (V.offset_block(ti, "row_id", 0, TITLE_WEIGHT, "title")
              .unionByName(V.offset_block(de, "row_id", 300, 1.0, "description"))
              .unionByName(V.dense_block(scaled, "row_id", SCALED, 700)))
    return blocks.select("row_id", "block", "idx", F.round("weight", R).alias("weight"))


# word + char union per column, title block weighted (four blocks)
W_T = V.build_vectorizer("tfidf", ngram_range=(1, 2), min_df=2, max_df=0.95, max_features=300, lowercase=True)
C_T = V.build_vectorizer("tfidf", analyzer="char", ngram_range=(3, 5), min_df=2, max_df=1.0, max_features=300, lowercase=True)
W_D = V.build_vectorizer("tfidf", ngram_range=(1, 2), min_df=2, max_df=0.95, max_features=400, lowercase=True)
C_D = V.build_vectorizer("tfidf", analyzer="char", ngram_range=(3, 5), min_df=2, max_df=1.0, max_features=400, lowercase=True)
UNION_TITLE_WEIGHT = 1.2


def _union_sql() -> str:
    ctes = [S.LISTING_DOC, *sql_tfidf("listing_doc", "designation", W_T, "wt"), *sql_tfidf("listing_doc", "designation", C_T, "ct"),
            *sql_tfidf("listing_doc", "description", W_D, "wd"), *sql_tfidf("listing_doc", "description", C_D, "cd")]
    return (S.with_(*ctes) + f"SELECT row_id, block, idx, round(weight, {R}) AS weight FROM ("
            f"SELECT row_id, 'title_word' AS block, idx, weight * {UNION_TITLE_WEIGHT} AS weight FROM wt_w UNION ALL "
            f"SELECT row_id, 'title_char', idx + 300, weight * {UNION_TITLE_WEIGHT} FROM ct_w UNION ALL "
            f"SELECT row_id, 'desc_word', idx + 600, weight FROM wd_w UNION ALL "
            f"SELECT row_id, 'desc_char', idx + 1000, weight FROM cd_w)")


@query("word_char_union_blocks", ops=("VEC12", "VEC04", "TXF10"), sql=_union_sql())
def word_char_union_blocks(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    parts = []
    for cfg, col, off, w, name in ((W_T, "designation", 0, UNION_TITLE_WEIGHT, "title_word"),
                                   (C_T, "designation", 300, UNION_TITLE_WEIGHT, "title_char"),
                                   (W_D, "description", 600, 1.0, "desc_word"),
                                   (C_D, "description", 1000, 1.0, "desc_char")):
        _, long = V.fit_transform(lst, "row_id", F.col(col), cfg)
        parts.append(V.offset_block(long, "row_id", off, w, name))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("row_id", "block", "idx", F.round("weight", R).alias("weight"))
