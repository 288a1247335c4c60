"""Language indicators (TXF08) and the stateless streaming path (§2.15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import features as tf
from vitrine.functions import numeric as N
from vitrine.functions import text as tx
from vitrine.operators import language as L
from vitrine.operators import vectorize as V
from vitrine.plans import sqlkit as S
from vitrine.plans.q_num import _rewrite_sql
from vitrine.plans.q_text import HTML_TOKENS
from vitrine.plans.q_vec import sql_tfidf
from vitrine.plans.registry import query
from vitrine.sources import views

R = 6
TEXT_SQL = "lower(coalesce(designation, '') || ' ' || coalesce(description, ''))"


def _lang_sql() -> str:
    chars = (f"SELECT row_id, generate_subscripts(c, 1) AS pos, unnest(c) AS ch FROM (SELECT row_id, string_split({TEXT_SQL}, '') AS c "
             f"FROM listing_doc WHERE {TEXT_SQL} <> '')")
    tri = f"SELECT row_id, ch || lead(ch, 1) OVER w || lead(ch, 2) OVER w AS term FROM ({chars}) WINDOW w AS (PARTITION BY row_id ORDER BY pos)"
    return (S.with_(S.LISTING_DOC,
                    f"tc AS (SELECT row_id, term, count(*) AS tf FROM ({tri}) WHERE term IS NOT NULL GROUP BY row_id, term)",
                    "tr AS (SELECT tc.*, l.lang FROM tc JOIN listing_doc l USING (row_id))",
                    "cnt AS (SELECT lang, term, sum(tf) AS n FROM tr GROUP BY lang, term)",
                    "tot AS (SELECT lang, sum(n) AS total FROM cnt GROUP BY lang)",
                    "voc AS (SELECT count(DISTINCT term) AS v FROM cnt)",
                    "dflt AS (SELECT lang, ln(1.0 / (total + v)) AS d, total FROM tot, voc)",
                    "prof AS (SELECT c.lang, c.term, ln((c.n + 1.0) / (d.total + v)) - d.d AS delta FROM cnt c JOIN dflt d USING (lang), voc)",
                    "ntf AS (SELECT row_id, sum(tf) AS n FROM tc GROUP BY row_id)",
                    "seen AS (SELECT tc.row_id, p.lang, sum(tc.tf * p.delta) AS s FROM tc JOIN prof p USING (term) GROUP BY ALL)",
                    "sc AS (SELECT l.row_id, d.lang, coalesce(ntf.n, 0) * d.d + coalesce(seen.s, 0.0) AS score "
                    "FROM listing_doc l CROSS JOIN dflt d LEFT JOIN ntf ON ntf.row_id = l.row_id "
                    "LEFT JOIN seen ON seen.row_id = l.row_id AND seen.lang = d.lang)",
                    "best AS (SELECT row_id, lang AS lang_pred FROM (SELECT *, row_number() OVER (PARTITION BY row_id "
                    "ORDER BY score DESC, lang) AS rk FROM sc) WHERE rk = 1)")
            + "SELECT b.row_id, b.lang_pred, l.lang AS lang_true, CAST(b.lang_pred = 'fr' AS INTEGER) AS txt_fr, "
              "CAST(b.lang_pred = 'en' AS INTEGER) AS txt_en, CAST(b.lang_pred NOT IN ('fr', 'en') AS INTEGER) AS txt_other "
              "FROM best b JOIN listing_doc l USING (row_id)")


@query("language_detection", ops=("TXF08",), sql=_lang_sql())
def language_detection(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    text = F.concat_ws(" ", F.coalesce("designation", F.lit("")), F.coalesce("description", F.lit("")))
    prof, defaults, langs = L.fit_profiles(lst, "row_id", text, "lang")  # every row carries its language
    best = L.detect(lst, "row_id", text, prof, defaults, langs)
    out = best.join(lst.select("row_id", F.col("lang").alias("lang_true")), "row_id")
    return out.select("row_id", F.col("lang").alias("lang_pred"), "lang_true", *L.one_hot(F.col("lang")))


def _stream_sql() -> str:
    feats = []
    for col in ("designation", "description"):
        feats += S.text_features(col)
    cleaned = (f"SELECT row_id, category, {S.native_clean('designation')} AS designation, "
               f"CASE WHEN description IS NULL THEN NULL ELSE {S.native_clean('description')} END AS description "
               f"FROM listing_doc")
    return (S.with_(S.LISTING_DOC, f"cleaned AS ({cleaned})")
            + "SELECT row_id, category, " + ", ".join(f"{e} AS {n}" for n, e in feats) + " FROM cleaned")


@query("streaming_listing_features", ops=("UDF01", "STREAM"), sql=_stream_sql())
def streaming_listing_features(spark, sf_dir):
    """The flagship's per-row part on a file stream (availableNow), read back."""
    from vitrine.streaming.stateless import listing_features_stream
    return listing_features_stream(spark, sf_dir)


# ---------------------------------------------------------------------------
# full text union (TXF11): language, lengths, HTML tags, weighted TF-IDF
# ---------------------------------------------------------------------------

UNION_MODE = "light"
UNION_TITLE_WEIGHT = 1.8
_TITLE, _DESC = (V.build_vectorizer("tfidf", ngram_range=(1, 2), min_df=1, max_df=0.95, max_features=50_000, sublinear_tf=False, lowercase=True) for _ in range(2))
_LENGTHS = {f"{c}_{k}": (c, k) for c in ("designation", "description") for k in ("chars", "words")}


def _scaled_sql(block: str, columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT row_id, '{block}' AS block, '{c}' AS term, (\"{c}\" - avg(\"{c}\") OVER ()) / "
        f"CASE WHEN stddev_pop(\"{c}\") OVER () > 0 THEN stddev_pop(\"{c}\") OVER () ELSE 1 END AS weight FROM {source}" for c in columns)


def _union_sql() -> str:
    clean = f"cl AS (SELECT row_id, {S.native_clean('designation')} AS designation, {S.native_clean('description')} AS description FROM listing_page)"
    titles, title = _rewrite_sql("cl", "designation", UNION_MODE, "nt")
    descs, desc = _rewrite_sql("cl", "description", UNION_MODE, "nd")
    both = f"num AS (SELECT row_id, a.t AS designation, b.t AS description FROM {title} a JOIN {desc} b USING (row_id))"
    tags = ", ".join(f"CAST((length(txt) - length(replace(txt, '{t}', ''))) / {len(t)} AS BIGINT) AS \"{t}\"" for t in HTML_TOKENS)
    html = f"ht AS (SELECT row_id, {tags} FROM (SELECT row_id, ' ' || coalesce(designation, '') || ' ' || coalesce(description, '') AS txt FROM listing_page))"
    lens = "le AS (SELECT row_id, " + ", ".join(f"{S.len_char(c) if k == 'chars' else S.len_words(c)} AS {n}" for n, (c, k) in _LENGTHS.items()) + " FROM cl)"

    def trigrams(source: str) -> str:
        text = "lower(coalesce(designation, '') || ' ' || coalesce(description, ''))"
        chars = (f"SELECT row_id, generate_subscripts(c, 1) AS pos, unnest(c) AS ch FROM (SELECT row_id, string_split({text}, '') AS c FROM {source} WHERE {text} <> '')")
        return (f"SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, ch || lead(ch, 1) OVER w || lead(ch, 2) OVER w AS term FROM ({chars}) "
                "WINDOW w AS (PARTITION BY row_id ORDER BY pos)) WHERE term IS NOT NULL GROUP BY row_id, term")
    lang = ["cnt AS (SELECT lang, term, sum(tf) AS n FROM (" + trigrams("listing_doc") + ") JOIN (SELECT row_id, lang FROM listing_doc) USING (row_id) GROUP BY lang, term)",
            "dflt AS (SELECT lang, ln(1.0 / (total + v)) AS d, total, v FROM (SELECT lang, sum(n) AS total FROM cnt GROUP BY lang), (SELECT count(DISTINCT term) AS v FROM cnt))",
            "prof AS (SELECT c.lang, c.term, ln((c.n + 1.0) / (d.total + d.v)) - d.d AS delta FROM cnt c JOIN dflt d USING (lang))",
            "tc AS (" + trigrams("cl") + ")",
            "sc AS (SELECT l.row_id, d.lang, coalesce(t.n, 0) * d.d + coalesce(s.s, 0.0) AS score FROM cl l CROSS JOIN dflt d "
            "LEFT JOIN (SELECT row_id, sum(tf) AS n FROM tc GROUP BY row_id) t ON t.row_id = l.row_id "
            "LEFT JOIN (SELECT tc.row_id, p.lang, sum(tc.tf * p.delta) AS s FROM tc JOIN prof p USING (term) GROUP BY ALL) s ON s.row_id = l.row_id AND s.lang = d.lang)",
            "la AS (SELECT row_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, lang) AS rk FROM sc) WHERE rk = 1)"]
    parts = ["SELECT row_id, 'lang' AS block, CASE WHEN lang IN ('fr', 'en') THEN 'txt_' || lang ELSE 'txt_other' END AS term, CAST(1 AS DOUBLE) AS weight FROM la",
             _scaled_sql("length", list(_LENGTHS), "le"), _scaled_sql("html", HTML_TOKENS, "ht"),
             f"SELECT row_id, 'title', term, weight * {UNION_TITLE_WEIGHT} FROM ti_w", "SELECT row_id, 'description', term, weight FROM de_w"]
    return (S.with_(S.LISTING_DOC, S.LISTING_PAGE, clean, *titles, *descs, both, html, lens, *sql_tfidf("num", "designation", _TITLE, "ti"),
                    *sql_tfidf("num", "description", _DESC, "de"), *lang)
            + f"SELECT row_id, block, term, round(weight, {R}) AS weight FROM ({' UNION ALL '.join(parts)})")


@query("text_feature_union", ops=("TXF11", "TXF12", "TXF08", "TXF07", "TXF09", "TXF10", "CLN04", "NUM09"), sql=_union_sql())
def text_feature_union(spark, sf_dir):
    """Every text feature of a page listing as rows: language (trigram profiles of
    the labelled listings), scaled lengths of the cleaned text, scaled HTML-tag
    counts of the raw text, TF-IDF of the cleaned text with numeric tokens, the
    title weighted."""
    raw = views.listing_page(spark, sf_dir).select("row_id", "designation", "description")
    cleaned = raw.select("row_id", *(tx.native_final_cleaner(F.coalesce(c, F.lit(""))).alias(c) for c in ("designation", "description"))).cache()
    both = lambda: F.concat_ws(" ", F.coalesce("designation", F.lit("")), F.coalesce("description", F.lit("")))
    profile = L.fit_profiles(views.listing_doc(spark, sf_dir), "row_id", both(), "lang")
    lang = L.detect(cleaned, "row_id", both(), *profile)
    one = F.when(F.col("lang").isin("fr", "en"), F.concat(F.lit("txt_"), "lang")).otherwise(F.lit("txt_other"))
    out = lang.select("row_id", F.lit("lang").alias("block"), one.alias("term"), F.lit(1.0).alias("weight"))

    def scaled(block, df, names):
        stats = tf.fit_standard_scaler(df, [f"c{k}" for k in range(len(names))])
        rows = F.array(*(F.struct(F.lit(n).alias("term"), ((F.col(c) - F.lit(m)) / F.lit(s)).alias("weight")) for n, (c, (m, s)) in zip(names, stats.items(), strict=True)))
        return df.select("row_id", F.lit(block).alias("block"), F.explode(rows).alias("e")).select("row_id", "block", "e.*")

    lengths = cleaned.select("row_id", *((tf.len_char if k == "chars" else tf.len_words)(F.col(c)).alias(f"c{i}") for i, (c, k) in enumerate(_LENGTHS.values())))
    tags = raw.select("row_id", *tf.token_frequency_columns(["designation", "description"], HTML_TOKENS)).toDF("row_id", *(f"c{k}" for k in range(len(HTML_TOKENS))))
    out = out.unionByName(scaled("length", lengths, list(_LENGTHS))).unionByName(scaled("html", tags, HTML_TOKENS))
    tokens = N.rewrite_title_description(cleaned, "designation", "description", UNION_MODE, merge=False).cache()
    for block, col, cfg, weight in (("title", "designation", _TITLE, UNION_TITLE_WEIGHT), ("description", "description", _DESC, 1.0)):
        _, long = V.fit_transform(tokens, "row_id", F.col(col), cfg)
        out = out.unionByName(long.select("row_id", F.lit(block).alias("block"), "term", (F.col("weight") * weight).alias("weight")))
    return out.withColumn("weight", F.round("weight", R))
