"""Queries over listings: cleaning, text features, per-category summaries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from vitrine.functions import features as tf
from vitrine.functions import fixed
from vitrine.functions import text as tx
from vitrine.plans import sqlkit as S
from vitrine.plans.registry import query
from vitrine.sources import views

R = 6  # decimals kept in hashed doubles


def _round_all(cols):
    return [F.round(c, R).alias(n) for n, c in cols]


# ---------------------------------------------------------------------------
# flagship: listing -> native cleaning -> 12 features -> per-category summary
# ---------------------------------------------------------------------------

def _flagship_sql() -> str:
    feats = []
    for col in ("designation", "description"):
        feats += S.text_features(col)
    cleaned = (f"SELECT row_id, category, {S.native_clean('designation')} AS designation, "
               f"CASE WHEN description IS NULL THEN NULL ELSE {S.native_clean('description')} END AS description "
               f"FROM listing_doc")
    feat_sel = ", ".join(f"{e} AS {n}" for n, e in feats)
    avgs = ", ".join(f"round(avg({n}), {R}) AS avg_{n}" for n, _ in feats)
    return (S.with_(S.LISTING_DOC, f"cleaned AS ({cleaned})",
                    f"feat AS (SELECT row_id, category, {feat_sel} FROM cleaned)")
            + f"SELECT category, count(*) AS n_rows, "
              f"round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct_rows, "
              f"sum(CASE WHEN description_len_char = 0 THEN 1 ELSE 0 END) AS n_empty_description, {avgs} "
              f"FROM feat GROUP BY category")


@query("listing_features_by_category", ops=("SRC01", "PRJ01", "PRJ03", "CLN04", "CLN05", "CLN11", "CLN17",
                                            "TXF01", "TXF02", "TXF03", "AGG02", "AGG10"),
       sql=_flagship_sql())
def listing_features_by_category(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    cleaned = lst.select(
        "row_id", "category",
        tx.native_final_cleaner(F.col("designation")).alias("designation"),
        F.when(F.col("description").isNull(), F.lit(None))
         .otherwise(tx.native_final_cleaner(F.col("description"))).alias("description"))
    feats = cleaned.select("row_id", "category", *tf.text_feature_columns())
    names = tf.feature_names()
    agg = feats.groupBy("category").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(F.col("description_len_char") == 0, 1).otherwise(0)).cast("long").alias("n_empty_description"),
        *[F.round(F.avg(n), R).alias(f"avg_{n}") for n in names])
    # the category table is tiny after the aggregate: the share needs one
    # global total, computed over the aggregated rows only
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(1)))
    return agg.withColumn("pct_rows", F.round(F.lit(100.0) * F.col("n_rows") / total, 2))


# ---------------------------------------------------------------------------
# structural merges and year tags on numeric-rich part listings (CLN06-10)
# ---------------------------------------------------------------------------

def _sql_rules(e: str, rules, flags="gi") -> str:
    for pat, rep in rules:
        e = f"regexp_replace({e}, {S.q(pat)}, {S.q(rep)}, '{flags}')"
    return e


def _merge_sql() -> str:
    d = "description"
    cols = [f"{_sql_rules(d, fixed.MERGE_RULES[k])} AS merged_{k}" for k in fixed.MERGE_RULES]
    allm = d
    for k in fixed.MERGE_RULES:
        allm = _sql_rules(allm, fixed.MERGE_RULES[k])
    return (S.with_(S.LISTING_PART) + f"SELECT row_id, {', '.join(cols)}, "
            f"{S.collapse_ws(allm)} AS merged_all FROM listing_part")


@query("clean_merge_rules_part", ops=("CLN06", "CLN07", "CLN08", "CLN09", "CLN10", "CLN17"), sql=_merge_sql())
def clean_merge_rules_part(spark, sf_dir):
    lp = views.listing_part(spark, sf_dir)
    d = F.col("description")
    return lp.select(
        "row_id",
        tx.merge_dimensions(d).alias("merged_dims"), tx.merge_units(d).alias("merged_units"),
        tx.merge_durations(d).alias("merged_durations"), tx.merge_age_ranges(d).alias("merged_ages"),
        tx.tag_years(d).alias("merged_years"),
        tx.clean_text(d, merge_dimensions=True, merge_units=True, merge_durations=True,
                      merge_age_ranges=True, tag_years=True).alias("merged_all"))


# ---------------------------------------------------------------------------
# token filters and boilerplate on document titles (CLN12-16)
# ---------------------------------------------------------------------------

_NOT_W = r"[^\pL\pN_]"


def _sql_boilerplate(e: str) -> str:
    for p in fixed.BOILERPLATE_PHRASES:
        pat = f"(^|{_NOT_W}){p}({_NOT_W}|$)"
        for _ in range(2):
            e = f"regexp_replace({e}, {S.q(pat)}, '\\1 \\2', 'gi')"
    return e


def _sql_list(items) -> str:
    return "[" + ", ".join(S.q(x) for x in items) + "]"


def _sql_token_filter(e: str, stop=False, letters=False, digits=False, punct=False) -> str:
    conds = ["t <> ''"]
    if stop:
        conds.append(f"NOT list_contains({_sql_list(fixed.STOPWORDS_FR_EN)}, lower(t))")
    if letters:
        conds.append(r"NOT regexp_full_match(t, '\pL')")
    if digits:
        conds.append(f"NOT regexp_full_match(t, '{S.PY_DIGIT}')")
    if punct:
        chars = sorted(set(fixed.ASCII_PUNCTUATION) | set(fixed.EXTRA_PUNCTUATION))
        cls = "".join("\\" + c if c in "\\[]^-" else c for c in chars)
        conds.append(f"NOT regexp_full_match(t, {S.q('[' + cls + ']+')})")
    return (f"array_to_string(list_filter(regexp_split_to_array({e}, '{S.WS}+'), "
            f"lambda t: {' AND '.join(conds)}), ' ')")


def _filters_sql() -> str:
    t = S.coalesce_text("designation")
    return (S.with_(S.LISTING_DOC) + "SELECT row_id, "
            f"{S.collapse_ws(_sql_boilerplate(t))} AS no_boilerplate, "
            f"{S.collapse_ws(_sql_token_filter(t, stop=True))} AS no_stopwords, "
            f"{S.collapse_ws(_sql_token_filter(t, letters=True))} AS no_single_letters, "
            f"{S.collapse_ws(_sql_token_filter(t, digits=True))} AS no_single_digits, "
            f"{S.collapse_ws(_sql_token_filter(t, punct=True))} AS no_punct_tokens, "
            f"{S.collapse_ws(_sql_token_filter(_sql_boilerplate(S.lower(t)), True, True, True, True))} AS all_filters "
            "FROM listing_doc")


@query("clean_token_filters_doc", ops=("CLN12", "CLN13", "CLN14", "CLN15", "CLN16", "CLN17"), sql=_filters_sql())
def clean_token_filters_doc(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    d = F.col("designation")
    return lst.select(
        "row_id",
        tx.clean_text(d, remove_boilerplate=True).alias("no_boilerplate"),
        tx.clean_text(d, remove_stopwords=True).alias("no_stopwords"),
        tx.clean_text(d, remove_single_letters=True).alias("no_single_letters"),
        tx.clean_text(d, remove_single_digits=True).alias("no_single_digits"),
        tx.clean_text(d, remove_pure_punct_tokens=True).alias("no_punct_tokens"),
        tx.clean_text(d, lowercase=True, remove_boilerplate=True, remove_stopwords=True,
                      remove_single_letters=True, remove_single_digits=True,
                      remove_pure_punct_tokens=True).alias("all_filters"))


# ---------------------------------------------------------------------------
# keyword families (documents) and unit heuristics (parts): TXF05, TXF06
# ---------------------------------------------------------------------------

def _keyword_sql() -> str:
    full = f"{S.coalesce_text('designation')} || ' ' || {S.coalesce_text('description')}"
    cols = ", ".join(f"{S.count_re('txt', '|'.join(w))} AS \"{fam}_keywords\""
                     for fam, w in fixed.KEYWORD_DICT.items())
    return (S.with_(S.LISTING_DOC, f"t AS (SELECT row_id, {full} AS txt FROM listing_doc)")
            + f"SELECT row_id, {cols} FROM t")


@query("keyword_features_doc", ops=("TXF05", "PRJ01"), sql=_keyword_sql())
def keyword_features_doc(spark, sf_dir):
    lst = views.listing_doc(spark, sf_dir)
    txt = F.concat(F.coalesce("designation", F.lit("")), F.lit(" "), F.coalesce("description", F.lit("")))
    return lst.select("row_id", *tf.keyword_columns(txt))


def _unit_sql() -> str:
    full = f"designation || ' ' || description"
    anyp = "(?i)" + "|".join(f"(?:{p})" for p in fixed.UNIT_PATTERNS.values())
    return (S.with_(S.LISTING_PART, f"t AS (SELECT row_id, {full} AS txt FROM listing_part)")
            + f"SELECT row_id, {S.count_re('txt', S.PY_DIGIT)} AS nb_digits_text, "
              f"CAST(regexp_matches(txt, 'n° ?(?:[0-9])+') AS INTEGER) AS contains_numerotation, "
              f"CAST(regexp_matches(txt, {S.q(anyp)}) AS INTEGER) AS has_any_unit FROM t")


@query("unit_features_part", ops=("TXF06",), sql=_unit_sql())
def unit_features_part(spark, sf_dir):
    lp = views.listing_part(spark, sf_dir)
    txt = F.concat(F.col("designation"), F.lit(" "), F.col("description"))
    return lp.select("row_id", *tf.unit_columns(txt))


HTML_TOKENS = ["<li>", "<p>", "</p>", "<a ", "<div", "<script", "&amp;", "<br"]


def _tokfreq_sql() -> str:
    text = f"' ' || {S.coalesce_text('designation')} || ' ' || {S.coalesce_text('description')}"
    cols = []
    for tok in HTML_TOKENS:
        cnt = f"CAST((length(txt) - length(replace(txt, {S.q(tok)}, ''))) / {len(tok)} AS BIGINT)"
        cols.append(f"{cnt} AS \"html_{tok}\"")
        cols.append(f"round(CASE WHEN length(txt) = 0 THEN 0.0 ELSE {cnt} / length(txt) END, {R}) AS \"norm_{tok}\"")
    return (S.with_(S.LISTING_PAGE, f"t AS (SELECT row_id, {text} AS txt FROM listing_page)")
            + f"SELECT row_id, {', '.join(cols)} FROM t")


@query("token_frequency_pages", ops=("TXF07", "SRC04"), sql=_tokfreq_sql())
def token_frequency_pages(spark, sf_dir):
    lp = views.listing_page(spark, sf_dir)
    counts = tf.token_frequency_columns(["designation", "description"], HTML_TOKENS, name_prefix="html")
    norms = tf.token_frequency_columns(["designation", "description"], HTML_TOKENS, normalize=True,
                                       name_prefix="norm", round_to=R)
    return lp.select("row_id", *counts, *norms)


# ---------------------------------------------------------------------------
# archive structural statistics on cleaned part listings (TXF04, PRJ08)
# ---------------------------------------------------------------------------

def _structural_sql() -> str:
    def cols(src, prefix):
        t = S.coalesce_text(src)
        return [(f"{prefix}_len_char", S.len_char(src)), (f"{prefix}_len_tokens", S.len_words(src)),
                (f"{prefix}_num_digits", S.count_re(t, r"\p{Nd}")),
                (f"{prefix}_num_units", S.count_re(t, r"(?i)\b\d+\s*(cm|mm|kg|g|ml|l|m)\b")),
                (f"{prefix}_num_mult_pattern", S.count_re(t, r"(?i)\bx\s*\d+\b|\b\d+\s*x\b"))]
    allc = cols("designation_cleaned", "designation_cleaned") + cols("description_cleaned", "description_cleaned")
    return (S.with_(S.LISTING_PART, f"c AS (SELECT row_id, {S.native_clean('designation')} AS designation_cleaned, "
                                   f"{S.native_clean('description')} AS description_cleaned FROM listing_part)")
            + "SELECT row_id, " + ", ".join(f"{e} AS {n}" for n, e in allc) + " FROM c")


@query("structural_features_part", ops=("TXF04", "PRJ08"), sql=_structural_sql())
def structural_features_part(spark, sf_dir):
    lp = views.listing_part(spark, sf_dir)
    c = lp.select("row_id", tx.native_final_cleaner(F.col("designation")).alias("designation_cleaned"),
                  tx.native_final_cleaner(F.col("description")).alias("description_cleaned"))
    feats = c.select("row_id", *tf.structural_columns(F.col("designation_cleaned"), "designation_cleaned"),
                     *tf.structural_columns(F.col("description_cleaned"), "description_cleaned"))
    return feats.select("row_id", *tf.meta_feature_columns(feats.columns))


def _granular_sql(keep_tags: bool, keep_punctuation: bool) -> str:
    e = S.coalesce_text("description")
    e = e if keep_tags else S.html_tags(e)
    return S.collapse_ws(e if keep_punctuation else S.punctuation(e))


_SWITCHES = {f"{'tags' if t else 'notags'}_{'punct' if p else 'nopunct'}": (t, p) for t in (False, True) for p in (False, True)}


@query("clean_granular_pages", ops=("CLN22", "CLN04", "CLN05", "CLN17"),
       sql=S.with_(S.LISTING_PAGE) + "SELECT row_id, " + ", ".join(f"{_granular_sql(*v)} AS {n}" for n, v in _SWITCHES.items()) + " FROM listing_page")
def clean_granular_pages(spark, sf_dir):
    """The ablation cleaner on raw pages under its tag and punctuation switches
    (entities left as they are, which SQL can state)."""
    lp = views.listing_page(spark, sf_dir)
    return lp.select("row_id", *(tx.granular_cleaner(F.col("description"), keep_html_tags=t, keep_punctuation=p, skip_unescape=True).alias(n) for n, (t, p) in _SWITCHES.items()))


_ACUTE = "\u0301"


@query("clean_unicode_doc", ops=("CLN03", "UDF03"),
       sql=S.with_(S.LISTING_DOC) + f"SELECT row_id, nfc_normalize(replace(replace(coalesce(description, ''), 'é', 'e{_ACUTE}'), 'a', 'a{_ACUTE}')) AS nfc FROM listing_doc")
def clean_unicode_doc(spark, sf_dir):
    """NFC over descriptions whose accents have been taken apart."""
    lst = views.listing_doc(spark, sf_dir)
    apart = F.replace(F.replace(F.coalesce("description", F.lit("")), F.lit("é"), F.lit("e" + _ACUTE)), F.lit("a"), F.lit("a" + _ACUTE))
    return lst.select("row_id", tx.normalize_unicode(apart).alias("nfc"))
