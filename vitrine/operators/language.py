"""Language indicators (TXF08) from character-trigram profiles.

A per-language trigram profile is aggregated from labelled rows; a text is
scored by ``sum(tf * log p(trigram | language))`` with add-one smoothing and
the best language wins (tie: language name).  Scoring is a join of the
documents' trigrams with the profile plus one per-language constant for unseen
trigrams; Spark broadcasts the profile when its measured size is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trigrams(df: DataFrame, text: Column) -> DataFrame:
    """``df``'s columns and ``term``: a row per trigram of the lower-cased text, one
    with a NULL ``term`` for a text without any."""
    base = df.select("*", F.split(F.lower(F.coalesce(text, F.lit(""))), "").alias("__c"))  # code points
    grams = F.transform(F.sequence(F.lit(0), F.size("__c") - 3), lambda i: F.concat(F.get("__c", i), F.get("__c", i + 1), F.get("__c", i + 2)))
    return base.select(*df.columns, F.explode_outer(F.when(F.size("__c") >= 3, grams)).alias("term"))


def fit_profiles(train: DataFrame, id_col: str, text: Column, lang_col: str):
    """-> (profile (lang, term, delta), defaults {lang: log p_unseen}, languages).

    Trigrams are counted per language right away, so a task sends each trigram of
    a language once.  A text counts for every row of its id, as the join by id
    would have it; rows without an id count for none."""
    import math
    from vitrine.sources.store import written
    rows = train.select(F.col(id_col).alias("__id"), text.alias("__t"), F.col(lang_col).alias("__lang")).where("__id IS NOT NULL")
    again = rows.groupBy(F.col("__id").alias("__again")).agg(F.collect_list(F.struct("__lang")).alias("__langs")).where(F.size("__langs") > 1)
    langs = F.coalesce("__langs", F.array(F.struct("__lang")))
    rows = rows.join(again, F.col("__id") == F.col("__again"), "left").select("__t", F.explode(langs).alias("__l")).select("__t", F.col("__l.__lang").alias("lang"))
    grams = trigrams(rows.select("lang", "__t"), F.col("__t")).where("term IS NOT NULL")
    counts = written(grams.groupBy("lang", "term").agg(F.count(F.lit(1)).alias("n")), "trigrams")
    totals = {r[0]: r[1] for r in counts.groupBy("lang").agg(F.sum("n")).collect()}  # one row per language
    vocab = counts.select("term").distinct().count()
    defaults = {lang: math.log(1.0 / (tot + vocab)) for lang, tot in totals.items()}
    tot_map = F.create_map(*[x for k, v in totals.items() for x in (F.lit(k), F.lit(float(v)))])
    def_map = F.create_map(*[x for k, v in defaults.items() for x in (F.lit(k), F.lit(v))])
    prof = counts.select("lang", "term",
                         (F.log((F.col("n") + 1.0) / (F.element_at(tot_map, F.col("lang")) + F.lit(float(vocab))))
                          - F.element_at(def_map, F.col("lang"))).alias("delta"))
    return prof, defaults, sorted(totals)


def detect(df: DataFrame, id_col: str, text: Column, prof: DataFrame, defaults: dict, langs: list[str]) -> DataFrame:
    """-> (id, lang) with the best-scoring language (tie: language name); the texts
    of an id count together.

    A trigram meets one profile row with every language's delta.  The trigrams of
    a text are adjacent, so its sums are complete before the shuffle."""
    deltas = prof.groupBy("term").agg(*(F.sum(F.when(F.col("lang") == lang, F.col("delta"))).alias(f"__d{k}") for k, lang in enumerate(langs)))
    known = F.when(F.col(id_col).isNotNull(), text)
    tc = trigrams(df.select(F.col(id_col).alias("__id"), known.alias("__t")), F.col("__t")).select("__id", "term")
    sums = tc.join(deltas, "term", "left").groupBy("__id").agg(F.count("term").alias("__n"), *(F.coalesce(F.sum(f"__d{k}"), F.lit(0.0)).alias(f"__s{k}") for k in range(len(langs))))
    score = [F.col("__n") * F.lit(defaults[lang]) + F.col(f"__s{k}") for k, lang in enumerate(langs)]
    best = F.array_min(F.array(*(F.struct((-s).alias("score"), F.lit(lang).alias("lang")) for s, lang in zip(score, langs, strict=True))))
    return sums.select(F.col("__id").alias(id_col), best["lang"].alias("lang"))


def one_hot(lang: Column) -> list[Column]:
    return [(lang == "fr").cast("int").alias("txt_fr"), (lang == "en").cast("int").alias("txt_en"),
            (~lang.isin("fr", "en")).cast("int").alias("txt_other")]
