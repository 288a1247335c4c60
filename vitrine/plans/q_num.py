"""Numeric-token queries (NUM01-11, TXF12-13)."""

from __future__ import annotations

import itertools
import re

from pyspark.sql import functions as F

from vitrine.functions import features as tf
from vitrine.functions import fixed
from vitrine.functions import numeric as N
from vitrine.plans import sqlkit as S
from vitrine.plans.registry import query
from vitrine.sources import views
from vitrine.sources.store import written

R = 6


def _dbl(v: float) -> str:
    return f"CAST('{repr(float(v))}' AS DOUBLE)"


def _label_sql(v: str, measure: str) -> str:
    th, labels = fixed.LABEL_BINS[measure]
    parts = []
    for i, lab in enumerate(labels):
        cond = f"{v} >= {_dbl(th[i])}"
        if th[i + 1] != float("inf"):
            cond += f" AND {v} < {_dbl(th[i + 1])}"
        parts.append(f"WHEN {cond} THEN {S.q(lab)}")
    return f"CASE {' '.join(parts)} ELSE {S.q(measure + 'inconnu')} END"


def _norm_sql(u: str) -> str:
    parts = " ".join(f"WHEN regexp_full_match(lower({u}), {S.q(p)}) THEN {S.q(n)}" for p, n in fixed.UNIT_NORMALIZATION)
    return f"CASE {parts} ELSE lower({u}) END"


def _factor_sql(unit: str) -> str:
    parts = " ".join(f"WHEN {S.q(k)} THEN {_dbl(v)}" for k, v in fixed.CONVERSION.items())
    return f"coalesce(CASE {unit} {parts} END, {_dbl(1)})"


def _values_sql(pattern: str, unit_pos, interval: bool, i: str) -> str:
    """List of the base values of match ``i`` (columns g1, g2, ...)."""
    numbers = list(range(re.compile(pattern).groups))
    factor = _dbl(1) if unit_pos is None else _factor_sql(_norm_sql(f"g{numbers.pop(unit_pos) + 1}[{i}]"))
    present = "list_filter([" + ", ".join(f"g{k + 1}[{i}]" for k in numbers) + "], lambda v: v <> '')"
    values = f"list_transform({present}, lambda v: CAST(replace(v, ',', '.') AS DOUBLE) * {factor})"
    return values if interval else f"[list_reduce(list_prepend({_dbl(1)}, {values}), lambda a, b: a * b)]"


def _groups_sql(text: str, pattern: str) -> str:
    return ", ".join(f"regexp_extract_all({text}, {S.q('(?i)' + pattern)}, {k + 1}) AS g{k + 1}" for k in range(re.compile(pattern).groups))


def _extract_sql() -> str:
    selects = []
    for col, (no, (measure, pattern, unit_pos, interval)) in itertools.product(("designation", "description"), enumerate(fixed.NUMERIC_PATTERNS)):
        if measure not in fixed.LABEL_BINS:
            continue
        selects.append(
            f"SELECT row_id, '{col}' AS part, {no} AS pattern_no, '{measure}' AS measure, match_no, CAST(b - 1 AS BIGINT) AS bound_no, vals[b] AS value_base "
            f"FROM (SELECT row_id, CAST(i - 1 AS BIGINT) AS match_no, {_values_sql(pattern, unit_pos, interval, 'i')} AS vals "
            f"FROM (SELECT row_id, {_groups_sql(col, pattern)} FROM listing_part), range(1, len(g1) + 1) r(i)), range(1, len(vals) + 1) s(b)")
    label = "CASE " + " ".join(f"WHEN measure = '{m}' THEN {_label_sql('value_base', m)}" for m in fixed.LABEL_BINS) + " END"
    return (S.with_(S.LISTING_PART, f"x AS ({' UNION ALL '.join(selects)})")
            + f"SELECT row_id, part, pattern_no, measure, match_no, bound_no, round(value_base, {R}) AS value_base, {label} AS label FROM x")


def _rewrite_sql(source: str, col: str, mode: str, prefix: str) -> tuple[list[str], str]:
    """One CTE per pass over ``source`` (row_id, ``col``); (CTEs, last name)."""
    ctes = [f"{prefix} AS (SELECT row_id, translate({col}, '²³', '23') AS t FROM {source})"]
    last = prefix
    for no, (measure, pattern, unit_pos, interval) in enumerate(fixed.NUMERIC_PATTERNS):
        if measure not in fixed.NUMERIC_GROUPS[mode]:
            continue
        regex, name = S.q("(?i)" + pattern), f"{prefix}{no}"
        if measure not in fixed.LABEL_BINS:
            body = f"SELECT row_id, regexp_replace(t, {regex}, {S.q(N.decor(measure))}, 'g') AS t FROM {last}"
        else:
            tokens = f"list_transform({_values_sql(pattern, unit_pos, interval, 'i')}, lambda v: '[' || replace({_label_sql('v', measure)}, ' ', '_') || ']')"
            token = f"list_transform([{tokens}], lambda l: CASE WHEN len(l) > 1 THEN 'entre ' || l[1] || ' et ' || l[2] ELSE l[1] END)[1]"
            joined = f"array_to_string(flatten(list_transform(range(1, len(g1) + 1), lambda i: [pieces[i], {token}])), '') || pieces[-1]"
            body = (f"SELECT row_id, CASE WHEN len(g1) > 0 THEN {joined} ELSE t END AS t FROM "
                    f"(SELECT row_id, t, string_split_regex(t, {regex}) AS pieces, {_groups_sql('t', pattern)} FROM {last})")
        ctes.append(f"{name} AS ({body})")
        last = name
    return ctes, last


def _tokens_sql() -> str:
    titles, title = _rewrite_sql("listing_part", "designation", "full", "title")
    descs, desc = _rewrite_sql("listing_part", "description", "full", "descr")
    return (S.with_(S.LISTING_PART, *titles, *descs)
            + f"SELECT row_id, '[TITRE] ' || a.t || ' [DESC] ' || b.t AS text_num FROM {title} a JOIN {desc} b USING (row_id)")


@query("numeric_measures_part", ops=("NUM01", "NUM02", "NUM03", "NUM04", "NUM05", "NUM11"), sql=_extract_sql())
def numeric_measures_part(spark, sf_dir):
    """Measures of title and description."""
    lp = views.listing_part(spark, sf_dir).select("row_id", "designation", "description")
    title, desc = (N.extract_measures(lp, "row_id", c).withColumn("part", F.lit(c)) for c in ("designation", "description"))
    x = title.unionByName(desc)
    return x.select("row_id", "part", "pattern_no", "measure", "match_no", "bound_no", F.round("value_base", R).alias("value_base"), "label")


@query("numeric_tokens_part", ops=("NUM05", "NUM06", "NUM07", "NUM08", "NUM09"), sql=_tokens_sql())
def numeric_tokens_part(spark, sf_dir):
    """Title and description rewritten (mode 'full'), merged as [TITRE] t [DESC] d."""
    lp = views.listing_part(spark, sf_dir).select("row_id", "designation", "description")
    return N.rewrite_title_description(lp, "designation", "description", "full").select("row_id", "text_num")


def _token_counts_sql() -> str:
    """CTEs ending in (row_id, measure, token, n) over the rewritten title and description."""
    titles, title = _rewrite_sql("listing_part", "designation", "full", "title")
    descs, desc = _rewrite_sql("listing_part", "description", "full", "descr")
    vocabulary = ", ".join(f"({S.q(m)}, {S.q(tok)})" for m, tok in N.token_vocabulary())
    n = "CAST((length(t) - length(replace(t, token, ''))) / length(token) AS BIGINT)"
    return S.with_(S.LISTING_PART, *titles, *descs, f"both_parts AS (SELECT row_id, a.t || ' ' || b.t AS t FROM {title} a JOIN {desc} b USING (row_id))",
                   f"n AS (SELECT row_id, measure, token, {n} AS n FROM both_parts, (VALUES {vocabulary}) AS v(measure, token))")


def _token_counts(spark, sf_dir):
    """(row_id, a count per token of the vocabulary) and the vocabulary."""
    lp = views.listing_part(spark, sf_dir).select("row_id", "designation", "description")
    vocab = N.token_vocabulary()
    both = N.rewrite_title_description(lp, "designation", "description", "full", merge=False)
    counts = both.select("row_id", F.concat_ws(" ", "designation", "description").alias("t"))
    return counts.select("row_id", *tf.token_frequency_columns(["t"], [tok for _, tok in vocab], literal=True)), vocab


@query("numeric_token_counts", ops=("NUM10", "TXF07", "TXF09"),
       sql=_token_counts_sql() + f"SELECT measure, token, CAST(sum(n) AS BIGINT) AS total, round(avg(n), {R}) AS mean, round(stddev_pop(n), {R}) AS std "
       "FROM n GROUP BY measure, token")
def numeric_token_counts(spark, sf_dir):
    """Token vocabulary with totals over the rewritten titles and descriptions, plus
    the per-row counts' mean and population std (what the scaler subtracts and
    divides by)."""
    counts, vocab = _token_counts(spark, sf_dir)
    sums = counts.agg(*[f(F.col(f"`{tok}`")).alias(f"{name}{k}") for k, (_, tok) in enumerate(vocab)
                        for name, f in (("s", F.sum), ("m", F.avg), ("d", F.stddev_pop))])
    rows = F.array(*[F.struct(F.lit(m).alias("measure"), F.lit(tok).alias("token"), F.coalesce(F.col(f"s{k}"), F.lit(0)).cast("long").alias("total"),
                              F.round(f"m{k}", R).alias("mean"), F.round(f"d{k}", R).alias("std")) for k, (m, tok) in enumerate(vocab)])
    return sums.select(F.explode(rows).alias("v")).select("v.*")


@query("numeric_token_features", ops=("TXF13", "NUM09", "TXF09"),
       sql=_token_counts_sql() + f"SELECT row_id, token, n, round((n - m) / CASE WHEN s > 0 THEN s ELSE 1 END, {R}) AS scaled FROM "
       "(SELECT *, avg(n) OVER (PARTITION BY token) AS m, stddev_pop(n) OVER (PARTITION BY token) AS s FROM n) WHERE n > 0")
def numeric_token_features(spark, sf_dir):
    """Scaled token counts as features: the tokens a listing holds (all others
    have the value (0 - mean) / std of ``numeric_token_counts``)."""
    counts, vocab = _token_counts(spark, sf_dir)
    counts = written(counts.toDF("row_id", *(f"t{k}" for k in range(len(vocab)))), "token-counts")  # fitted and scaled: the passes run once
    names = counts.columns[1:]
    stats = tf.fit_standard_scaler(counts, names)
    cells = F.array(*(F.struct(F.lit(tok).alias("token"), F.col(c).alias("n"), F.round((F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1]), R).alias("scaled"))
                      for c, (_, tok) in zip(names, vocab, strict=True)))
    return counts.select("row_id", F.explode(F.filter(cells, lambda e: e["n"] > 0)).alias("e")).select("row_id", "e.*")
