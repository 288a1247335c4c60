"""Hand-made text features (TXF01-07, TXF09-10) as JVM-side column expressions.

Character classes are spelled out so Java matches Python's Unicode ``str``
semantics: Python ``\\w`` is letters, numbers and '_' (no combining marks),
Python whitespace also holds U+001C..U+001F.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions import fixed

# Python str.isspace() characters (Java (?U)\s plus the separators 1C-1F)
WS = r"[\s\x{1C}-\x{1F}]"
PY_DIGIT = r"[\p{Nd}\x{00B2}\x{00B3}\x{00B9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}]"
PUNCT = r"[^\p{L}\p{N}_\s\x{1C}-\x{1F}]"


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def words(c: Column) -> Column:
    """Python ``str.split()`` tokens."""
    return F.filter(F.split(_text(c), "(?U)" + WS + "+"), lambda t: t != "")


def len_char(c: Column) -> Column:
    return F.length(_text(c)).cast("long")


def len_words(c: Column) -> Column:
    return F.size(words(c)).cast("long")


def count_regex(c: Column, pattern: str) -> Column:
    return F.regexp_count(_text(c), F.lit(pattern)).cast("long")


def num_digits(c: Column) -> Column:
    """``\\d`` count (Unicode decimal digits)."""
    return count_regex(c, r"(?U)\d")


def num_punctuation(c: Column) -> Column:
    """``[^\\w\\s]`` count."""
    return count_regex(c, "(?U)" + PUNCT)


def _ratio(num: Column, c: Column) -> Column:
    n = F.length(_text(c))
    return F.when(n == 0, F.lit(0.0)).otherwise(num.cast("double") / n)


def uppercase_ratio(c: Column) -> Column:
    return _ratio(F.regexp_count(_text(c), F.lit(r"\p{Lu}")), c)


def digit_ratio(c: Column) -> Column:
    return _ratio(F.regexp_count(_text(c), F.lit(PY_DIGIT)), c)


FEATURE_KINDS = ["len_char", "len_words", "num_digits", "num_punctuation", "uppercase_ratio", "digit_ratio"]
_KIND_FUNCS = {"len_char": len_char, "len_words": len_words, "num_digits": num_digits,
               "num_punctuation": num_punctuation, "uppercase_ratio": uppercase_ratio,
               "digit_ratio": digit_ratio}


def feature_names(text_columns=("designation", "description")) -> list[str]:
    """TXF03 names, in order."""
    return [f"{col}_{k}" for col in text_columns for k in FEATURE_KINDS]


def text_feature_columns(text_columns=("designation", "description")) -> list[Column]:
    """TXF01-03: the 6 features per text column as named columns."""
    return [_KIND_FUNCS[k](F.col(col)).alias(f"{col}_{k}") for col in text_columns for k in FEATURE_KINDS]


def feature_column(name: str) -> Column:
    """One TXF03 feature by its name, e.g. ``description_len_words``."""
    for k in FEATURE_KINDS:
        if name.endswith("_" + k):
            return _KIND_FUNCS[k](F.col(name[: -len(k) - 1])).alias(name)
    raise ValueError(f"unknown feature {name!r}")


def add_text_features(df: DataFrame, text_columns=("designation", "description")) -> DataFrame:
    missing = [c for c in text_columns if c not in df.columns]
    if missing:
        raise ValueError(f"column(s) {missing} not found")
    return df.select("*", *text_feature_columns(text_columns))


# ---------------------------------------------------------------------------
# keyword families, units, token frequencies
# ---------------------------------------------------------------------------

def _java_literal(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$|?*+()[]{}\\" else ch for ch in s)


def keyword_columns(c: Column, keyword_dict=None) -> list[Column]:
    """TXF05: per family, count of non-overlapping matches of the alternation
    of its words (regex, case-sensitive, leftmost)."""
    kd = keyword_dict or fixed.KEYWORD_DICT
    return [count_regex(c, "|".join(words_)).alias(f"{fam}_keywords") for fam, words_ in kd.items()]


def keyword_feature_names(keyword_dict=None) -> list[str]:
    return [f"{fam}_keywords" for fam in (keyword_dict or fixed.KEYWORD_DICT)]


UNIT_ANY = "(?iU)" + "|".join(f"(?:{p})" for p in fixed.UNIT_PATTERNS.values())


def unit_columns(c: Column) -> list[Column]:
    """TXF06: digit count, numbering flag, any-unit flag."""
    t = _text(c)
    return [
        F.regexp_count(t, F.lit(PY_DIGIT)).cast("long").alias("nb_digits_text"),
        t.rlike(r"(?U)n° ?(?:[0-9])+").cast("int").alias("contains_numerotation"),
        t.rlike(UNIT_ANY).cast("int").alias("has_any_unit"),
    ]


def token_frequency_columns(text_cols: list[str], tokens: list[str], normalize: bool = False,
                            literal: bool = True, name_prefix: str | None = None,
                            round_to: int | None = None) -> list[Column]:
    """TXF07: occurrences of each token in ' ' + col1 + ' ' + col2 ...

    ``literal=True`` counts the token as plain text; ``literal=False`` treats it
    as a regular expression (the reference's behaviour, where a bracketed
    token such as ``[petite_longueur]`` is a character class).
    """
    text = F.concat(*[F.concat(F.lit(" "), _text(F.col(c))) for c in text_cols])
    prefix = f"{name_prefix}_" if name_prefix else ""
    out = []
    for tok in tokens:
        pat = _java_literal(tok) if literal else tok
        cnt = F.regexp_count(text, F.lit(pat))
        val = (F.when(F.length(text) == 0, F.lit(0.0)).otherwise(cnt / F.length(text))
               if normalize else cnt.cast("long"))
        if round_to is not None and normalize:
            val = F.round(val, round_to)
        out.append(val.alias(prefix + tok))
    return out


# ---------------------------------------------------------------------------
# scaling and block weights
# ---------------------------------------------------------------------------

def fit_standard_scaler(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """TXF09: per column (mean, population std; zero variance -> 1).

    One aggregate of 2 numbers per column — the fitted model is bounded by the
    number of features, never by the rows.
    """
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    stats = {}
    for c in cols:
        s = row[f"s_{c}"]
        stats[c] = (float(row[f"m_{c}"] or 0.0), float(s) if s and s > 0 else 1.0)
    return stats


def apply_standard_scaler(stats: dict[str, tuple[float, float]], with_mean: bool = True,
                          suffix: str = "") -> list[Column]:
    out = []
    for c, (m, s) in stats.items():
        x = F.col(c).cast("double")
        out.append(((x - F.lit(m)) / F.lit(s) if with_mean else x / F.lit(s)).alias(c + suffix))
    return out


def weighted(c: Column, weight: float) -> Column:
    """TXF10: multiply a block by a weight."""
    return c * F.lit(float(weight))


# ---------------------------------------------------------------------------
# archive structural statistics (TXF04) and meta-column discovery (PRJ08)
# ---------------------------------------------------------------------------

UNIT_PATTERN = r"(?iU)\b\d+\s*(cm|mm|kg|g|ml|l|m)\b"
MULT_PATTERN = r"(?iU)\bx\s*\d+\b|\b\d+\s*x\b"


def structural_columns(c: Column, prefix: str) -> list[Column]:
    """TXF04: len_char, len_tokens, num_digits, num_units, num_mult_pattern."""
    return [len_char(c).alias(f"{prefix}_len_char"), len_words(c).alias(f"{prefix}_len_tokens"),
            count_regex(c, r"(?U)\d").alias(f"{prefix}_num_digits"),
            count_regex(c, UNIT_PATTERN).alias(f"{prefix}_num_units"),
            count_regex(c, MULT_PATTERN).alias(f"{prefix}_num_mult_pattern")]


def meta_feature_columns(columns: list[str], prefixes=("designation_cleaned_", "description_cleaned_")) -> list[str]:
    """PRJ08: feature columns discovered by prefix, sorted."""
    return sorted(c for c in columns if any(c.startswith(p) for p in prefixes))
