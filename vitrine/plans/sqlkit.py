"""DuckDB SQL fragments for the oracle statements.

DuckDB uses RE2: no lookaround and ASCII ``\\b``/``\\s``/``\\d``.  The
fragments below restate each rule with explicit Unicode classes and, where a
rule needs lookaround, with an equivalent marker rewrite.
"""

from __future__ import annotations

from vitrine.functions import fixed

CLASSES_SQL = "[" + ", ".join(str(c) for c in fixed.CANONICAL_CLASSES) + "]"

# Python whitespace / digit / punctuation classes for RE2
WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_WS = WS.replace("[", "[^", 1)
PY_DIGIT = r"[\p{Nd}\x{B2}\x{B3}\x{B9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}]"
PUNCT = r"[^\pL\pN_\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_MARK = "\ue000"  # private-use marker, absent from the text


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


LISTING_DOC = f"""listing_doc AS (
  SELECT doc_id AS row_id,
    CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END AS designation,
    CASE WHEN strpos(text, chr(10)) = 0 OR doc_id % 3 = 0 OR substr(text, strpos(text, chr(10)) + 1) = '' THEN NULL
         ELSE substr(text, strpos(text, chr(10)) + 1) END AS description,
    doc_id * 10 + 1 AS productid,
    doc_id * 10 + 2 AS imageid,
    source AS category,
    list_extract({CLASSES_SQL}, (coalesce(TRY_CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER), 0) % 27) + 1) AS prdtypecode,
    lang
  FROM documents)"""

LISTING_PAGE = f"""listing_page AS (
  SELECT page_id AS row_id,
    regexp_extract(html, '<title>(.*?)</title>', 1) AS designation,
    html AS description,
    regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1) AS category,
    list_extract({CLASSES_SQL}, (page_id % 5) % 27 + 1) AS prdtypecode
  FROM pages)"""

PART_DESCRIPTION = """concat_ws(', ',
      CAST(p_size AS VARCHAR) || ' x ' || CAST(p_size + 2 AS VARCHAR) || ' x 3 cm',
      CAST((p_partkey % 40) * 50 AS VARCHAR) || ' g',
      CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) || ' euros',
      CAST(p_size % 6 AS VARCHAR) || '-' || CAST(p_size % 6 + 3 AS VARCHAR) || ' ans',
      CAST(1890 + p_partkey % 140 AS VARCHAR),
      CAST(4 * (p_partkey % 32 + 1) AS VARCHAR) || ' Go',
      CAST(p_partkey % 101 AS VARCHAR) || ' %',
      'L x H x L',
      '24 h / 24')"""

LISTING_PART = f"""listing_part AS (
  SELECT p_partkey AS row_id, p_name AS designation,
    {PART_DESCRIPTION} AS description,
    p_type AS category,
    list_extract({CLASSES_SQL}, ((ascii(p_type) + length(p_type)) % 27) + 1) AS prdtypecode
  FROM part)"""


def category_dim_sql() -> str:
    group_of = {code: g for g, codes in fixed.CATEGORY_GROUPS.items() for code in codes}
    rows = ", ".join(
        f"({code}, {q(fixed.CATEGORY_NAMES[code])}, {q(fixed.CATEGORY_SHORT_NAMES[code])}, {q(group_of[code])}, {i})"
        for i, code in enumerate(fixed.CANONICAL_CLASSES))
    return f"category_dim AS (SELECT * FROM (VALUES {rows}) AS t(code, name, short_name, grp, class_idx))"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------------------
# cleaning rules
# ---------------------------------------------------------------------------

def coalesce_text(e: str) -> str:
    return f"coalesce(CAST({e} AS VARCHAR), '')"


def html_tags(e: str) -> str:
    return f"regexp_replace({e}, '<[^>]+>', ' ', 'g')"


def lower(e: str) -> str:
    return f"lower({e})"


def collapse_ws(e: str) -> str:
    return f"trim(regexp_replace({e}, '{WS}+', ' ', 'g'))"


def punctuation(e: str) -> str:
    """(?<!\\d)\\.(?!\\d) and isolated - : · / + without lookaround."""
    m = _MARK
    s = f"regexp_replace({e}, '(\\p{{Nd}})\\.', '\\1{m}', 'g')"
    s = f"regexp_replace({s}, '\\.(\\p{{Nd}})', '{m}\\1', 'g')"
    s = f"replace(replace({s}, '.', ' '), '{m}', '.')"
    for ch in ["-", ":", "·", "/", "\\+"]:
        pat = f"(^|{WS}){ch}({WS}|$)"
        for _ in range(2):  # a second pass catches neighbours sharing a space
            s = f"regexp_replace({s}, '{pat}', '\\1 \\2', 'g')"
    return f"replace({s}, '////', ' ')"


def native_clean(e: str) -> str:
    """tags -> lower -> punctuation -> whitespace (JVM-only part of CLN18)."""
    return collapse_ws(punctuation(lower(html_tags(coalesce_text(e)))))


# ---------------------------------------------------------------------------
# features
# ---------------------------------------------------------------------------

def count_re(e: str, pattern: str) -> str:
    return f"CAST(len(regexp_extract_all({e}, '{pattern}')) AS BIGINT)"


def len_char(e: str) -> str:
    return f"CAST(length({coalesce_text(e)}) AS BIGINT)"


def len_words(e: str) -> str:
    return (f"CAST(len(list_filter(regexp_split_to_array({coalesce_text(e)}, '{WS}+'), "
            f"lambda t: t <> '')) AS BIGINT)")


def ratio(num: str, e: str) -> str:
    t = coalesce_text(e)
    return f"CASE WHEN length({t}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / length({t}) END"


def text_features(col: str) -> list[tuple[str, str]]:
    t = coalesce_text(col)
    return [
        (f"{col}_len_char", len_char(col)),
        (f"{col}_len_words", len_words(col)),
        (f"{col}_num_digits", count_re(t, r"\p{Nd}")),
        (f"{col}_num_punctuation", count_re(t, PUNCT)),
        (f"{col}_uppercase_ratio", ratio(count_re(t, r"\p{Lu}"), col)),
        (f"{col}_digit_ratio", ratio(count_re(t, PY_DIGIT), col)),
    ]
