"""Quality cascade: signals against plain Python, order, edge cases.  (The
whole-table query is held against its SQL in the oracle test.)"""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from vitrine.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {i + k for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit)}


def texts():
    rng = random.Random(8)
    out = [None, "", " \n\t", "é" * 50, "a b c d e f g h " * 5, "line one\nline one\n\n line one\nline two", "x" * 100_000, "\n\n\nword"]
    for _ in range(120):
        out.append("".join(rng.choice(["a ", "b ", "ü", "\n", "c d e ", "#", "\t", "\x0b", "ab ", "| "]) for _ in range(rng.choice([1, 10, 200]))))
    return out + out[-3:]


def test_signals_equal_plain_python():
    rows = texts()
    t = q.Texts(q.tb.string_column(pa.array(rows, pa.string())))
    for name, signal in q.SIGNALS.items():
        assert signal(t).tolist() == [brute(x)[name] for x in rows], name


def test_order_never_changes_the_verdict():
    col = q.tb.string_column(pa.array(texts(), pa.string()))
    expected = None
    for seed in range(5):
        order = list(q.RULES)
        random.Random(seed).shuffle(order)
        kept, _ = q.judge(col, order)
        expected = kept if expected is None else expected
        assert np.array_equal(kept, expected)


def test_rejected_documents_skip_later_rules(monkeypatch):
    seen = []
    original = q.SIGNALS["n_repeat_words"]
    monkeypatch.setitem(q.SIGNALS, "n_repeat_words", lambda t: seen.append(len(t.col)) or original(t))
    col = pa.array(["short"] * 90 + [" ".join(f"w{k}" for k in range(30))] * 10, pa.large_string())
    kept, _ = q.judge(col, list(q.BASE))
    assert kept.sum() == 10 and seen == [10]


def test_plan_prefers_rejections_per_cost(spark):
    rows = [(" ".join(f"word{k}" for k in range(400)),)] * 50 + [("few words",)] * 150
    order = q.plan_cascade(spark.createDataFrame(rows, "text string"), fraction=1.0)
    assert sorted(r.name for r in order) == sorted(r.name for r in q.RULES) and order[0].name == "too_few_words"


def test_cascade_columns_and_edges(spark):
    df = spark.createDataFrame([(1, None, True, 3), (1, None, True, 3), (2, " ".join(f"word{k}" for k in range(30)), None, 4)],
                               "doc_id long, text string, kept boolean, n_words int")
    out = q.cascade(df, keep_signals=("n_words",))
    assert out.columns == ["doc_id", "text", "n_words", "kept"]
    assert sorted((r["doc_id"], r["n_words"], r["kept"]) for r in out.collect()) == [(1, 0, False), (1, 0, False), (2, 30, True)]
    dropped = q.cascade(df, drop=True)
    assert dropped.columns == df.columns and [tuple(r)[2:] for r in dropped.collect()] == [(None, 4)]
    assert q.cascade(df.where("false"), keep_signals=("n_words",)).collect() == []


@pytest.mark.parametrize("rule", q.RULES)
def test_sql_form_of_a_rule(spark, rule):
    rows = [x for x in texts() if x]
    values = [brute(x) for x in rows]
    df = spark.createDataFrame([tuple(v.values()) for v in values], ", ".join(f"{c} long" for c in values[0]))
    got = [r[0] for r in df.selectExpr(rule.sql()).collect()]
    assert got == rule.rejects({c: np.array([v[c] for v in values]) for c in values[0]}).tolist()
