"""The corpus pipeline, stage by stage, against plain Python on each stage's
own input; and with NULLs, empty texts and an empty table."""

import collections
import re

import pytest

import corpus_pipeline as cp
from conftest import SF_SMALL
from test_decontamination import brute as contamination
from test_mixing_sharding import water_fill
from test_near_dedup import brute as components
from test_quality import brute as signals
from vitrine.llm import sharding

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stages(spark, docs, sf_dir):
    """(input rows, output rows) of each stage."""
    out = {}
    for name, stage in cp.STAGES:
        result = stage(spark, docs, sf_dir)
        before, after = docs.collect(), result.collect()
        out[name] = (before, after)
        docs = spark.createDataFrame(after, result.schema)
    return out


def verify(seen, items, n_shards=cp.SHARDS):
    before, after = seen["quality_rules"]
    kept = []
    for r in before:
        v = signals(r["text"])
        if not (v["n_words"] < 20 or 100 * v["n_repeat_words"] > 30 * v["n_words"] or 2 * v["n_words"] > v["word_chars"] or v["word_chars"] > 20 * v["n_words"]
                or 10 * v["n_symbols"] > v["n_words"] or 100 * v["n_dup_lines"] > 30 * v["n_lines"]):
            kept.append(r)
    assert collections.Counter(after) == collections.Counter(kept)

    before, after = seen["near_dedup"]
    # every row is a document of its own; the first by (id, NULL last) of a component stays
    order = sorted(range(len(before)), key=lambda k: (before[k]["doc_id"] is None, before[k]["doc_id"] or 0))
    groups = {}
    for k, _, component, _ in components([(n, before[k]["text"]) for n, k in enumerate(order)], cp.SIMILARITY):
        groups.setdefault(component, []).append(before[order[k]])
    assert len(after) == len(groups) and set(after) <= set(before)
    for rows in groups.values():
        first = min((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)
        assert sum((r["doc_id"] is None, r["doc_id"] or 0) == first and r in rows for r in after) >= 1

    before, after = seen["decontamination"]
    assert len(before) == len(after)
    left = collections.Counter(after)
    for r in before:
        n, hit, _ = contamination(r["text"], items)
        if not hit:
            assert left[r] > 0
            left[r] -= 1
        else:
            own = next(x for x in left if left[x] and x["doc_id"] == r["doc_id"] and contamination(x["text"], items)[:2] == (n - hit, 0))
            assert own["n_chars"] == len(own["text"])
            left[own] -= 1
    assert not +left

    before, after = seen["source_mixing"]
    sizes = collections.Counter()
    for r in before:
        sizes[r["source"]] += len(SPACE_WORD.findall(r["text"] or ""))
    target = water_fill(sizes, (1, 2, 3), 3) if sizes else {}
    copies, taken = collections.Counter(after), collections.Counter()
    assert set(copies) <= set(before) and all(n <= 3 * collections.Counter(before)[r] for r, n in copies.items())
    for r in after:
        taken[r["source"]] += len(SPACE_WORD.findall(r["text"] or ""))
    longest = max((len(SPACE_WORD.findall(r["text"] or "")) for r in before), default=0)
    for s, goal in target.items():
        assert abs(taken[s] - goal) <= max(longest, 0.02 * goal)

    before, after = seen["sharding"]
    assert collections.Counter(tuple(r)[:5] for r in after) == collections.Counter(map(tuple, before))
    n = len(before)
    want = sorted((p % n_shards, p // n_shards) for p in (sharding.permute_number(k, n, 1) for k in range(n)))
    assert sorted((r["shard"], r["slot"]) for r in after) == want


def test_stages_on_the_given_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    seen = stages(spark, docs, SF_SMALL)
    verify(seen, items)
    assert all([f for f in seen[name][1][0].__fields__] == COLUMNS for name, _ in cp.STAGES[:-1])


@pytest.fixture
def odd_tables(spark, tmp_path):
    item = " ".join(f"item{k}" for k in range(14))
    body = " ".join(f"word{k} text" for k in range(40))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, body, None, None, None), (4, body, "en", "a", 1), (None, body, "en", "a", 1),
            (None, body + " nameless", "en", None, None), (5, "\n".join(f"other{k} line" for k in range(30)) + " " + item, "de", "b", 9),
            (6, "x" * 50_000 + " y" * 30, "de", "b", 2), (7, " ".join(f"long{k}" for k in range(30_000)), "fr", "c", 3),
            (7, " ".join(f"long{k}" for k in range(30_000)), "fr", "c", 3), (8, item + " " + item.upper(), "en", "a", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_odd_rows(spark, odd_tables):
    docs = spark.read.parquet(f"{odd_tables}/documents.parquet")
    seen = stages(spark, docs, odd_tables)
    kept = {r["doc_id"] for r in seen["near_dedup"][1]}
    assert {3, 5, 7} <= kept and 4 not in kept and 1 not in kept and 2 not in kept
    assert sum(r["doc_id"] == 7 for r in seen["near_dedup"][1]) == 1
    assert all("item3" not in r["text"] for r in seen["decontamination"][1])
    assert len(seen["sharding"][1]) == len(seen["source_mixing"][1])


def test_empty_documents(spark, odd_tables):
    empty = spark.read.parquet(f"{odd_tables}/documents.parquet").where("false")
    for _, (_, after) in stages(spark, empty, odd_tables).items():
        assert after == []


def test_run_writes_every_stage(spark, odd_tables):
    out = cp.run(spark, odd_tables)
    assert out.columns == [*COLUMNS, "shard", "slot"] and out.count() > 0


def test_shared_ids_and_clashing_columns(spark, odd_tables):
    """Different texts under one id, or none, all go through; columns named like
    those that the operators add come out as they went in."""
    def text(k):
        return " ".join(f"word{k}x{i} text" for i in range(30))
    item = " ".join(f"item{k}" for k in range(14))
    extra = {"size": "long", "target": "string", "rate": "double", "copies": "int", "taken": "long", "source_size": "long", "n_words": "long", "spans": "array<string>",
             "items": "string", "kept": "boolean", "component_id": "long", "n_shingles": "long", "shard": "string", "slot": "string", "__row": "int", "__hash": "int"}
    rows = [(i, text(k) + (" " + item if k == 2 else ""), "en", s, k) for k, (i, s) in enumerate([(1, "a"), (1, "a"), (1, "b"), (None, "b"), (None, None), (2, "a")])]
    rows.append((3, text(0), "en", "a", 0))
    values = (-7, "t", 0.5, 9, -1, -2, -3, ["keep"], "i", False, -4, -5, "s", "l", 6, 8)
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} {t}" for c, t in extra.items())
    docs = spark.createDataFrame([(*r, *values) for r in rows], schema)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, odd_tables)
        got = out.collect()
        if name != "sharding":
            assert out.columns == docs.columns
            assert all(tuple(r)[5:] == values for r in got)
        else:
            assert out.columns == [*COLUMNS, *(f"input_{c}" if c in ("shard", "slot") else c for c in extra), "shard", "slot"]
            assert all(tuple(r)[5:-2] == values for r in got)
        if name in ("quality_rules", "near_dedup", "decontamination"):
            want = 7 if name == "quality_rules" else 6  # the copy under id 3 goes
            assert len(got) == want and len({r["text"] for r in got}) == 6
        docs = spark.createDataFrame(got, out.schema)


def test_text_alike_under_one_id_stays_once(spark, odd_tables):
    body = " ".join(f"same{k} text" for k in range(30))
    docs = spark.createDataFrame([(1, body, "en", "a", 1), (1, body, "de", "b", 2), (None, body, "fr", "c", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = cp.near_dedup(spark, docs, odd_tables).collect()
    assert row["doc_id"] == 1
