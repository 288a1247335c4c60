"""FM-index decontamination against direct matching, and its edge cases."""

import random
import re

import numpy as np
import pyarrow as pa

from vitrine.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, width=10):
    w = words(text)
    hit, found = set(), set()
    for item, body in items:
        p = words(body)
        for k in range(max(len(p) - width + 1, min(1, len(p)))):
            phrase = p[k:k + width]
            for i in range(len(w) - len(phrase) + 1):
                if w[i:i + len(phrase)] == phrase:
                    hit.update(range(i, i + len(phrase)))
                    found.add(item)
    return len(w), len(hit), sorted(str(x) for x in found if x is not None)


def example(seed=2):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "dé", "e1", "Ff", "g"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 4, 9, 10, 11, 25])))) for i in range(30)]
    items.append((7, items[7][1]))
    items.append((None, "only this nameless item"))
    docs = []
    for i in range(60):
        parts = [" ".join(rng.choice(vocabulary + ["zz"]) for _ in range(rng.choice([0, 5, 40, 200])))]
        parts += [rng.choice(items)[1].upper(), "only this; nameless ITEM"][:rng.choice([0, 1, 2])]
        rng.shuffle(parts)
        docs.append((i, "\n".join(parts)))
    docs += [(60, None), (61, ""), (62, "!!"), (63, items[3][1]), (63, items[3][1])]
    return docs, items


def check(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in dc.find_contamination(d, b).collect():
        hits = sum(s["last_word"] - s["first_word"] + 1 for s in r["spans"])
        got.setdefault(r["doc_id"], []).append((r["n_words"], hits, r["items"]))
    for i, text in docs:
        assert got[i][0] == brute(text, items), (i, text)
    assert sum(map(len, got.values())) == len(docs)


def test_equals_direct_matching(spark):
    check(spark, *example())


def test_several_passes_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(dc, "PASS_BYTES", 120)
    check(spark, *example(seed=4))


def test_index_pieces_overlap():
    docs, items = example(seed=6)
    phrases = dc.Phrases([(str(i), t) for i, t in items], 10)
    symbols = np.array([1, 2, 3, 1, 2, 3, 1, 2, 0, 3, 1, 2, 3] * 40, np.int64)
    phrases.by_length = {2: (np.array([[1, 2], [3, 1]]), [[0], [1]]), 3: (np.array([[1, 2, 3]]), [[2]])}
    phrases.longest, phrases.bits = 3, 3
    at = np.array([0, 100, 100, 300])
    seen = [{(n, k, int(w)) for n, k, first in dc.occurrences(symbols, at, phrases, limit) for w in first} for limit in (1 << 20, 16, 50)]
    expected = set()
    border = set(at.tolist())
    for length, (matrix, _) in phrases.by_length.items():
        for k, p in enumerate(matrix.tolist()):
            for i in range(len(symbols) - length + 1):
                if symbols[i:i + length].tolist() == p and not border & set(range(i + 1, i + length)):
                    expected.add((length, k, i))
    assert seen[0] == seen[1] == seen[2] == expected


def test_suffix_order_and_locate():
    rng = np.random.default_rng(5)
    for sigma in (2, 3, 40):
        body = rng.integers(0, sigma, 3000)
        body[500:1500] = 1  # one long run ties deep
        text = np.concatenate([[0], body, [0]]).astype(np.int64)
        bits = int(sigma).bit_length()
        order = dc.suffix_order(text, bits)
        keys = []
        for p in range(len(text)):
            end = p + int(np.argmax(text[p:] == 0))
            keys.append((text[p:end].tolist(), end))
        # a separator sorts before every symbol, earlier ones first
        expected = sorted(range(len(text)), key=lambda p: (*[(s, 0) for s in keys[p][0]], (0, keys[p][1])))
        assert order.tolist() == expected
        index = dc.FMIndex(text, bits)
        assert np.array_equal(index.locate(np.arange(len(text))), order)


def test_cleaned_text(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    docs = spark.createDataFrame([(1, f"Before, {item.upper()}! after", 5), (2, item, 5), (3, "clean é", 5)], "doc_id long, text string, items int")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    got = {r["doc_id"]: r for r in dc.find_contamination(docs, bench, clean=True).collect()}
    assert got[1]["text"] == "Before, \n! after" and got[2]["text"] == "" and got[3]["text"] == "clean é"
    assert got[1]["items"] == ["9"] and got[3]["items"] == []


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.find_contamination(docs, bench).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r["n_words"], r["spans"]) for r in dc.find_contamination(one, bench).collect()] == [(2, [])]


def test_long_text_is_searched_to_its_end():
    item = " ".join(f"k{i}" for i in range(12))
    phrases = dc.Phrases([("1", item)], 10)
    text = "x y " * 3_000_000 + item
    n, spans, items, _ = dc.scan_texts(pa.array([text], pa.large_string()), phrases)
    assert n[0] == 6_000_012 and spans[0] == [(6_000_000, 6_000_011)] and items[0] == ["1"]
