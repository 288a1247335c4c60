"""URL filters (rules, features, held-out accuracy) and licence scans."""

import itertools
import math
import random
import re
import textwrap
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_MED
from vitrine.llm import license, urlfilter as uf
from vitrine.llm.queries import URL_RULES

CASES = [
    ("http://Example.COM/en/1", "example.com", "/en/1", "example.com/en/"),
    ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/"),
    ("https://a.www.example.com/en/x?y#z", "a.www.example.com", "/en/x", "www.example.com/en/"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/"),
    ("ftp://m.example.net/es/a#/fr/", "m.example.net", "/es/a", "net/es/"),
    ("http://example.net?/es/", "example.net", "", None),
    ("http://example.com", "example.com", "", None),
    ("http://a/b://c/en/", "a", "/b://c/en/", None),
    ("no scheme", "", "", None), ("", "", "", None), (None, "", "", None), ("://", "", "", None), ("http://é.com/", "é.com", "/", "com/"),
    ("http://x.com/\nline", "x.com", "/\nline", "com/"),
]


def test_host_path_and_longest_rule(spark):
    df = spark.createDataFrame([(c[0], i) for i, c in enumerate(CASES)], "url string, verdict int")
    model = uf.UrlModel(None, spark.createDataFrame([], "suffix string, f_suffix_share double, f_suffix_block double"))
    out = uf.judge(df, URL_RULES, model)
    assert out.columns == ["url", "host", "path", "rule", "score", "verdict"]
    verdict = {r.text: r.verdict for r in URL_RULES}
    want = Counter((u, h, p, r, verdict.get(r, "allow")) for u, h, p, r in CASES)
    assert Counter((r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()) == want
    assert uf.judge(df.where("false"), URL_RULES, model).collect() == []


def test_lexical_features(spark):
    urls = ["http://a-b.example.org/x/y-2/?p=1&q=22#f", "", None, "http://h/" + "a1" * 30_000]
    for r in uf.lexical(spark.createDataFrame([(u,) for u in urls], "__url string")).collect():
        u = (r["__url"] or "").lower()
        n = Counter(c for c in u if c in uf._SYMBOLS)
        assert r["f_length"] == len(u) and r["f_digit_ratio"] == sum(c.isdigit() for c in u) / max(1, len(u))
        assert math.isclose(r["f_entropy"], -sum(v / len(u) * math.log2(v / len(u)) for v in n.values()), rel_tol=1e-9, abs_tol=1e-12)
        query = re.search(r"\?([^#]*)", u)
        assert r["f_parameters"] == (query[1].count("&") + 1 if query and query[1] else 0)


def test_held_out_accuracy(spark):
    urls = spark.read.parquet(f"{SF_MED}/pages.parquet").select("url")
    rng = random.Random(3)
    extra = [(f"http://{rng.choice(uf.SEED_WORDS)}-{rng.randrange(999)}.example.{rng.choice(['com', 'org'])}/{rng.randrange(99)}",) for _ in range(60)]
    labelled = uf.seed_labels(urls.union(spark.createDataFrame(extra, "url string"))).withColumn("held", F.pmod(F.xxhash64("url"), F.lit(4)) == 0)
    model = uf.fit(labelled.where("not held"))
    scored = model.score(labelled.where("held").withColumnRenamed("url", "__url"))
    right = scored.agg(F.avg(((F.col("score") >= 0.5).cast("int") == F.col("label")).cast("double")), F.count("*")).first()
    assert right[1] > 50 and right[0] > 0.95


def alike(host, n):
    """``n`` URLs of one host whose lexical features are all equal."""
    return [f"http://{host}/{''.join(p)}" for p in itertools.islice(itertools.permutations("abcdefg"), n)]


def test_a_sampled_class_keeps_its_weight(spark):
    hyphened, plain = alike("a-b.example.com", 400), alike("ab.example.com", 1600)
    rows = [(u, int(k % 4 == 0)) for k, u in enumerate(hyphened)] + [(u, 0) for u in plain]  # a quarter of the hyphened is 'block'
    labelled = spark.createDataFrame(rows, "url string, label int")
    score = {}
    for max_rows in (100, 10_000):
        out = uf.judge(labelled, [], uf.fit(labelled, max_rows=max_rows))
        assert {r["verdict"] for r in out.select("verdict").distinct().collect()} == {"allow"}, max_rows
        score[max_rows] = out.where("host = 'a-b.example.com'").agg(F.avg("score")).first()[0]
    assert abs(score[100] - score[10_000]) < 0.1


def test_one_hot_url_neither_fills_nor_empties_the_sample(spark):
    block, allow = alike("a-b.example.com", 20), alike("ab.example.com", 400)
    rows = [(u, 1, 1) for u in block[1:]] + [(block[0], 1, 20_000)] + [(u, 0, 1) for u in allow[1:]] + [(allow[0], 0, 1000)]
    labelled = spark.createDataFrame(rows, "url string, label int, n int").withColumn("__k", F.explode(F.sequence(F.lit(1), "n"))).drop("n", "__k")
    out = uf.judge(labelled.distinct(), [], uf.fit(labelled, max_rows=50))
    assert Counter(r["verdict"] for r in out.where("label = 1").collect()) == {"block": 20}
    assert Counter(r["verdict"] for r in out.where("label = 0").collect()) == {"allow": 400}

    counted = labelled.groupBy(F.col("url").alias("__url"), "label").agg(F.count("*").alias("n"))
    totals = {1: {"n": 20_019, "distinct": 20, "top": block[0]}, 0: {"n": 1399, "distinct": 400, "top": allow[0]}}
    taken = [r for r in uf.fit_sample(counted, totals, 50, 11).collect()]
    assert sum(r["label"] == 1 for r in taken) == 20 and 2 <= sum(r["label"] == 0 for r in taken) <= 100
    assert {r["__url"]: r["__weight"] for r in taken}[allow[0]] == 1000
    least = [r["label"] for r in uf.fit_sample(counted, totals, 1, 11).collect()]
    assert set(least) == {0, 1}


def test_one_class_and_no_labels(spark):
    empty = spark.createDataFrame([], "url string, label int")
    assert uf.fit(empty).only == "allow"
    assert uf.fit(spark.createDataFrame([("http://a/", 1), ("http://b/", None)], "url string, label int")).only == "block"


def test_whole_texts_and_lines(spark):
    mit = next(body for i, body in license.KNOWN if i == "MIT" and len(body) > 500)
    rows = [(1, "Copyright (c) 2019 Somebody\n\n" + mit.upper().replace(",", " ,").replace(" ", "  ")),
            (2, "some text\n  released under the MIT licence!!\nmore\nReleased under the MIT License"),
            (3, "Licenced under the Apache Licence ver. 2.0"), (4, "Licensed under the Apache License, Version 3.0"),
            (5, None), (6, ""), (7, " \n!\n"), (8, "Released under the MIT License. " + "x" * 200_000), (2, "Released under the MIT License."),
            (None, "SPDX-License-Identifier: MIT"), (9, mit.replace("free of charge", "for a fee"))]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, license_id int")
    got = sorted((tuple(r) for r in license.scan(df).collect()), key=str)
    assert got == sorted([(1, "MIT", "text", 1), (2, "MIT", "line", 3), (2, "MIT", "text", 1), (3, "Apache-2.0", "text", 1), (3, "Apache-2.0", "line", 1),
                          (None, "MIT", "line", 1), (None, "MIT", "text", 1)], key=str)
    assert license.scan(df.where("false")).collect() == []


def test_known_licences_keep_apart(spark):
    known = license.known_digests(spark).collect()
    assert len({r["digest"] for r in known}) == len(known) and {r["license_id"] for r in known} == {i for i, _ in license.KNOWN}


MIT_FILE = """MIT License

Copyright (c) 2021 Somebody Else

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def test_complete_licence_files(spark):
    def wrapped(body, width):
        return "\n\n".join(x if "Copyright (C)" in x else textwrap.fill(x, width) for x in re.split(r"\n\s*\n", body))

    first, last = {}, {}
    for i, body in license.complete_texts():
        first.setdefault(i, body)
        last[i] = body
    titled = {i: "Copyright 2020 Somebody\n\n" + body for i, body in first.items()}
    filled = first["Apache-2.0"].replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2020 Somebody")
    assert filled != first["Apache-2.0"]
    rows = [("MIT", MIT_FILE), ("Apache-2.0", filled), *titled.items(), *last.items()]
    rows += [(i, wrapped(body, width)) for i, body in first.items() for width in (40, 60, 72, 80, 100)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, want string, text string")
    got = Counter((r["doc_id"], r["license_id"]) for r in license.scan(df).where("scope = 'text'").collect())
    assert got == Counter((k, i) for k, (i, _) in enumerate(rows))
    changed = [(k, re.sub(r"(?i)without", "with", body)) for k, (i, body) in enumerate(first.items())]
    assert license.scan(spark.createDataFrame(changed, "doc_id long, text string")).where("scope = 'text'").collect() == []


def test_sql_knows_the_complete_texts(spark):
    import duckdb
    import pandas as pd
    from vitrine.llm import oracles
    texts = license.complete_texts()
    rows = [(i, body if i % 2 else body.replace("\n", "  \n ").upper()) for i, (_, body) in enumerate(texts)]
    rows += [(len(rows), "Released under the MIT License.\nnothing\nLicensed under the MIT License"), (len(rows) + 1, None), (len(rows) + 2, "")]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])
    con = duckdb.connect()
    con.register("documents", documents)
    want = sorted(con.execute(oracles.OP3).fetchall())
    got = sorted(tuple(r) for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "license_id", "scope", "n").collect())
    assert got == want and {r[0] for r in got if r[2] == "text"} == set(range(len(texts)))


def test_a_given_table_of_digests(spark, monkeypatch):
    digests = spark.createDataFrame([("a", "one two"), ("b", "One, two!"), ("c", "three")], "license_id string, body string")
    known = digests.select(license.digest(license.canonical("body")).alias("digest"), "license_id")
    ties = known.groupBy("digest").agg(F.min("license_id").alias("license_id"))
    df = spark.createDataFrame([(1, "ONE TWO\nfour"), (2, "three"), (3, None)], "doc_id long, text string")
    want = [(1, "a", "line", 1), (2, "c", "line", 1), (2, "c", "text", 1)]
    assert license.known_digests(spark, (("b", "One, two!"), ("a", "one two"))).collect()[0].license_id == "a"
    for rows in (license.BROADCAST_ROWS, 0):  # broadcast, and beyond the bound
        monkeypatch.setattr(license, "BROADCAST_ROWS", rows)
        assert sorted(tuple(r) for r in license.scan(df, ties).collect()) == want
    assert license.scan(df, ties.limit(0)).collect() == []
