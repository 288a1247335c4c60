"""Builders without SQL on the given tables: contract columns, types and values."""

import collections
import re
import zlib

import numpy as np
import pytest

from conftest import SF_SMALL
from test_mixing_sharding import water_fill
from vitrine.llm import queries

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source", "text").collect()]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_op2_counts_every_document(spark, documents, library):
    got = queries.op2(spark, SF_SMALL).collect()
    want = collections.Counter((s, len(ids(library, t))) for _, s, t in documents)
    assert {(r.source, r.n_tokens): r.n_docs for r in got} == want


def test_op5_meets_its_targets(spark, documents):
    got = queries.op5(spark, SF_SMALL)
    assert dict(got.dtypes) | {"rate": "double", "copies": "int"} == {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint", "rate": "double", "copies": "int"}
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, _, t in documents}
    source = {d: s for d, s, _ in documents}
    totals = collections.Counter()
    for d, s, _ in documents:
        totals[s] += size[d]
    goal, taken = water_fill(totals, (1, 2, 3), 3), collections.Counter()
    for r in got.collect():
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == totals[s] and abs(r.target - goal[s]) < 1e-6 * max(goal[s], 1) and r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - g) <= max(0.02 * g, max(size.values())) for s, g in goal.items())


def test_op9_reads_back_what_the_library_gives(spark, documents, library):
    got = queries.op9(spark, SF_SMALL)
    assert got.dtypes[:4] == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    want, start = [], 0
    for d, _, t in sorted(documents, key=lambda r: r[0]):
        x = [*ids(library, t), 0]
        want.append((d, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    assert sorted(tuple(r)[:4] for r in got.collect()) == want


def test_op10_follows_the_longest_rule(spark):
    got = {r.page_id: r for r in queries.op10(spark, SF_SMALL).collect()}
    pages = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url").collect()]
    assert len(got) == len(pages)
    for page, url in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [r for r in queries.URL_RULES if (host == r.text.partition("/")[0] or host.endswith("." + r.text.partition("/")[0])) and path.startswith("/" + r.text.partition("/")[2])]
        row = got[page]
        assert (row.host, row.path) == (host, path) and row.verdict in ("allow", "block")
        best = max(fits, key=lambda r: len(r.text), default=None)
        assert row.rule == (best.text if best else None)
        assert best is None or row.verdict == best.verdict
