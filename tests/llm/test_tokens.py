"""Token counts, encoding and Re-Pair shards against the tokenizers library."""

import collections
import random
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine.llm import encode, repair, tokencount

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


PIECES = ["a", "The", " ", "  ", "\n", "\t", "\r\n", " ", " ", "é", "’s", "'s", "'ll", "12", "...", "<|endoftext|>", "<|", "中文", "😀", "\x0b", "\x1c", "　", "x" * 50, "!"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.lists(st.sampled_from(PIECES), max_size=20).map("".join)), max_size=8))
def test_ids_equal_the_library(texts):
    e = encode.encoder(PATH)
    flat, off = e.encode(pa.array(texts, pa.large_string()))
    assert [flat[off[k]:off[k + 1]].tolist() for k in range(len(texts))] == [ids(e.tokenizer, t) for t in texts]


def test_cache_starts_afresh(monkeypatch, library):
    monkeypatch.setattr(encode, "CACHE_PIECES", 5)
    e = encode.Encoder(PATH)
    for text in ("one two three four", "five six one two", "seven eight nine ten eleven twelve"):
        flat, _ = e.encode(pa.array([text], pa.large_string()))
        assert flat.tolist() == ids(library, text)


def rows():
    rng = random.Random(4)
    out = [(i, "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 1, 20, 300]))), rng.choice(["a", "b", None])) for i in range(90)]
    return out + [(200, None, "a"), (201, "", "b"), (202, "word " * 40_000, "a"), (202, "twice", "a"), (None, "no id", None), (203, " \n ", "c")]


def test_histogram_equals_brute_force(spark, library, monkeypatch):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string, source string").withColumnRenamed("doc_id", "n_docs")
    table = tokencount.histogram(df, PATH, by=("source",))
    by = collections.defaultdict(list)
    for _, text, source in data:
        by[source].append(len(ids(library, text)))
    expected = {(s, n): (x.count(n), sum(v >= n for v in x), sum(v for v in x if v >= n), sum(min(v, n) for v in x)) for s, x in by.items() for n in set(x)}
    assert {(r["source"], r["n_tokens"]): tuple(r)[2:] for r in table.collect()} == expected
    limits = [0, 1, 7, 512, 10**6]
    cut = {(r["source"], r["limit"]): (r["tokens"], r["docs_cut"]) for r in tokencount.truncated_totals(table, limits, ("source",)).collect()}
    assert cut == {(s, m): (sum(min(v, m) for v in x), sum(v > m for v in x)) for s, x in by.items() for m in limits}
    got = {(r["source"], r["share"]): r["n_tokens"] for r in tokencount.quantiles(table, [0.25, 0.5, 1.0], ("source",)).collect()}
    assert got == {(s, q): sorted(x)[max(0, -int(-q * len(x) // 1) - 1)] for s, x in by.items() for q in (0.25, 0.5, 1.0)}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokencount.histogram(df, PATH).collect() == []
    folder = "file://" + tempfile.mkdtemp()
    assert repair.read_shards(repair.write_shards(df, PATH, folder), folder).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_repair_round_trip(seed):
    rng = np.random.default_rng(seed)
    lens = rng.choice([0, 1, 2, 3, 50, 2000], 40)
    seq = rng.integers(0, [2, 3, 10, 1000, 65_000, 4][seed], lens.sum()).astype(np.uint32)
    seq[100:1100] = 1
    ends = np.cumsum(lens)
    data = repair.pack(*repair.compress(seq, ends), [int(k) if k % 7 else None for k in range(40)])
    shard = repair.Shard(data)
    assert np.diff(shard.starts).tolist() == lens.tolist() and shard.doc_ids[7] is None and shard.doc_ids[8] == 8
    for k in range(40):
        assert shard.document(k).tolist() == seq[ends[k] - lens[k]:ends[k]].tolist()
    if seed < 3:
        assert len(shard.symbols) < len(seq) and len(shard.rules) and (shard.lengths >= 2).all()


def test_shards_hold_every_document_in_order(spark, library, monkeypatch):
    data = [(i, t) for i, t, _ in rows()]
    folder = "file://" + tempfile.mkdtemp()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    manifest = repair.write_shards(df, PATH, folder)
    got = sorted((tuple(r) for r in repair.read_shards(manifest, folder).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _ in data), key=lambda i: -1 if i is None else i)
    start = 0
    texts = collections.defaultdict(list)
    for i, t in data:
        texts[i].append(np.array(ids(library, t) + [0], "<u4"))
    for i, at, n, crc in got:
        assert at == start and (n, crc) in [(len(x), zlib.crc32(x.tobytes())) for x in texts[i]]
        start += n
    assert manifest.count() >= 1


def test_added_tokens_call_for_whole_texts(tmp_path):
    """Any tokenizer's added tokens are met, not only those that look like <|...|>."""
    from tokenizers import AddedToken, Tokenizer
    own = Tokenizer.from_file(PATH)
    own.add_tokens(["[PAD]", AddedToken("two words", normalized=False)])
    own.add_special_tokens(["<s>"])
    own.save(f"{tmp_path}/own.json")
    e = encode.Encoder(f"{tmp_path}/own.json")
    texts = ["a [PAD] b", "two words here", "x<s>y <s>", "plain two  words", "[PAD", ""]
    flat, off = e.encode(pa.array(texts, pa.large_string()))
    assert [flat[off[k]:off[k + 1]].tolist() for k in range(len(texts))] == [ids(e.tokenizer, t) for t in texts]


def test_plain_special_tokens():
    e = encode.Encoder(PATH, plain=True)
    text = "a <|endoftext|> b<|endoftext|>"
    flat, _ = e.encode(pa.array([text], pa.large_string()))
    assert flat.tolist() == ids(e.tokenizer, text) and 50256 not in flat


def test_ids_beyond_the_file_format_raise():
    with pytest.raises(ValueError, match="below"):
        repair.compress(np.array([1, repair.BASE], np.int64), np.array([2]))
