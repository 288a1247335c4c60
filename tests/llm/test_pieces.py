"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine.llm import encode, pieces
from vitrine.llm.queries import op11

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "The", "tion", " ", "  ", "\n", "\t", "\r\n", "▁", "é", "é", "中", "😀", "\x00", "1", "23", ".", "<s>", "</s>", "<0x0A>", "<unk>", "x" * 70, "in ing", " ", "ﬁ½"]


@pytest.fixture(scope="module")
def encoder():
    return pieces.piece_encoder(PATH)


def both(encoder, texts):
    flat, off = encoder.encode(pieces.with_space(pa.array(texts, pa.large_string())))
    return [flat[a:b].tolist() for a, b in zip(off, off[1:])], [encoder.library.encode(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.lists(st.sampled_from(PARTS), max_size=20).map("".join)), max_size=8))
def test_ids_equal_the_library(texts):
    got, want = both(pieces.piece_encoder(PATH), texts)
    assert got == want


def test_long_texts_without_cuts_use_the_heap(encoder):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdehinorst") for _ in range(n)) for n in (65, 300, 5000)] + [" " * 200, "中文" * 400, "<s>" * 100]
    got, want = both(encoder, texts)
    assert got == want


def test_heap_and_rounds_are_one_agenda(encoder):
    rng = random.Random(5)
    v = encoder.vocabulary
    words = ["".join(rng.choice("aeinorst .é中") for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    symbols = [v.char[[ord(c) for c in w]] for w in words]
    flat, sizes = pieces.agendas(np.concatenate(symbols), np.array([len(s) for s in symbols]), v)
    at = np.append(0, np.cumsum(sizes))
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == [pieces.agenda(s.tolist(), v) for s in symbols]


def test_cache_starts_afresh(monkeypatch):
    monkeypatch.setattr(encode, "CACHE_PIECES", 4)
    e = pieces.PieceEncoder(PATH)
    for text in ("one two three four five", "six seven one two", "eight nine ten"):
        got, want = both(e, [text])
        assert got == want


def test_a_hash_met_twice_is_noticed(monkeypatch):
    e = pieces.PieceEncoder(PATH)
    monkeypatch.setattr(pieces.tb, "span_hashes", lambda buf, starts, ends: np.zeros(len(starts), np.uint64))
    got, want = both(e, ["one three", "seventeen four", ""])
    assert got == want


def test_other_models_are_refused():
    def field(number, value):
        if isinstance(value, int):
            return bytes([number << 3 & 127 | (128 if number > 15 else 0), *([number >> 4] if number > 15 else []), value])
        return bytes([number << 3 | 2, len(value)]) + value

    piece = field(1, field(1, "▁a".encode()))
    bpe = field(2, field(3, 2) + field(35, 1))
    plain = field(3, field(4, 0))
    pieces.Vocabulary(piece + field(1, field(1, "▁".encode())) + field(1, field(1, b"a")) + bpe + plain)
    for model in (piece + field(2, field(3, 1)) + plain, piece + bpe + field(3, field(2, b"map") + field(4, 0)), piece + bpe + field(3, field(4, 1)),
                  piece + field(1, field(1, b"u") + field(3, 4)) + bpe + plain, field(1, field(1, b"a\nb")) + bpe + plain):
        with pytest.raises(ValueError):
            pieces.Vocabulary(model)


def rows():
    rng = random.Random(4)
    out = [(i, "".join(rng.choice(PARTS) for _ in range(rng.choice([0, 1, 20, 300])))) for i in range(80)]
    return out + [(200, None), (201, ""), (202, "word " * 40_000), (202, "twice"), (202, "twice"), (None, "no id")]


def expected(data, library):
    out = []
    for doc, text in data:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        out.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_the_library(spark, encoder, tmp_path):
    data = rows()
    spark.createDataFrame([(d, t, "x", 1) for d, t in data], "doc_id long, text string, ids string, n_tokens int").write.parquet(f"{tmp_path}/documents.parquet")
    got = op11(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert sorted(map(tuple, got.collect()), key=str) == expected(data, encoder.library)


def test_operator_returns_ids_and_text(spark, encoder):
    df = spark.createDataFrame([("k", "to be  or\nnot"), ("k", None)], "name string, body string")
    got = pieces.encode(df, PATH, "name", "body", ends=False, decode=True).collect()
    ids = encoder.library.encode("to be  or\nnot")
    assert {(r.name, r.n_tokens, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded) for r in got} == {("k", len(ids), tuple(ids), "to be  or\nnot"), ("k", 0, (), "")}


def test_empty_table(spark):
    assert pieces.encode(spark.createDataFrame([], "doc_id long, text string"), PATH, decode=True).collect() == []
