"""Cross-tokenizer alignment against a plain count."""

import collections
import hashlib
import random

import numpy as np
import pytest

from vitrine.llm import align
from vitrine.llm.queries import op13

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "The", "tion ", " ", "  ", "\n", "\t", "é", "中文", "😀", "\x00", "12", ".", "<|endoftext|>", "<s>", "<0x0A>", "x" * 40, " thing", " in", " ", "　"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def bytes_of_char():
    """The printable stand-ins of byte-level vocabularies, from their rule."""
    out, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


def tokens(libraries, text):
    """[(id, start, end)] of both sides, or two empty lists."""
    a, b = libraries
    chars = bytes_of_char()
    ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    sa = [bytes(chars[c] for c in a.id_to_token(i)) for i in ia]
    sb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
    if not text or b"".join(sa) != (" " + text).encode() or b"".join(sb) != (" " + text).encode():
        return [], []
    out = []
    for ids, surface in ((ia, sa), (ib, sb)):
        at, side = 0, []
        for i, s in zip(ids, surface):
            side.append((i, at, at + len(s)))
            at += len(s)
        out.append(side)
    return out


def brute(libraries, data):
    docs = []
    for doc, text in data:
        ta, tb = tokens(libraries, text or "")
        links = collections.Counter((x, y) for x, s, e in ta for y, t, f in tb if s < f and t < e)
        ends = sorted({e for _, _, e in ta} & {e for _, _, e in tb})
        groups = [",".join(str(i) for i, _, e in ta if lo < e <= hi) + "|" + ",".join(str(i) for i, _, e in tb if lo < e <= hi) for lo, hi in zip([0, *ends], ends)]
        docs.append((doc, len(ta), len(tb), len(ends), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    count = collections.Counter(p for d in docs for p in d[4])
    best = collections.defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return sorted(((d, na, nb, ng, sum(links.values()), sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items()), h)
                   for d, na, nb, ng, links, h in docs), key=str)


def rows():
    rng = random.Random(7)
    out = [(i, "".join(rng.choice(PARTS) for _ in range(rng.choice([0, 1, 15, 60])))) for i in range(120)]
    return out + [(300, None), (301, ""), (302, "a thing in " * 60), (302, "a thing"), (302, "a thing"), (None, "no id"), (303, "a ▁ b"), (304, " ")]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("run_links, fan, radix", [(1 << 22, 64, 64), (200, 2, 3), (40, 3, 1)])
def test_query_equals_brute_force(spark, libraries, tmp_path, monkeypatch, run_links, fan, radix):
    """Also with many runs and several levels of merging (the runs are made in
    this process, so that the smaller limits hold there)."""
    data = rows()
    docs = spark.createDataFrame([(d, t, 5, "r") for d, t in data], "doc_id long, text string, n_a int, run string")
    if run_links == 1 << 22:
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        got = op13(spark, str(tmp_path))
        assert got.dtypes == [(c, "string" if c == "groups_sha256" else "bigint") for c in COLUMNS]
        assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=str) == brute(libraries, data)
        return
    monkeypatch.setattr(align, "RADIX", radix)
    monkeypatch.setattr(align, "FAN", fan)
    monkeypatch.setattr(align, "BLOCK", 7)
    al = align.aligner(A, B)
    import pyarrow as pa
    made, parts = [], []
    for run, at in enumerate(range(0, len(data), max(1, run_links // 20))):
        chunk = data[at:at + max(1, run_links // 20)]
        f = al.read(align.tb.string_column(pa.array([t for _, t in chunk], pa.large_string())))
        made += [(run * 5, k, chunk[k][0], *(int(f[c][k]) for c in ("n_a", "n_b", "n_groups", "n_links")), f["groups_sha256"][k]) for k in range(len(chunk))]
        if len(f["pair"]):
            keys = f["pair"].astype(np.uint64) << np.uint64(24) | f["doc"].astype(np.uint64)
            parts += [(run * 5, r, bytearray(p), bytearray(q)) for r, p, q in align.run_parts(keys, al.width)]
    runs = spark.createDataFrame(parts, "run long, radix int, pairs binary, records binary")
    gains = {(r.radix, r.child): bytes(r.gains) for r in align._counts(runs.selectExpr("radix", "run as child", "pairs"), len({p[0] for p in parts}), al.width, 4).collect()}
    assert set(gains) == {(p[1], p[0]) for p in parts}
    rows_in = [x for run, radix_no, p, q in sorted(parts, key=lambda x: x[:2]) for x in ((run, radix_no, gains[radix_no, run], None, None), (run, radix_no, None, bytes(p), bytes(q)))]
    batch = pa.record_batch([pa.array(c) for c in zip(*rows_in)], names=["run", "radix", "gains", "pairs", "records"])
    sums = {(r["run"], r["slot"]): (r["n_best"], r["count_sum"]) for b in align._sum_batches(iter([batch])) for r in b.to_pylist()}
    got = sorted(((d, na, nb, ng, nl, *sums.get((run, slot), (0, 0)), h) for run, slot, d, na, nb, ng, nl, h in made), key=str)
    assert got == brute(libraries, data)


def test_merge_of_runs_is_a_count():
    rng = np.random.default_rng(2)
    runs, total = [], collections.Counter()
    for _ in range(9):
        codes = np.unique(rng.integers(0, 3000, rng.integers(1, 900)).astype(np.uint64) * np.uint64(1 << 33))
        n = rng.integers(1, 9, len(codes)).astype(np.uint64)
        runs.append(align.pack(codes, n))
        total.update(dict(zip(codes.tolist(), n.tolist())))
    parts = list(align.merged(runs))
    codes, n = (np.concatenate([p[k] for p in parts]) for k in range(2))
    assert dict(zip(codes.tolist(), n.tolist())) == total and (np.diff(codes.astype(np.int64)) > 0).all()


def test_packed_columns_come_back(monkeypatch):
    monkeypatch.setattr(align, "BLOCK", 5)
    a, b = np.cumsum(np.arange(17, dtype=np.uint64)), np.arange(17, dtype=np.uint64) ** np.uint64(9)
    got = align.unpack(align.pack(a, b), 2)
    assert got[0].tolist() == a.tolist() and got[1].tolist() == b.tolist()


def test_long_text(libraries):
    import pyarrow as pa
    text = "the thing " * 30_000 + "z" * 5000
    f = align.aligner(A, B).read(pa.array([text, "", "a"], pa.large_string()))
    ta, tb = tokens(libraries, text)
    assert f["n_a"].tolist()[:2] == [len(ta), 0] and f["n_b"].tolist()[:2] == [len(tb), 0]
    assert f["n_links"][0] == len({e for _, _, e in ta} | {e for _, _, e in tb})


def test_empty_tables(spark):
    assert align.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
    got = align.align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
