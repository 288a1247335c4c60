"""Conversation prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

from vitrine.llm import trie
from vitrine.llm.queries import op12

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rem(a, m):
    return a - m * int(a / m)


def brute(data):
    own = {}
    for c, turn, role, text in sorted((r for r in data if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - rem(c, 100), [])[:h] + ts[h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = []
    for p, cs in members.items():
        under = [q for q in members if q[:len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in cs if paths[c] == p)))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids.get(p, [])), sum(q not in kids for q in under),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in under if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(spark, data, tmp_path, name):
    df = spark.createDataFrame([(*r, "x", 3) for r in data], "conv_id long, turn long, role string, text string, depth string, k1 int")
    df.write.parquet(f"{tmp_path}/{name}/conversations.parquet")
    got = op12(spark, f"{tmp_path}/{name}")
    assert got.dtypes == [(c, "string" if c == "ends_sha256" else "bigint") for c in COLUMNS]
    return sorted((tuple(r) for r in got.collect()), key=str)


def conversations():
    rng = random.Random(9)
    data = []
    for c in [*range(0, 40), *range(100, 130), 250, 251, 399, -5, -130]:
        for t in range(rng.choice([1, 2, 3, 7])):
            data.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hello", "é中😀", "", None, "more"])))
    data += [(50, None, "user", "null turn first"), (50, 0, "user", "then"), (51, 3, "user", "again"), (51, 3, "user", "again")]
    data += [(60 + k, t, "user", "same") for k in range(9) for t in range(8)]
    data += [(None, 0, "user", "no conversation"), (70, 0, "u", "s"), (71, 0, "us", "")]
    rng.shuffle(data)
    return data


def test_query_equals_brute_force(spark, tmp_path):
    data = conversations()
    assert result(spark, data, tmp_path, "mixed") == brute(data)


def test_one_conversation_with_most_turns(spark, tmp_path):
    data = [(0, t, "user", f"t{t % 7}") for t in range(700)] + [(c, t, "user", f"t{t}") for c in range(1, 8) for t in range(9)]
    assert result(spark, data, tmp_path, "long") == brute(data)


def test_one_sequence_with_many_conversations(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 8)
    data = [(c * 100, t, "user", "same") for c in range(60) for t in range(3)] + [(c * 100 + 7, t, "user", f"{c}") for c in range(5) for t in range(2)]
    assert result(spark, data, tmp_path, "hot") == brute(data)


def test_turnless_conversations_end_at_the_root(spark, tmp_path):
    # h of these ids exceeds their own turns and their base is absent
    ids = [c for c in range(500, 700) if c % 100 and zlib.crc32(str(c).encode()) % 6 >= 2][:4]
    data = [(c, 0, "user", "gone") for c in ids]
    got = result(spark, data, tmp_path, "bare")
    assert got == brute(data)
    assert [r[1] for r in got] == [0] and got[0][4:6] == (0, 1)


def test_empty_table(spark, tmp_path):
    assert result(spark, [], tmp_path, "none") == []
