"""Token ids in Re-Pair compressed shard files.

Documents are range-partitioned by id and sorted; each run of about
``SHARD_BYTES`` of text becomes one file.  Within a shard the frequent pairs of
adjacent symbols are replaced by nonterminals, again and again: a round counts
all pairs, takes the most frequent ones that can't overlap and replaces every
occurrence.  Pairs never cross a document's end.

File, little-endian: ``RPR1``; u32 base ids, rules, documents; u64 symbols;
rules as u32 pairs; u32 expansion length of each rule; i64 document ids;
u8 whether each id is set; u64 first symbol of each document and the end;
u64 first id of each document and the end; u32 symbols.
Any document is decoded alone from its symbol range; lengths need no decoding.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import textbuf as tb
from vitrine.llm.common import new_folder, parallelism, running_total, written
from vitrine.llm.encode import encoder

MAGIC = b"RPR1"
BASE = 1 << 16
#: Text per shard file.
SHARD_BYTES = 8 << 20
#: A round takes at most this many pairs; each must occur this often.
ROUND_RULES = 1 << 12
MIN_COUNT = 8
#: Rounds end when one shortens the shard by less than 1 / SHRINK.
ROUNDS = 16
SHRINK = 40


def compress(seq: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules, symbols, offsets) for ``seq`` whose documents end at ``ends``.

    Inside, the ids that occur are numbered densely, so that a pair mostly fits
    32 bits; the result has the ids again, nonterminals from ``BASE`` on.
    """
    present = np.flatnonzero(np.bincount(seq)) if len(seq) else np.zeros(0, np.int64)
    if len(present) and present[-1] >= BASE:
        raise ValueError(f"id {present[-1]}: the file format holds ids below {BASE}")
    dense = np.zeros(int(present[-1]) + 1 if len(present) else 1, np.uint32)
    dense[present] = np.arange(len(present))
    seq = dense[seq]
    last = np.zeros(len(seq), bool)
    last[ends[ends > 0] - 1] = True
    rules: list[np.ndarray] = []
    symbols = len(present)
    for _ in range(ROUNDS):
        if len(seq) < 2:
            break
        kind, shift = (np.uint32, 16) if symbols <= 1 << 16 else (np.uint64, 32)
        low = kind((1 << shift) - 1)
        code = seq[:-1].astype(kind)
        code <<= kind(shift)
        code |= seq[1:].astype(kind)
        within = ~last[:-1]
        inside = code[within]
        inside.sort()
        new = np.ones(len(inside), bool)
        new[1:] = inside[1:] != inside[:-1]
        at = np.flatnonzero(new)
        count = np.diff(np.concatenate([at, [len(inside)]]))
        often = np.flatnonzero(count >= MIN_COUNT)
        top = often[np.argsort(-count[often], kind="stable")[:4 * ROUND_RULES]]
        best = inside[at[top]]
        chosen = best[_compatible((best >> kind(shift)).tolist(), (best & low).tolist())][:ROUND_RULES]
        if not len(chosen):
            break
        rules.append(np.stack([chosen >> kind(shift), chosen & low], axis=1).astype(np.uint32))
        by = np.argsort(chosen)
        chosen, numbers = chosen[by], np.arange(symbols, symbols + len(chosen), dtype=np.uint32)[by]
        left, right = np.zeros(symbols, bool), np.zeros(symbols, bool)
        left[chosen >> kind(shift)] = True
        right[chosen & low] = True
        within &= left[seq[:-1]]
        within &= right[seq[1:]]
        where = np.flatnonzero(within)
        found = code[where]
        slot = np.minimum(np.searchsorted(chosen, found), len(chosen) - 1)
        hit = chosen[slot] == found
        where, slot = where[hit], slot[hit]
        # in a run of one symbol only every other place starts a pair
        twin = seq[where] == seq[where + 1]
        if twin.any():
            chain = np.zeros(len(where), bool)
            chain[1:] = twin[1:] & twin[:-1] & (where[1:] == where[:-1] + 1)
            start = np.maximum.accumulate(np.where(chain, 0, np.arange(len(where))))
            keep = ~twin | ((np.arange(len(where)) - start) % 2 == 0)
            where, slot = where[keep], slot[keep]
        before = len(seq)
        seq[where] = numbers[slot]
        last[where] = last[where + 1]
        stay = np.ones(before, bool)
        stay[where + 1] = False
        seq, last = seq[stay], last[stay]
        symbols += len(chosen)
        if before - len(seq) < before // SHRINK:
            break
    full = np.flatnonzero(last) + 1
    offsets = np.zeros(len(ends) + 1, np.int64)
    counts = np.diff(np.concatenate([[0], ends])) > 0
    offsets[1:] = np.concatenate([[0], full])[np.cumsum(counts)]
    names = np.concatenate([present, BASE + np.arange(symbols - len(present))]).astype(np.uint32)
    return (names[np.concatenate(rules)] if rules else np.zeros((0, 2), np.uint32)), names[seq], offsets


def _compatible(left: list[int], right: list[int]) -> list[int]:
    """Places of the pairs, best first, whose symbols stand on one side only
    (or twice), so occurrences of two of them never overlap."""
    role: dict[int, int] = {}
    out = []
    for k, (a, b) in enumerate(zip(left, right, strict=True)):
        if a == b:
            if a not in role:
                role[a] = 3
                out.append(k)
        elif role.get(a, 1) == 1 and role.get(b, 2) == 2:
            role[a], role[b] = 1, 2
            out.append(k)
    return out


def expansion_lengths(rules: np.ndarray) -> np.ndarray:
    """Ids that each nonterminal stands for."""
    out = np.ones(len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        out[k] = (out[a - BASE] if a >= BASE else 1) + (out[b - BASE] if b >= BASE else 1)
    return out


def pack(rules: np.ndarray, symbols: np.ndarray, offsets: np.ndarray, doc_ids: list[int | None]) -> bytes:
    lens = expansion_lengths(rules)
    size = np.ones(len(symbols) + 1, np.int64)
    size[0] = 0
    big = np.flatnonzero(symbols >= BASE)
    size[big + 1] = lens[symbols[big].astype(np.int64) - BASE]
    starts = np.cumsum(size)[offsets]
    return b"".join([MAGIC, struct.pack("<IIIQ", BASE, len(rules), len(doc_ids), len(symbols)), rules.astype("<u4").tobytes(),
                     lens.astype("<u4").tobytes(), np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
                     np.array([i is not None for i in doc_ids], "u1").tobytes(), offsets.astype("<u8").tobytes(),
                     starts.astype("<u8").tobytes(), symbols.astype("<u4").tobytes()])


class Shard:
    """A shard file: lengths at once, any document's ids on demand."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard file")
        base, n_rules, n_docs, n_symbols = struct.unpack_from("<IIIQ", data, 4)
        at = 24

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.base = base
        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2)
        self.lengths = take("<u4", n_rules)
        ids, known = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        self.offsets = take("<u8", n_docs + 1).astype(np.int64)
        self.starts = take("<u8", n_docs + 1).astype(np.int64)
        self.symbols = take("<u4", n_symbols)
        self._rules: tuple[np.ndarray, np.ndarray] | None = None

    def _opened(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all nonterminals' expansions, start of each)."""
        if self._rules is None:
            symbols = np.arange(self.base, self.base + len(self.rules), dtype=np.uint32)
            while (big := symbols >= self.base).any():  # nonterminals open level by level
                count = big.astype(np.int64) + 1
                out = np.repeat(symbols, count)
                at = (np.cumsum(count) - count)[big]
                rule = self.rules[symbols[big].astype(np.int64) - self.base]
                out[at], out[at + 1] = rule[:, 0], rule[:, 1]
                symbols = out
            self._rules = symbols, np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        return self._rules

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of a symbol range."""
        ids, starts = self._opened()
        big = np.flatnonzero(symbols >= self.base)
        rule = symbols[big].astype(np.int64) - self.base
        count = np.ones(len(symbols), np.int64)
        count[big] = self.lengths[rule]
        out = np.repeat(symbols, count)
        at = (np.cumsum(count) - count)[big]
        out[tb.ranges(at, count[big])] = ids[tb.ranges(starts[rule], count[big])]
        return out

    def document(self, k: int) -> np.ndarray:
        return self.expand(self.symbols[self.offsets[k]:self.offsets[k + 1]])

    def documents(self) -> list[np.ndarray]:
        """All documents' ids, opened together."""
        return np.split(self.expand(self.symbols), self.starts[1:-1]) if len(self.doc_ids) else []


def _write_batches(path: str, folder: str, end_id: int):
    """Sorted (partition, doc_id, text) rows to files; one row per file."""
    def flush(part: int, number: int, ids: list[np.ndarray], lens: list[np.ndarray], docs: list[int | None], target: pafs.FileSystem, root: str):
        import uuid
        seq = np.concatenate(ids)
        ends = np.cumsum(np.concatenate(lens))
        rules, symbols, offsets = compress(seq, ends)
        data = pack(rules, symbols, offsets, docs)
        # each attempt has its own name; only a finished task's rows name its files
        name = f"{root}/{part:06d}-{number:05d}-{uuid.uuid4().hex}.rpr"
        with target.open_output_stream(name) as f:
            f.write(data)
        return pa.record_batch([pa.array([part]), pa.array([number]), pa.array([name]), pa.array([len(docs)]), pa.array([len(seq)]),
                                pa.array([len(symbols)]), pa.array([len(data)])],
                               names=["part", "number", "file", "n_docs", "n_tokens", "n_symbols", "n_bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        target, root = pafs.FileSystem.from_uri(folder)
        target.create_dir(root, recursive=True)
        ids: list[np.ndarray] = []
        lens: list[np.ndarray] = []
        docs: list[int | None] = []
        size = number = part = 0
        for batch in batches:
            col = tb.string_column(batch.column(2))
            for i, j in tb.slices(col, SHARD_BYTES):
                part = batch.column(0)[i].as_py()
                flat, off = encode(col[i:j])
                n = np.diff(off) + 1
                with_end = np.full(int(n.sum()), end_id, np.uint32)
                put = np.ones(len(with_end), bool)
                put[np.cumsum(n) - 1] = False
                with_end[put] = flat
                ids.append(with_end)
                lens.append(n)
                docs += batch.column(1)[i:j].to_pylist()
                size += len(tb.raw(col[i:j])[0])
                if size >= SHARD_BYTES // 2:
                    yield flush(part, number, ids, lens, docs, target, root)
                    ids, lens, docs, size, number = [], [], [], 0, number + 1
        if docs:
            yield flush(part, number, ids, lens, docs, target, root)
    return run


def write_shards(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Encode and write all documents in ascending id order; the manifest, one
    row per file: ``shard`` (in order), ``file``, ``n_docs``, ``n_tokens``,
    ``n_symbols``, ``n_bytes`` and ``start`` (ids in earlier files).

    * A NULL text is empty: its document is the end id alone.
    * NULL ids come first; rows that share an id are ordered by their text's hash.
    * Extra columns are ignored; an empty table writes no file.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-shards")
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text")).withColumn("__hash", F.xxhash64("__text"))
    keys = ["__id", "__hash"]
    dealt = rows.repartitionByRange(parallelism(spark), *keys).sortWithinPartitions(*keys)
    parts = dealt.select(F.spark_partition_id().cast("long").alias("part"), "__id", "__text")
    schema = "part long, number long, file string, n_docs long, n_tokens long, n_symbols long, n_bytes long"
    files = written(parts.mapInArrow(_write_batches(tokenizer, folder, end_id), schema), "manifest")
    # every partition's files follow those of the partitions before it
    most = files.agg(F.max("number")).first()[0] or 0
    files = files.withColumn("shard", F.col("part") * (most + 1) + F.col("number"))
    return running_total(files, "n_tokens", "shard", "start").drop("part", "number")


def _read_batches(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with source.open_input_file(name) as f:
                    shard = Shard(f.read())
                sums = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in shard.documents()]
                yield pa.record_batch([pa.array(shard.doc_ids, pa.int64()), pa.array(shard.starts[:-1] + start), pa.array(np.diff(shard.starts)),
                                       pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the files, decoded: ``doc_id``, ``start``
    (ids of all documents before it), ``n_tokens`` and ``ids_crc32``."""
    n = parallelism(manifest.sparkSession)
    return (manifest.select("file", "start").repartition(n, "file")
            .mapInArrow(_read_batches(folder), "doc_id long, start long, n_tokens long, ids_crc32 long"))
