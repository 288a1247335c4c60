"""Cross-tokenizer alignment: which ids of two tokenizers cover the same bytes.

Both tokenizers read a space and the text.  Byte offsets where tokens of both
end cut them into groups; an A and a B token whose byte ranges overlap are
linked.  An id pair's count is the number of documents that hold it linked.

Counting is external.  A task gathers the links of its documents until a run
is full, sorts them by (pair, document) and writes the run radix-partitioned
by A id, each part as zstd blocks of ascending pairs.  Per radix the runs are
merged by a heap over their blocks, ``FAN`` of them a task and level after level,
so a task holds ``FAN`` compressed parts and one radix' distinct pairs.  Pairs
come A-major, so an A id's highest count is known when the merge passes it;
counts and winners go back the same way, aligned with each run's pairs, and
are added up for the run's documents.  A pair that is in every document costs
one entry a run, not one a document.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import textbuf as tb
from vitrine.llm.common import parallelism, written
from vitrine.llm.encode import encoder
from vitrine.llm.pieces import MARK, piece_encoder, with_space

#: Links that fill a run (8 bytes each while it is sorted).
RUN_LINKS = 1 << 22
#: Parts of a run, by A id.
RADIX = 64
#: Runs (or merged runs) that one task merges.
FAN = 64
#: Pairs of one compressed block.
BLOCK = 1 << 14
_SLOT_BITS = 24  # documents of a run


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, which compresses small ones well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _numbers(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def pack(*columns: np.ndarray) -> bytes:
    """Equally long columns of little-endian 64-bit numbers as zstd blocks; the
    first column, if ascending, should be given as it is: blocks store steps."""
    out = []
    press = zstandard.ZstdCompressor(level=1)
    for i in range(0, len(columns[0]), BLOCK):
        first = columns[0][i:i + BLOCK].astype("<u8")
        parts = [np.diff(first, prepend=np.zeros(1, "<u8")), *(c[i:i + BLOCK].astype("<u8") for c in columns[1:])]
        frame = press.compress(b"".join(map(_planes, parts)))
        out += [len(first).to_bytes(4, "little"), len(frame).to_bytes(4, "little"), frame]
    return b"".join(out)


def blocks(data: bytes, n_columns: int) -> Iterator[list[np.ndarray]]:
    """The columns of :func:`pack`, block after block."""
    at = 0
    expand = zstandard.ZstdDecompressor()
    while at < len(data):
        n, size = int.from_bytes(data[at:at + 4], "little"), int.from_bytes(data[at + 4:at + 8], "little")
        body = expand.decompress(data[at + 8:at + 8 + size])
        cols = [_numbers(body[8 * n * k:8 * n * (k + 1)], "<u8") for k in range(n_columns)]
        yield [np.cumsum(cols[0], dtype=np.uint64), *cols[1:]]
        at += 8 + size


def unpack(data: bytes, n_columns: int) -> list[np.ndarray]:
    """All columns of :func:`pack`."""
    found = list(blocks(data, n_columns))
    return [np.concatenate([np.zeros(0, np.uint64), *(b[k] for b in found)]) for k in range(n_columns)]


def merged(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, counts) of all runs in ascending order, a stretch at a time.

    A heap holds every run under the first pair of its present block.  All
    blocks are complete up to the smallest of their last pairs; that much of
    them is added up and given out."""
    sources = [blocks(r, 2) for r in runs]
    now: dict[int, list[np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def advance(k: int) -> None:
        block = next(sources[k], None)
        if block is None:
            now.pop(k, None)
        else:
            now[k] = block
            heapq.heappush(heap, (int(block[0][0]), k))

    for k in range(len(runs)):
        advance(k)
    while heap:
        bound = min(int(b[0][-1]) for b in now.values())
        pairs, counts = [], []
        while heap and heap[0][0] <= bound:
            _, k = heapq.heappop(heap)
            codes, n = now[k]
            cut = int(np.searchsorted(codes, np.uint64(bound), side="right"))
            pairs.append(codes[:cut])
            counts.append(n[:cut])
            if cut == len(codes):
                advance(k)
            else:
                now[k] = [codes[cut:], n[cut:]]
                heapq.heappush(heap, (int(codes[cut]), k))
        codes, n = np.concatenate(pairs), np.concatenate(counts)
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        yield codes[first], np.add.reduceat(n[order], first)


def _merge(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = list(merged(runs))
    return tuple(np.concatenate([np.zeros(0, np.uint64), *(p[k] for p in parts)]) for k in range(2))


class Aligner:
    """Links and groups of documents by two tokenizer files."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = encoder(path_a, plain=True), piece_encoder(path_b)
        vocab = self.a.tokenizer.get_vocab()
        order = sorted(vocab, key=vocab.get)
        # byte-level vocabularies write byte 33..126, 161..172, 174..255 as itself, the others from U+0100 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}
        surface_a = {vocab[t]: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t in order}
        v = self.b.vocabulary
        surface_b = {k: bytes([int(p[1:-1], 16)]) if v.kinds[k] == v.BYTE else p.replace(MARK, " ").encode() for k, p in enumerate(v.pieces)}
        self.surfaces = [self._table(s) for s in (surface_a, surface_b)]
        self.width = len(v.pieces)
        size = max(max(surface_a), max(surface_b)) + 1
        if (max(surface_a) + 1) * self.width >= 1 << (64 - _SLOT_BITS):
            raise ValueError("the vocabularies have too many pairs")
        decimal = np.char.encode(np.arange(size).astype(str))
        self.digits = decimal.view(np.uint8).reshape(size, -1)
        self.n_digits = (self.digits > 0).sum(axis=1)

    @staticmethod
    def _table(surface: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, start, length) of each id."""
        length = np.zeros(max(surface) + 1, np.int64)
        for k, s in surface.items():
            length[k] = len(s)
        return np.frombuffer(b"".join(surface.get(k, b"") for k in range(len(length))), np.uint8), np.cumsum(length) - length, length

    def _differs(self, side: int, flat: np.ndarray, off: np.ndarray, buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Documents whose joined tokens are not their bytes."""
        body, start, length = self.surfaces[side]
        sizes = length[flat]
        total = np.append(0, np.cumsum(sizes))[off]
        if np.array_equal(total, bounds):
            joined = body[tb.ranges(start[flat], sizes)]
            wrong = np.flatnonzero(joined != buf)
            return np.unique(np.searchsorted(bounds, wrong, side="right") - 1)
        # some document's length differs: look at each by itself
        out = [k for k in range(len(off) - 1)
               if b"".join(body[s:s + n].tobytes() for s, n in zip(start[flat[off[k]:off[k + 1]]], sizes[off[k]:off[k + 1]], strict=True)) != buf[bounds[k]:bounds[k + 1]].tobytes()]
        return np.array(out, np.int64)

    def read(self, col: pa.Array) -> dict[str, np.ndarray | list[str]]:
        """Of a slice of texts: per document ``n_a``, ``n_b``, ``n_groups``,
        ``n_links``, ``groups_sha256``; per link its ``pair`` and ``doc``."""
        col = with_space(col)
        while True:
            buf, bounds = tb.raw(col)
            (fa, off_a), (fb, off_b) = self.a.encode(col), self.b.encode(col)
            fa, fb = fa.astype(np.int64), fb.astype(np.int64)
            bad = np.union1d(self._differs(0, fa, off_a, buf, bounds), self._differs(1, fb, off_b, buf, bounds))
            if not len(bad):
                break
            mask = np.zeros(len(col), bool)
            mask[bad.astype(np.int64)] = True
            col = pc.if_else(pa.array(mask), pa.scalar("", pa.large_string()), col)
        n = len(col)
        end_a = np.cumsum(self.surfaces[0][2][fa]) - 1
        end_b = np.cumsum(self.surfaces[1][2][fb]) - 1
        mark_a, mark_b = np.zeros(len(buf), bool), np.zeros(len(buf), bool)
        mark_a[end_a], mark_b[end_b] = True, True
        cut = np.flatnonzero(mark_a | mark_b)  # one stretch between cuts is one link
        both = mark_a[cut] & mark_b[cut]
        of_a = np.cumsum(mark_a[cut]) - mark_a[cut]
        of_b = np.cumsum(mark_b[cut]) - mark_b[cut]
        links = np.searchsorted(cut, bounds)
        groups = np.append(0, np.cumsum(both))[links]
        return {"n_a": np.diff(off_a), "n_b": np.diff(off_b), "n_groups": np.diff(groups), "n_links": np.diff(links),
                "groups_sha256": self._hashes(fa, fb, off_a, off_b, cut, both, of_a, of_b, groups),
                "pair": fa[of_a] * self.width + fb[of_b], "doc": np.repeat(np.arange(n), np.diff(links))}

    def _hashes(self, fa, fb, off_a, off_b, cut, both, of_a, of_b, groups) -> list[str]:
        """SHA-256 of each document's groups written out; '' without tokens."""
        group_of_cut = np.cumsum(both) - both
        n_groups = int(both.sum())
        group_a, group_b = np.empty(len(fa), np.int64), np.empty(len(fb), np.int64)
        group_a[of_a], group_b[of_b] = group_of_cut, group_of_cut
        count_a, count_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        upto_a, upto_b = np.cumsum(count_a), np.cumsum(count_b)
        # a group's A ids, then its B ids
        place_a = np.arange(len(fa)) + (upto_b - count_b)[group_a]
        place_b = np.arange(len(fb)) + upto_a[group_b]
        ids = np.empty(len(fa) + len(fb), np.int64)
        ids[place_a], ids[place_b] = fa, fb
        behind = np.full(len(ids), ord(","), np.uint8)
        ends = upto_a + upto_b
        behind[ends - count_b - 1] = ord("|")
        behind[ends - 1] = ord(";")
        items = np.append(0, ends)[groups]
        last = items[1:][items[1:] > items[:-1]] - 1
        digits = self.n_digits[ids]
        sizes = digits + 1
        sizes[last] -= 1
        stop = np.cumsum(sizes)
        start = stop - sizes
        out = np.empty(stop[-1] if len(stop) else 0, np.uint8)
        for k in range(self.digits.shape[1]):
            has = digits > k if k else slice(None)
            out[start[has] + k] = self.digits[ids[has], k]
        inner = np.ones(len(ids), bool)
        inner[last] = False
        out[stop[inner] - 1] = behind[inner]
        at = np.append(0, stop)[items].tolist()
        data = memoryview(out)
        return [hashlib.sha256(data[a:b]).hexdigest() if b > a else "" for a, b in zip(at, at[1:])]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker's aligner of two tokenizer files."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


_RUN_NAMES = ["run", "slot", "__id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "radix", "pairs", "records"]


def run_parts(keys: np.ndarray, width: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(radix, pairs, records) of a run's links ``pair << 24 | slot``: ascending
    pairs with their number of documents; slot and links of each document."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    links = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    pair, slot = keys >> np.uint64(_SLOT_BITS), keys & np.uint64((1 << _SLOT_BITS) - 1)
    head = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    n_docs = np.diff(np.append(head, len(pair)))
    pair = pair[head]
    radix = (pair // np.uint64(width) % np.uint64(RADIX)).astype(np.int64)
    order = np.argsort(radix, kind="stable")
    edges = np.searchsorted(radix[order], np.arange(RADIX + 1))
    for r in range(RADIX):
        own = order[edges[r]:edges[r + 1]]
        if len(own):
            rows = tb.ranges(head[own], n_docs[own])
            # slots begin anew with each pair; steps between them are kept small by storing them as they are
            yield r, pack(pair[own], n_docs[own]), pack(np.cumsum(slot[rows], dtype=np.uint64), links[rows])


def _run_batches(path_a: str, path_b: str, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(path_a, path_b)
        run_id = TaskContext.get().partitionId() << 32
        keys: list[np.ndarray] = []
        n_links = slot = 0

        def flush() -> pa.RecordBatch:
            parts = list(run_parts(np.concatenate(keys), align.width))
            n = len(parts)
            return pa.record_batch([pa.array([run_id] * n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, id_type), *(pa.nulls(n, pa.int64()) for _ in range(4)),
                                    pa.nulls(n, pa.string()), pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary()),
                                    pa.array([p[2] for p in parts], pa.binary())], names=_RUN_NAMES)

        for batch in batches:
            col = tb.string_column(batch.column(1))
            for i, j in tb.slices(col):
                found = align.read(col[i:j])
                n = j - i
                keys.append(found["pair"].astype(np.uint64) << np.uint64(_SLOT_BITS) | (found["doc"] + slot).astype(np.uint64))
                n_links += len(found["pair"])
                yield pa.record_batch([pa.array([run_id] * n, pa.int64()), pa.array(np.arange(slot, slot + n)), batch.column(0)[i:j],
                                       *(pa.array(found[c]) for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(found["groups_sha256"], pa.string()),
                                       pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names=_RUN_NAMES)
                slot += n
                if n_links >= RUN_LINKS or slot >= 1 << (_SLOT_BITS - 1):
                    yield flush()
                    keys, n_links, slot, run_id = [], 0, 0, run_id + 1
        if n_links:
            yield flush()
    return run


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal first two columns: (key, rest of the rows)."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:2] != key:
                if rows:
                    yield key, rows
                key, rows = row[:2], []
            rows.append(row[2:])
    if rows:
        yield key, rows


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(radix, node, child, pairs) -> one merged run for each (radix, node)."""
    for (radix, node), rows in _grouped(batches):
        yield pa.record_batch([pa.array([radix], pa.int32()), pa.array([node], pa.int64()), pa.array([pack(*_merge([pairs for _, pairs in rows]))], pa.binary())],
                              names=["radix", "child", "pairs"])


def _shares(radix: int, rows: list[tuple[int, bytes]], codes: np.ndarray, counts: np.ndarray, best: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each child's share of the counts and winners, in the order of its pairs."""
    for child, pairs in rows:
        at = np.searchsorted(codes, unpack(pairs, 2)[0])
        # counts are no ascending column: their running sum is
        yield pa.record_batch([pa.array([radix], pa.int32()), pa.array([child], pa.int64()), pa.array([pack(np.cumsum(counts[at], dtype=np.uint64), best[at])], pa.binary())],
                              names=["radix", "child", "gains"])


def _top(width: int):
    """(radix, 0, child, pairs): the last merge, A-major, and the way back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (radix, _), rows in _grouped(batches):
            codes, counts = _merge([pairs for _, pairs in rows])
            a = codes // np.uint64(width)
            first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
            most = np.maximum.reduceat(counts, first)
            best = counts == np.repeat(most, np.diff(np.append(first, len(a))))
            yield from _shares(radix, rows, codes, counts, best.astype(np.uint64))
    return run


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(radix, node, child, pairs, gains): a node's gains (child NULL, first), then
    its children, whose union they are aligned with."""
    for (radix, _), rows in _grouped(batches):
        running, best = unpack(rows[0][2], 2)
        children = [(child, pairs) for child, pairs, _ in rows[1:]]
        codes, _ = _merge([pairs for _, pairs in children])
        yield from _shares(radix, children, codes, np.diff(running, prepend=np.uint64(0)), best)


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, radix, gains, pairs, records), runs together: sums of each document."""
    def total(run: int, best: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(count)
        return pa.record_batch([pa.array(np.full(len(at), run)), pa.array(at), pa.array(best[at]), pa.array(count[at])], names=["run", "slot", "n_best", "count_sum"])

    now, best, count, waiting = None, np.zeros(0, np.int64), np.zeros(0, np.int64), None
    for batch in batches:
        for run, _, gains, pairs, records in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if run != now:
                if now is not None:
                    yield total(now, best, count)
                now, best, count = run, np.zeros(0, np.int64), np.zeros(0, np.int64)
            if gains is not None:
                waiting = gains
                continue
            running, wins = unpack(waiting, 2)
            n_docs = unpack(pairs, 2)[1].astype(np.int64)
            slots, links = unpack(records, 2)
            slots = np.diff(slots, prepend=np.uint64(0)).astype(np.int64)
            links = links.astype(np.int64)
            value = np.repeat(np.diff(running, prepend=np.uint64(0)).astype(np.int64), n_docs) * links
            size = max(len(best), int(slots.max()) + 1)
            best, count = (np.append(x, np.zeros(size - len(x), np.int64)) for x in (best, count))
            # integer sums: a float's 53 bits would not hold every total
            order = np.argsort(slots, kind="stable")
            first = np.flatnonzero(np.append(True, slots[order][1:] != slots[order][:-1]))
            at = slots[order][first]
            count[at] += np.add.reduceat(value[order], first)
            best[at] += np.add.reduceat((np.repeat(wins.astype(np.int64), n_docs) * links)[order], first)
    if now is not None:
        yield total(now, best, count)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Alignment of every document under tokenizer A (byte-level BPE, read with a
    space before the text, special tokens as plain text) and B (a merge-type
    SentencePiece model): ``id_col``, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best`` (links whose pair has its A id's highest count, ties
    included), ``count_sum`` (counts over all links) and ``groups_sha256``.

    * NULL and empty texts, and those whose joined tokens of either side differ
      from a space and the text, have zeros and ''.
    * Rows are documents: repeated rows, shared and NULL ids count each.
    * Columns beside the two named ones are ignored, whatever their names.
    * A text is one unit of work, however long; an empty table gives no row.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    id_field = rows.schema["__id"]
    schema = ("run long, slot long, __id " + id_field.dataType.simpleString()
              + ", n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, radix int, pairs binary, records binary")
    made = written(rows.mapInArrow(_run_batches(path_a, path_b, to_arrow_type(id_field.dataType)), schema), "alignment-runs")
    parts = made.where("radix is not null").select("run", "radix", "pairs", "records")
    found = made.where("radix is null").select("run", "slot", F.col("__id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    spark, n = docs.sparkSession, parallelism(docs.sparkSession)
    gains = _counts(parts.select("radix", F.col("run").alias("child"), "pairs"), parts.select("run").distinct().count(), piece_encoder_width(path_b), n)
    null = F.lit(None).cast("binary")
    both = (parts.select("run", "radix", null.alias("gains"), "pairs", "records")
            .unionByName(gains.select(F.col("child").alias("run"), "radix", "gains", null.alias("pairs"), null.alias("records"))))
    # a part's gains come just before it
    streamed = both.repartition(n, "run").sortWithinPartitions("run", "radix", F.col("gains").isNull()).select("run", "radix", "gains", "pairs", "records")
    sums = streamed.mapInArrow(_sum_batches, "run long, slot long, n_best long, count_sum long")
    zero = F.lit(0).cast("long")
    return (found.join(sums, ["run", "slot"], "left")
            .select(id_col, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"))


def piece_encoder_width(path: str) -> int:
    """Pieces of a SentencePiece model file: pairs are ``a * width + b``."""
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


def _counts(runs: DataFrame, n_runs: int, width: int, n: int) -> DataFrame:
    """(radix, child, gains) for every part of a run: counts and winners of its
    pairs.  Levels of ``FAN``: up to one node a radix, and back down."""
    def gathered(df: DataFrame, *last: str) -> DataFrame:
        return df.repartition(n, "radix", "node").sortWithinPartitions("radix", "node", *last)

    levels: list[DataFrame] = []
    nodes = -(-n_runs // FAN)
    while nodes > 1:
        # runs are dealt to nodes by hash: their numbers have gaps
        levels.append(runs.withColumn("node", F.pmod(F.xxhash64("child"), F.lit(nodes))))
        merged_runs = gathered(levels[-1]).select("radix", "node", "child", "pairs").mapInArrow(_up, "radix int, child long, pairs binary")
        runs = written(merged_runs, "alignment-merge")
        nodes = -(-nodes // FAN)
    top = gathered(runs.withColumn("node", F.lit(0).cast("long"))).select("radix", "node", "child", "pairs")
    gains = top.mapInArrow(_top(width), "radix int, child long, gains binary")
    for level in reversed(levels):
        null = F.lit(None)
        mixed = (level.select("radix", "node", "child", "pairs", null.cast("binary").alias("gains"))
                 .unionByName(gains.select("radix", F.col("child").alias("node"), null.cast("long").alias("child"), null.cast("binary").alias("pairs"), "gains")))
        gains = gathered(mixed, "child").select("radix", "node", "child", "pairs", "gains").mapInArrow(_down, "radix int, child long, gains binary")
    return gains
