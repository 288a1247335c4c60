"""Benchmark decontamination with an FM-index per training shard.

Phrases
    Each benchmark item gives its windows of ``width`` consecutive words (one
    shorter window if it has fewer words).
Index
    A shard is a run of documents of about ``SHARD_BYTES``.  Its words become
    symbols of the phrases' vocabulary; stretches of other words, and the
    borders of documents, become separators, which no phrase holds.  From the
    suffix order the Burrows-Wheeler sequence is stored as a wavelet matrix of
    rank bit vectors, with the text position of every ``SAMPLE``-th symbol and
    of each symbol after a separator.
Search
    All phrases go backwards through the wavelet ranks together; rows found
    are walked to the next sampled position, and the words they cover merge
    into removal spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm import textbuf as tb

SHARD_BYTES = 8 << 20
SAMPLE = 16
#: Benchmark text that one pass carries; a larger benchmark takes more passes.
PASS_BYTES = 32 << 20
SPANS = T.ArrayType(T.StructType([T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType())]))


class RankBits:
    """Bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])[:-1].astype(np.int32)
        self.ones = int(bits.sum())

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position ``i``."""
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & below).astype(np.int64)


class WaveletMatrix:
    """Rank and access on a sequence of symbols below ``2 ** bits``."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.levels: list[tuple[int, RankBits, int]] = []
        x = seq
        for level in reversed(range(bits)):
            b = (x >> level) & 1 == 1
            vector = RankBits(b)
            self.levels.append((level, vector, len(x) - vector.ones))
            x = np.concatenate([x[~b], x[b]])
        self.start = np.zeros(1 << bits, np.int64)
        found, first = np.unique(x, return_index=True)
        self.start[found] = first

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before position ``i``."""
        for level, vector, zeros in self.levels:
            one = vector.rank(i)
            i = np.where((symbol >> level) & 1 == 1, zeros + one, i - one)
        return i - self.start[symbol]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at ``i`` and its occurrences before ``i``."""
        symbol = np.zeros(len(i), np.int64)
        for level, vector, zeros in self.levels:
            bit, one = vector.get(i), vector.rank(i)
            symbol |= bit.astype(np.int64) << level
            i = np.where(bit, zeros + one, i - one)
        return symbol, i - self.start[symbol]


def suffix_order(text: np.ndarray, bits: int) -> np.ndarray:
    """Suffixes of ``text`` in order; separators (0) are distinct, by position.

    One sort by the first symbols that fit a word, then prefix doubling on the
    suffixes that still tie.
    """
    n = len(text)
    place = max(1, n.bit_length())
    depth = max(1, (64 - place) // bits)
    key = np.zeros(n, np.uint64)
    alive = np.ones(n, bool)
    for k in range(depth):
        symbol = np.zeros(n, np.uint64)
        symbol[:max(n - k, 0)] = text[k:]
        symbol[~alive] = 0
        key = (key << np.uint64(bits)) | symbol
        alive &= symbol > 0
    order = np.sort((key << np.uint64(place)) | np.arange(n, dtype=np.uint64))
    order = (order & np.uint64((1 << place) - 1)).astype(np.int64)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    # suffixes without a separator so far may tie with their neighbours
    sorted_key = key[order]
    same = np.zeros(n, bool)
    same[1:] = sorted_key[1:] == sorted_key[:-1]
    open_ = alive[order]
    group = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    tie = same.copy()
    tie[:-1] |= same[1:]
    at = np.flatnonzero(tie & open_)
    while len(at):
        head = group[at]
        rank[order[at]] = head
        suffix = order[at]
        nxt = rank[np.minimum(suffix + depth, n - 1)]
        by = np.lexsort((nxt, head))
        suffix, head, nxt = suffix[by], head[by], nxt[by]
        order[at] = suffix
        equal = np.zeros(len(at), bool)
        equal[1:] = (head[1:] == head[:-1]) & (nxt[1:] == nxt[:-1])
        new_group = np.maximum.accumulate(np.where(equal, 0, at))
        # every member of an equal run keeps the run's first place as its rank
        rank[suffix] = new_group
        group[at] = new_group
        tie = equal.copy()
        tie[:-1] |= equal[1:]
        at = at[tie]
        depth *= 2
    return order


class FMIndex:
    """Backward search and locating on a sequence whose symbol 0 separates."""

    def __init__(self, text: np.ndarray, bits: int):
        order = suffix_order(text, bits)
        bwt = text[order - 1].astype(np.int64)
        self.size = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])
        self.wavelet = WaveletMatrix(bwt, bits)
        sampled = (order % SAMPLE == 0) | (bwt == 0)
        self.marks = RankBits(sampled)
        self.positions = order[sampled].astype(np.int32)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix rows ``[lo, hi)`` that begin with each phrase (one length)."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for k in reversed(range(phrases.shape[1])):
            symbol = phrases[live, k]
            lo[live] = self.first[symbol] + self.wavelet.rank(symbol, lo[live])
            hi[live] = self.first[symbol] + self.wavelet.rank(symbol, hi[live])
            live = live[lo[live] < hi[live]]
        empty = np.ones(len(phrases), bool)
        empty[live] = False
        hi[empty] = lo[empty]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix row."""
        out = np.zeros(len(rows), np.int64)
        at, row, steps = np.arange(len(rows)), rows, 0
        while len(at):
            known = self.marks.get(row)
            out[at[known]] = self.positions[self.marks.rank(row[known])] + steps
            at, row = at[~known], row[~known]
            if len(at):
                symbol, before = self.wavelet.access(row)
                row = self.first[symbol] + before
            steps += 1
        return out


class Phrases:
    """Distinct phrases of one benchmark part, by length, with their items."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        col = tb.string_column(pa.array([t for _, t in items], pa.string()))
        buf, off = tb.raw(col)
        buf = tb.LOWER[buf]
        s, e = tb.spans(tb.ALNUM[buf], off)
        h = tb.span_hashes(buf, s, e)
        at = tb.per_text(s, off)
        self.vocabulary, symbol = np.unique(h, return_inverse=True)
        symbol = symbol.astype(np.int64) + 1
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.items = [i for i, _ in items]
        owners: dict[tuple[int, ...], set[int]] = {}
        for k in range(len(items)):
            words = symbol[at[k]:at[k + 1]].tolist()
            for i in range(max(len(words) - width + 1, min(1, len(words)))):
                owners.setdefault(tuple(words[i:i + width]), set()).add(k)
        self.by_length: dict[int, tuple[np.ndarray, list[list[int]]]] = {}
        for length in sorted({len(p) for p in owners}):
            same = [p for p in owners if len(p) == length]
            self.by_length[length] = (np.array(same, np.int64), [sorted(owners[p]) for p in same])
        self.longest = max(self.by_length, default=0)
        # open-addressed by the hash's low bits: word -> symbol
        self.slot_bits = max(16, (4 * len(self.vocabulary)).bit_length())
        self.table = np.zeros(1 << self.slot_bits, np.int32)
        slot = (self.vocabulary & np.uint64((1 << self.slot_bits) - 1)).astype(np.int64)
        self.crowded = len(np.unique(slot)) < len(slot)
        self.table[slot] = np.arange(1, len(slot) + 1)

    def symbols(self, h: np.ndarray) -> np.ndarray:
        """Symbol of each word hash, 0 for words of no phrase."""
        if not len(self.vocabulary):
            return np.zeros(len(h), np.int64)
        if self.crowded:
            k = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
            return np.where(self.vocabulary[k] == h, k + 1, 0)
        k = self.table[(h & np.uint64((1 << self.slot_bits) - 1)).astype(np.int64)].astype(np.int64)
        return np.where((k > 0) & (self.vocabulary[np.maximum(k - 1, 0)] == h), k, 0)


def occurrences(symbols: np.ndarray, at: np.ndarray, phrases: Phrases, limit: int = 1 << 22) -> Iterator[tuple[int, int, np.ndarray]]:
    """(length, phrase number, first words) of each phrase found in a shard.

    ``symbols``: of all words; ``at``: first word of each document.  The
    separated sequence is indexed in pieces of ``limit`` symbols that overlap
    by the longest phrase, so one huge document stays within bounds.
    """
    kept = np.flatnonzero(symbols)
    if not len(kept):
        return
    border = np.zeros(len(symbols) + 1, bool)
    border[at] = True
    fresh = np.ones(len(kept), bool)
    fresh[1:] = (kept[1:] != kept[:-1] + 1) | border[kept[1:]]
    place = np.cumsum(1 + fresh) - 1
    text = np.zeros(place[-1] + 2, np.int64)
    text[place] = symbols[kept]
    word = np.full(len(text), -1, np.int64)
    word[place] = kept
    step = limit - phrases.longest
    for begin in range(0, len(text), step):
        piece = text[begin:begin + limit]
        index = FMIndex(np.concatenate([[0], piece, [0]]), phrases.bits)
        for length, (matrix, _) in phrases.by_length.items():
            lo, hi = index.search(matrix)
            found = np.flatnonzero(hi > lo)
            rows = tb.ranges(lo[found], hi[found] - lo[found])
            first = word[index.locate(rows) - 1 + begin]
            which = np.repeat(found, hi[found] - lo[found])
            cut = np.flatnonzero(np.diff(which)) + 1
            for number, group in zip(found, np.split(first, cut), strict=False):
                yield length, int(number), group


def scan_texts(col: pa.Array, phrases: Phrases) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str]], tuple]:
    """Per text: words, merged (first, last) word spans, matched item ids."""
    buf, off = tb.raw(col)
    buf = tb.LOWER[buf]
    s, e = tb.spans(tb.ALNUM[buf], off)
    at = tb.per_text(s, off)
    symbols = phrases.symbols(tb.span_hashes(buf, s, e))
    edge = np.zeros(len(s) + 1, np.int64)
    items: list[set[int]] = [set() for _ in range(len(col))]
    for length, number, first in occurrences(symbols, at[:-1], phrases):
        np.add.at(edge, first, 1)
        np.add.at(edge, first + length, -1)
        owners = phrases.by_length[length][1][number]
        for doc in np.unique(np.searchsorted(at, first, side="right") - 1):
            items[doc].update(owners)
    hit = np.cumsum(edge[:-1]) > 0
    border = np.zeros(len(s) + 1, bool)
    border[at] = True
    hits = np.flatnonzero(hit)
    merged: list[list[tuple[int, int]]] = [[] for _ in range(len(col))]
    if len(hits):
        new = np.ones(len(hits), bool)
        new[1:] = (hits[1:] != hits[:-1] + 1) | border[hits[1:]]
        begin = np.flatnonzero(new)
        first, last = hits[begin], hits[np.concatenate([begin[1:], [len(hits)]]) - 1]
        owner = np.searchsorted(at, first, side="right") - 1
        for d, a, b in zip(owner.tolist(), first.tolist(), last.tolist(), strict=True):
            merged[d].append((a - int(at[d]), b - int(at[d])))
    names = [sorted({phrases.items[k] for k in found if phrases.items[k] is not None}) for found in items]
    return np.diff(at), merged, names, (s, e, at, off)


def cut(text: bytes, begin: list[int], end: list[int]) -> str:
    """``text`` without the byte ranges; what stood around one meets at a line break."""
    parts, last = [], 0
    for a, b in zip(begin, end, strict=True):
        parts.append(text[last:a])
        last = b
    parts.append(text[last:])
    return b"\n".join(p for p in parts if p.strip()).decode()


def _scan_batches(handle: Broadcast, text_at: int, clean: bool, merge: bool):
    """``merge``: the last three columns hold an earlier pass' result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = handle.value
        for batch in batches:
            own = batch.columns[:-3] if merge else batch.columns
            col = tb.string_column(batch.column(text_at))
            for i, j in tb.slices(col, SHARD_BYTES):
                n_words, spans, items, (s, e, at, off) = scan_texts(col[i:j], phrases)
                if merge:
                    for k, (old, ids) in enumerate(zip(batch.column(len(own) + 1)[i:j].to_pylist(), batch.column(len(own) + 2)[i:j].to_pylist(), strict=True)):
                        spans[k] = _joined([(x["first_word"], x["last_word"]) for x in old] + spans[k])
                        items[k] = sorted({*ids, *items[k]})
                columns = [c[i:j] for c in own]
                if clean:
                    texts = columns[text_at].to_pylist()
                    for k, found in enumerate(spans):
                        if found:
                            a = [int(s[at[k] + x] - off[k]) for x, _ in found]
                            b = [int(e[at[k] + y] - off[k]) for _, y in found]
                            texts[k] = cut(texts[k].encode(), a, b)
                    columns[text_at] = pa.array(texts, pa.string())
                columns += [pa.array(n_words.astype(np.int64)),
                            pa.array([[{"first_word": a, "last_word": b} for a, b in x] for x in spans],
                                     pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64())]))),
                            pa.array(items, pa.list_(pa.string()))]
                yield pa.record_batch(columns, names=[f"c{k}" for k in range(len(columns))])
    return run


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", width: int = 10, clean: bool = False) -> DataFrame:
    """All columns of ``docs`` plus ``n_words``, ``spans`` (merged first / last
    word of what benchmark phrases cover) and ``items`` (ids, sorted as
    strings).  With ``clean`` the text comes back without the spans.

    Words are runs of letters, digits and non-ASCII characters, A-Z
    lower-cased.  A benchmark beyond ``PASS_BYTES`` is taken in several passes
    over the documents, each with a bounded part of the items.

    * NULL and empty texts have no words and no spans; an item without words
      gives no phrase; a NULL item id marks words but is not listed.
    * Repeated documents are searched each for itself; repeated items count once.
    * Input columns named like an added one are replaced by it.
    * Empty documents or an empty benchmark give an empty, or an unmarked, result.
    """
    spark = docs.sparkSession
    added = ("n_words", "spans", "items")
    names = [f.name for f in docs.schema.fields if f.name not in added]
    if text_col not in names:
        raise ValueError(f"the text column can't be named {text_col!r}")
    schema = docs.select(*(F.col(f"`{n}`") for n in names)).schema
    schema = schema.add("n_words", T.LongType()).add("spans", SPANS).add("items", T.ArrayType(T.StringType()))
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("body")).where("body is not null")
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    passes = total // PASS_BYTES + 1
    out = docs.select(*(F.col(f"`{n}`") for n in names))
    for k in range(passes):
        part = items if passes == 1 else items.where(F.pmod(F.xxhash64("item", "body"), F.lit(passes)) == k)
        phrases = spark.sparkContext.broadcast(Phrases([tuple(r) for r in part.collect()], width))
        # spans count words of the given text, so it is cut in the last pass
        out = out.mapInArrow(_scan_batches(phrases, names.index(text_col), clean and k == passes - 1, k > 0), schema)
    return out
