"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies.

A text becomes a row of symbols (its characters, a space as U+2581).  The
agenda holds every adjacent pair whose joined string is in the vocabulary; the
pair with the best score is joined first, the leftmost among equals, until no
pair is left.  :func:`agenda` does it for one sequence with a heap;
:func:`agendas` does the same steps for many short sequences at once, one join
of each sequence a round.

Two neighbouring characters that no piece of the vocabulary holds side by side
are never joined, so what stands before and after them is independent.  Texts
are cut there (before white space and around line breaks) and each distinct
piece of text is encoded once.  Every result of the agenda is compared with
the sentencepiece library, new pieces of an Arrow batch at a time; the
library's ``decode`` turns the ids back into text.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import textbuf as tb
from vitrine.llm.encode import PieceCache

MARK = "▁"
#: Text encoded at a time: the cache is merged with the new pieces once for it.
BATCH_BYTES = 4 << 20
#: Sequences of more symbols go through the heap one by one.
SHORT = 64
_NEVER = np.int64(1) << 62


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = message[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield number, message[at:at + size]
        at += size


class Vocabulary:
    """Pieces, scores and joins of a merge-type model file.

    Raises ValueError for a model that this method does not cover: another
    model type, a rewriting normalizer, user-defined or unused pieces, or no
    byte fallback."""

    NORMAL, BYTE = 1, 6  # kinds of pieces in a model file

    def __init__(self, model: bytes):
        pieces: list[tuple[str, float, int]] = []
        trainer: dict[int, int | bytes] = {}
        normalizer: dict[int, int | bytes] = {}
        for number, value in _fields(model):
            if number == 1:
                x = dict(_fields(value))
                pieces.append((x[1].decode(), struct.unpack("<f", x.get(2, bytes(4)))[0], x.get(3, self.NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24):
            raise ValueError("not a merge-type model with byte fallback")
        if normalizer.get(2) or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("the model rewrites its input")
        if {kind for _, _, kind in pieces} - {1, 2, 3, 6}:
            raise ValueError("the model has user-defined or unused pieces")
        self.size = len(pieces)
        self.pieces = [p for p, _, _ in pieces]
        normal = {p: k for k, (p, _, kind) in enumerate(pieces) if kind == self.NORMAL}
        self.byte_ids = np.zeros(256, np.int64)
        for k, (p, _, kind) in enumerate(pieces):
            if kind == self.BYTE:
                self.byte_ids[int(p[1:-1], 16)] = k
        self.kinds = [kind for _, _, kind in pieces]
        # symbols: piece ids, and size + code point for characters that are no piece
        self.char = np.arange(0x110000, dtype=np.int64) + self.size
        for p, k in normal.items():
            if len(p) == 1:
                self.char[ord(p)] = k
        self.char[0x20] = self.char[ord(MARK)]
        scores = np.array([s for _, s, _ in pieces], np.float32)
        order = np.unique(-scores, return_inverse=True)[1]
        # joins: (left symbol, right symbol) -> piece
        symbol = normal | {c: int(self.char[ord(c)]) for p in normal for c in p}
        joins = {(symbol[p[:i]], symbol[p[i:]]): k for p, k in normal.items() for i in range(1, len(p)) if p[:i] in symbol and p[i:] in symbol}
        self.width = np.int64(self.size + 0x110000)
        keys = np.array([a * int(self.width) + b for a, b in joins], np.int64)
        to = np.array(list(joins.values()), np.int64)
        by_key = np.argsort(keys)
        self.keys, self.to, self.rank = keys[by_key], to[by_key], order[to[by_key]]
        # ASCII neighbours inside a piece must not be cut apart
        self.cut = np.ones((256, 256), bool)
        self.cut[:, 0x80:] = False
        for p in normal:
            for a, b in zip(p, p[1:]):
                a, b = (" " if c == MARK else c for c in (a, b))
                if ord(b) < 0x80:
                    self.cut[a.encode()[-1], ord(b)] = False
        if not self.cut[:, 0x0A].all() or not self.cut[0x0A, :0x80].all():
            raise ValueError("a piece holds a line break beside another character")

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Position in ``to`` / ``rank`` of each pair's join, -1 if it has none."""
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, -1)


def agenda(symbols: list[int], vocabulary: Vocabulary) -> list[int]:
    """Symbols after all joins, best score first, leftmost among equals."""
    joins = {}

    def found(a: int, b: int) -> tuple[int, int] | None:
        if (a, b) not in joins:
            k = int(vocabulary.join(np.array([a]), np.array([b]))[0])
            joins[a, b] = (int(vocabulary.rank[k]), int(vocabulary.to[k])) if k >= 0 else None
        return joins[a, b]

    n = len(symbols)
    now, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n and (x := found(now[i], now[after[i]])):
            heapq.heappush(heap, (x[0], i, now[i], now[after[i]], x[1]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, a, b, to = heapq.heappop(heap)
        j = after[i]
        if now[i] != a or j >= n or now[j] != b:
            continue  # one of the two has been joined since
        now[i], now[j] = to, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [s for s in now if s >= 0]


def agendas(symbols: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(symbols after all joins, their number in each sequence) of sequences of
    at least one symbol; all agendas advance by one join a round."""
    seq = np.repeat(np.arange(len(counts)), counts)
    sym = symbols.copy()
    done_seq, done_sym = [], []

    def looked_up(at: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Join behind each position; a sequence's last symbol has none."""
        out = np.full(len(at), -1, np.int64)
        inner = ~last
        out[inner] = vocabulary.join(sym[at[inner]], sym[at[inner] + 1])
        return out

    is_last = np.append(seq[1:] != seq[:-1], True) if len(seq) else np.zeros(0, bool)
    join = looked_up(np.arange(len(sym)), is_last)
    while len(sym):
        first = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
        key = np.where(join >= 0, vocabulary.rank[join] << 32 | np.arange(len(sym)), _NEVER)
        best = np.minimum.reduceat(key, first)
        over = best == _NEVER
        lens = np.diff(np.append(first, len(sym)))
        gone = np.repeat(over, lens)
        done_seq.append(seq[gone])
        done_sym.append(sym[gone])
        at = (best[~over] & 0xFFFFFFFF).astype(np.int64)
        sym[at] = vocabulary.to[join[at]]
        stay = ~gone
        stay[at + 1] = False
        changed = np.zeros(len(sym), bool)
        changed[at] = True
        changed[at[at > 0] - 1] = True  # may be another sequence's last: no join either way
        sym, seq, join, changed = sym[stay], seq[stay], join[stay], changed[stay]
        if len(sym):
            redo = np.flatnonzero(changed)
            join[redo] = looked_up(redo, np.append(seq[1:] != seq[:-1], True)[redo])
    all_seq, all_sym = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (done_seq, done_sym))
    order = np.argsort(all_seq, kind="stable")
    return all_sym[order], np.bincount(all_seq, minlength=len(counts))


class PieceEncoder(PieceCache):
    """Ids of whole texts by one SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.vocabulary = Vocabulary(self.library.serialized_model_proto())
        v = self.vocabulary
        surface = [bytes([int(p[1:-1], 16)]) if k == v.BYTE else p.replace(MARK, " ").encode() if k == v.NORMAL else b"" for p, k in zip(v.pieces, v.kinds, strict=True)]
        self.token_bytes = np.array([len(b) for b in surface], np.int64)
        super().__init__()

    def _ids(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of joined symbols: characters outside the vocabulary as UTF-8 bytes."""
        v = self.vocabulary
        other = symbols >= v.size
        if not other.any():
            return symbols, counts
        code = symbols[other] - v.size
        widths = np.ones(len(symbols), np.int64)
        widths[other] = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        out = np.repeat(symbols, widths)
        out[np.repeat(other, widths)] = v.byte_ids[np.frombuffer("".join(map(chr, code.tolist())).encode(), np.uint8)]
        return out, np.bincount(np.repeat(np.arange(len(counts)), counts), weights=widths, minlength=len(counts)).astype(np.int64)

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(offsets) - 1
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        head = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        bounds = head[offsets]
        counts = np.diff(bounds)
        symbols = self.vocabulary.char[codes]
        short = counts <= SHORT
        in_short = np.repeat(short, counts)
        joined, sizes = agendas(symbols[in_short], counts[short], self.vocabulary)
        lens = np.zeros(n, np.int64)
        lens[short] = sizes
        longer = {int(k): agenda(symbols[bounds[k]:bounds[k + 1]].tolist(), self.vocabulary) for k in np.flatnonzero(~short)}
        for k, x in longer.items():
            lens[k] = len(x)
        out = np.zeros(int(lens.sum()), np.int64)
        starts = np.cumsum(lens) - lens
        out[tb.ranges(starts[short], sizes)] = joined
        for k, x in longer.items():
            out[starts[k]:starts[k] + len(x)] = x
        ids, lens = self._ids(out, lens)
        self._check(data, offsets, ids, lens)
        return ids.astype(np.uint32), lens

    def _check(self, data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, lens: np.ndarray) -> None:
        """The library's ids of the same pieces, each after a line break (which
        no piece joins), must be the agenda's."""
        sizes = np.diff(offsets)
        joined = np.full(len(data) + len(sizes), 0x0A, np.uint8)
        joined[tb.ranges(offsets[:-1] + np.arange(1, len(sizes) + 1), sizes)] = data
        expected = np.full(len(ids) + len(lens), self.vocabulary.byte_ids[0x0A], np.int64)
        starts = np.cumsum(lens) - lens
        expected[tb.ranges(starts + np.arange(1, len(lens) + 1), lens)] = ids
        alone = self.library.encode("", add_bos=False) + self.library.encode("\n", add_bos=False)[:-1]
        told = self.library.encode(joined.tobytes().decode())
        if told[:len(alone)] != alone or not np.array_equal(np.array(told[len(alone):], np.int64), expected):
            raise RuntimeError("the agenda's ids differ from the sentencepiece library's")

    def cuts(self, buf: np.ndarray) -> np.ndarray:
        """Bytes that begin a piece of text: after a neighbour that no piece
        joins them to, if either is a line break or they are a space."""
        begin = np.zeros(len(buf), bool)
        if len(buf) > 1:
            near = (buf[1:] == 0x20) | (buf[1:] == 0x0A) | (buf[:-1] == 0x0A)
            at = np.flatnonzero(near)
            begin[at + 1] = self.vocabulary.cut[buf[at], buf[at + 1]]
        return begin

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, n + 1 offsets) of a large-string array (a slice) in which
        every text that is not empty begins with the model's own space."""
        col = spaced(col)
        buf, off = tb.raw(col)
        begin = self.cuts(buf)
        begin[off[:-1][off[1:] > off[:-1]]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(buf)) if len(starts) else starts
        piece = self.find_or_learn(buf, starts, ends)
        owner = np.searchsorted(off, starts, side="right") - 1
        if piece is None:  # two pieces with one 64-bit hash: the slice without the cache
            flat, lens = self._pieces(buf[starts[0]:], np.append(starts, len(buf)))
        else:
            lens = self.id_len[piece]
            flat = self.ids[tb.ranges(self.id_start[piece], lens)]
        per_text = np.bincount(owner, weights=lens, minlength=len(col)).astype(np.int64) if len(owner) else np.zeros(len(col), np.int64)
        return flat, np.append(0, np.cumsum(per_text))


def with_space(col: pa.Array) -> pa.Array:
    """Each text that is not empty after one space, as the model reads it."""
    return pc.if_else(pc.equal(col, ""), col, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), col, pa.scalar("", pa.large_string())))


def spaced(col: pa.Array) -> pa.Array:
    """U+2581, which the model reads as a space, as a space."""
    return pc.replace_substring(col, MARK, " ") if pc.any(pc.match_substring(col, MARK)).as_py() else col


_ENCODERS: dict[str, PieceEncoder] = {}


def piece_encoder(path: str) -> PieceEncoder:
    """This worker's encoder for a model file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _encode_batches(path: str, decode: bool, ends: bool):
    """Last column: the text; the others pass through before the results."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = piece_encoder(path)
        bos, eos = e.library.bos_id(), e.library.eos_id()
        for batch in batches:
            col = tb.string_column(batch.columns[-1])
            for i, j in tb.slices(col, BATCH_BYTES):
                flat, off = e.encode(with_space(col[i:j]))
                counts = np.diff(off) + 2 * ends
                at = np.append(0, np.cumsum(counts))
                ids = np.empty(at[-1], "<u4")
                ids[tb.ranges(at[:-1] + ends, counts - 2 * ends)] = flat
                if ends:
                    ids[at[:-1]], ids[at[1:] - 1] = bos, eos
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(at * 4), pa.py_buffer(ids)])
                out = [*(c[i:j] for c in batch.columns[:-1]), pa.array(counts), packed.cast(pa.binary()) if at[-1] * 4 < 1 << 31 else packed]
                if decode:
                    numbers = ids.tolist()
                    out.append(pa.array([e.library.decode(numbers[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.string()))
                yield pa.record_batch(out, names=[f"c{k}" for k in range(len(out))])
    return run


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", ends: bool = True, decode: bool = False) -> DataFrame:
    """``id_col``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit numbers)
    and, with ``decode``, ``decoded``: the library's text of these ids.

    * A NULL text is empty; with ``ends`` it has the begin and end id alone.
    * A row for each row: repeated ids and texts stay, NULL ids too.
    * Columns beside the two named ones are ignored, whatever their names.
    * A text is one unit of work, however long; an empty table gives no row.
    * U+2581 in a text is read as a space, as the library does, and decoded as one.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    schema = rows.select("__id").schema.add("n_tokens", "long").add("ids", "binary")
    out = rows.mapInArrow(_encode_batches(model, decode, ends), schema.add("decoded", "string") if decode else schema)
    return out.withColumnRenamed("__id", id_col)
