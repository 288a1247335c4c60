"""Exact byte-level BPE encoding with a piece cache.

A byte-level BPE tokenizer whose pre-tokenizer splits at white space treats a
white-space run with the word after it independently of what stands around it.
Texts are therefore cut before each run of ASCII white space, every distinct
piece is encoded once by the tokenizers library, and the ids are put together.
Texts with other white space or with an added token's string are encoded
whole by the library, so the ids always equal those of the whole text.

New pieces go to the library many at a time, joined to one string: the same
argument says that no token crosses from one to the next, and the tokens' byte
lengths give each piece its ids.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from vitrine.llm import textbuf as tb

#: White space beyond ASCII: texts with it are encoded whole.
_OTHER_SPACE = rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81\x9f|\xe3\x80\x80|\xef\xbb\xbf"
_OTHER_FIRST = (0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF)
#: Text encoded at a time: the cache is merged with the new pieces once for it.
ENCODE_BYTES = 8 << 20
#: Distinct pieces a worker remembers before it starts afresh.
CACHE_PIECES = 1 << 21
SLOT_BITS = 22
#: Pieces joined to one string for the library.
JOINED = 512


class PieceCache:
    """Ids of distinct pieces of text, found by their 64-bit hash.  A subclass
    gives the ids of new pieces (``_pieces``)."""

    def __init__(self) -> None:
        self._forget()

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids of each piece) of distinct pieces."""
        raise NotImplementedError

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # of piece 0, 1, 2, ...
        self.ids, self.id_start, self.id_len = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.byte_len = np.zeros(0, np.int64)
        # two ways from a hash to its piece: by its low bits, by the next ones
        self.slots = [np.full(1 << SLOT_BITS, -1, np.int32) for _ in range(2)]

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash, -1 if it has none (or lost both its slots)."""
        out = np.full(len(h), -1, np.int32)
        if len(self.hashes):
            rest = np.arange(len(h))
            for k, slots in enumerate(self.slots):
                at = slots[self._slot(h[rest], k)]
                good = (at >= 0) & (self.hashes[at] == h[rest])
                out[rest[good]] = at[good]
                rest = rest[~good]
        return out

    @staticmethod
    def _slot(h: np.ndarray, way: int) -> np.ndarray:
        return (h >> np.uint64(way * SLOT_BITS) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)

    def _learn(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Encode distinct pieces and remember them; their numbers."""
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        ids, lens = self._pieces(buf[tb.ranges(starts, ends - starts)], offsets)
        number = np.arange(len(self.hashes), len(self.hashes) + len(hashes), dtype=np.int32)
        self.id_start = np.concatenate([self.id_start, len(self.ids) + np.cumsum(lens) - lens])
        self.id_len = np.concatenate([self.id_len, lens])
        self.ids = np.concatenate([self.ids, ids])
        self.byte_len = np.concatenate([self.byte_len, ends - starts])
        self.hashes = np.concatenate([self.hashes, hashes])
        left = np.arange(len(hashes))
        for k, slots in enumerate(self.slots):
            at = self._slot(hashes[left], k)
            free = slots[at] < 0
            slots[at[free]] = number[left[free]]
            left = left[slots[at] != number[left]]
        return number

    def find_or_learn(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """Number of each span's piece; None if two different pieces share a hash."""
        h = tb.span_hashes(buf, starts, ends)
        if len(self.hashes) > CACHE_PIECES:
            self._forget()
        piece = self._find(h)
        missed = np.flatnonzero(piece < 0)
        if len(missed):
            distinct, first, back = np.unique(h[missed], return_index=True, return_inverse=True)
            first = missed[first]
            piece[missed] = self._learn(buf, starts[first], ends[first], distinct)[back]
        return piece if np.array_equal(self.byte_len[piece], ends - starts) else None


class Encoder(PieceCache):
    """Ids of whole texts by one tokenizer file; with ``plain`` the strings of
    special tokens are ordinary text."""

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        # a token is written with one character per byte
        self.token_bytes = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.token_bytes[number] = len(token)
        # texts that hold one of the tokenizer's added tokens are encoded whole too
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.whole_pattern = re.compile(b"|".join([*map(re.escape, added), _OTHER_SPACE]))
        self.whole_first = np.zeros(256, bool)
        self.whole_first[[*_OTHER_FIRST, *(t[0] for t in added)]] = True
        super().__init__()

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids of each piece) of distinct pieces."""
        n = len(offsets) - 1
        first, last = data[offsets[:-1]], data[offsets[1:] - 1]
        # joined: white space before, none behind; the few others go alone
        order = np.concatenate([joint := np.flatnonzero(tb.SPACE[first] & ~tb.SPACE[last]), alone := np.flatnonzero(~(tb.SPACE[first] & ~tb.SPACE[last]))])
        sizes = offsets[1:] - offsets[:-1]
        body = data[tb.ranges(offsets[order], sizes[order])]
        ends = np.cumsum(sizes[order])
        cuts = np.concatenate([np.arange(JOINED, len(joint), JOINED), np.arange(len(joint), n)])
        bounds = np.concatenate([[0], ends[cuts[cuts > 0] - 1], [len(body)]]).astype(np.int64)
        texts = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(body)).to_pylist()
        flat = np.concatenate(self.whole(texts))
        at = np.concatenate([[0], np.cumsum(self.token_bytes[flat])])
        edge = np.searchsorted(at, np.concatenate([[0], ends]))
        if at[-1] != len(body) or not np.array_equal(at[edge[1:]], ends):
            raise ValueError("the tokenizer's tokens cross white space")
        counts = np.empty(n, np.int64)
        counts[order] = np.diff(edge)
        starts = np.empty(n, np.int64)
        starts[order] = edge[:-1]
        return flat[tb.ranges(starts, counts)], counts

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, n + 1 offsets) of a large-string array (a slice)."""
        buf, off = tb.raw(col)
        n = len(col)
        maybe = np.unique(np.searchsorted(off, np.flatnonzero(self.whole_first[buf]), side="right") - 1)
        special = [k for k in maybe.tolist() if self.whole_pattern.search(buf[off[k]:off[k + 1]].tobytes())]
        space = tb.SPACE[buf]
        begin = np.zeros(len(buf), bool)
        begin[1:] = space[1:] & ~space[:-1]
        begin[off[:-1][off[1:] > off[:-1]]] = True
        starts = np.flatnonzero(begin)
        ends = np.concatenate([starts[1:], [len(buf)]]) if len(starts) else starts
        owner = np.searchsorted(off, starts, side="right") - 1
        if special:
            plain = ~np.isin(owner, special)
            starts, ends, owner = starts[plain], ends[plain], owner[plain]
        piece = self.find_or_learn(buf, starts, ends)
        if piece is None:
            # two pieces with one 64-bit hash: encode the slice without the cache
            special, piece, owner = list(range(n)), np.zeros(0, np.int32), owner[:0]
        lens = self.id_len[piece]
        per_text = np.bincount(owner, weights=lens, minlength=n).astype(np.int64) if len(owner) else np.zeros(n, np.int64)
        extra = self.whole(col.take(pa.array(special, pa.int64())).to_pylist()) if special else []
        for k, x in zip(special, extra, strict=True):
            per_text[k] = len(x)
        offsets = np.concatenate([[0], np.cumsum(per_text)])
        flat = self.ids[tb.ranges(self.id_start[piece], lens)]
        if special:
            out = np.zeros(offsets[-1], np.uint32)
            put = np.ones(len(out), bool)
            for k, x in zip(special, extra, strict=True):
                out[offsets[k]:offsets[k + 1]] = x
                put[offsets[k]:offsets[k + 1]] = False
            out[put] = flat
            flat = out
        return flat, offsets


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, plain: bool = False) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if (path, plain) not in _ENCODERS:
        _ENCODERS[path, plain] = Encoder(path, plain)
    return _ENCODERS[path, plain]
