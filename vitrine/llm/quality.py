"""Document quality rules as a short-circuit cascade.

A rule needs one or more signals of the text and rejects a document by a
comparison of them.  :func:`plan_cascade` measures, on a sample, the seconds
each rule's signals take and the share of documents it rejects, and orders the
rules by rejections per second; :func:`cascade` then evaluates them in that
order and computes a rule's signals only for documents that no earlier rule
rejected.  The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import textbuf as tb

WINDOW = 8
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


class Texts:
    """One slice of texts; parts of the analysis are made on demand, once."""

    def __init__(self, col: pa.Array):
        self.col = col
        self.buf, self.off = tb.raw(col)
        self._made: dict[str, np.ndarray] = {}

    def part(self, name: str, make: Callable[[], np.ndarray]) -> np.ndarray:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.part("words", lambda: tb.spans(~tb.SPACE[self.buf], self.off))

    def word_bounds(self) -> np.ndarray:
        return self.part("bounds", lambda: tb.per_text(self.words()[0], self.off))

    def line_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, key) of each line that has a word; equal lines of a text share the key."""
        def make():
            s, e = tb.spans(self.buf != 10, self.off)
            some = np.concatenate([[0], np.cumsum(~tb.SPACE[self.buf])])
            full = some[e] > some[s]
            s, e = s[full], e[full]
            text = np.searchsorted(self.off, s, side="right") - 1
            return text, tb.mix(tb.span_hashes(self.buf, s, e) + text.astype(np.uint64))
        return self.part("lines", make)

    def sums(self, member: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(member, dtype=np.int64)])
        return total[self.off[1:]] - total[self.off[:-1]]


def _n_words(t: Texts) -> np.ndarray:
    return np.diff(t.word_bounds())


def _word_chars(t: Texts) -> np.ndarray:
    return t.sums(~tb.SPACE[t.buf] & ((t.buf & 0xC0) != 0x80))


def _n_symbols(t: Texts) -> np.ndarray:
    return t.sums(_SYMBOLS[t.buf])


def _n_lines(t: Texts) -> np.ndarray:
    return np.bincount(t.line_keys()[0], minlength=len(t.col)).astype(np.int64)


def _n_dup_lines(t: Texts) -> np.ndarray:
    text, key = t.line_keys()
    _, first = np.unique(key, return_index=True)
    return _n_lines(t) - np.bincount(text[first], minlength=len(t.col))


def _n_repeat_words(t: Texts) -> np.ndarray:
    s, e = t.words()
    at = t.word_bounds()
    wide = tb.window_hashes(tb.span_hashes(t.buf, s, e), WINDOW)
    counts = np.diff(at)
    start = tb.ranges(at[:-1], np.maximum(counts - WINDOW + 1, 0))
    owner = np.repeat(np.arange(len(counts)), np.maximum(counts - WINDOW + 1, 0))
    key = tb.mix(wide[start] + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.sort(key)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    edge = np.zeros(len(s) + 1, np.int64)
    if len(twice):
        at_twice = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        start = start[twice[at_twice] == key]
        np.add.at(edge, start, 1)
        np.add.at(edge, start + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    return covered[at[1:]] - covered[at[:-1]]


#: signal -> int64 value per text
SIGNALS: dict[str, Callable[[Texts], np.ndarray]] = {
    "n_words": _n_words, "word_chars": _word_chars, "n_symbols": _n_symbols, "n_lines": _n_lines,
    "n_dup_lines": _n_dup_lines, "n_repeat_words": _n_repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """Rejects a document when ``factor * left > bound * right`` (or ``left < bound`` with no ``right``)."""

    name: str
    left: str
    factor: int
    bound: int
    right: str | None = None

    def signals(self) -> tuple[str, ...]:
        return (self.left, self.right) if self.right else (self.left,)

    def rejects(self, value: dict[str, np.ndarray]) -> np.ndarray:
        if self.right is None:
            return value[self.left] < self.bound
        return self.factor * value[self.left] > self.bound * value[self.right]

    def sql(self) -> str:
        if self.right is None:
            return f"{self.left} < {self.bound}"
        return f"{self.factor} * {self.left} > {self.bound} * {self.right}"


#: Rules every document must pass first.
BASE = (Rule("too_few_words", "n_words", 1, 20), Rule("repeated_windows", "n_repeat_words", 100, 30, "n_words"))
#: Production rules: words of two to twenty characters on average, at most 0.1
#: symbols a word (the usual bound), at most 30 % of the lines repeated.
RULES = (*BASE,
         Rule("short_words", "n_words", 2, 1, "word_chars"),
         Rule("long_words", "word_chars", 1, 20, "n_words"),
         Rule("symbols", "n_symbols", 10, 1, "n_words"),
         Rule("repeated_lines", "n_dup_lines", 100, 30, "n_lines"))


def _measure(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = tb.string_column(batch.column(0))
            for i, j in tb.slices(col):
                rows = []
                for rule in rules:
                    texts = Texts(col[i:j])  # nothing shared: each rule shows its own cost
                    began = time.perf_counter()
                    rejected = rule.rejects({s: SIGNALS[s](texts) for s in rule.signals()})
                    rows.append((rule.name, time.perf_counter() - began, j - i, int(rejected.sum())))
                yield pa.record_batch([pa.array(x) for x in zip(*rows, strict=True)], names=["rule", "seconds", "texts", "rejected"])
    return run


def plan_cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", fraction: float = 0.02, seed: int = 7) -> list[Rule]:
    """Rules in order of rejections per second, measured on a sample of rows.

    Rules the sample can't tell apart keep their given order (an empty sample
    keeps it altogether).
    """
    sample = docs.select(F.col(text_col).cast("string").alias("text")).sample(fraction, seed)
    seen = {r["rule"]: r for r in sample.mapInArrow(_measure(rules), "rule string, seconds double, texts long, rejected long")
            .groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect()}

    def gain(rule: Rule) -> float:
        r = seen.get(rule.name)
        return r["rejected"] / max(r["seconds"], 1e-9) if r else 0.0
    return sorted(rules, key=lambda rule: -gain(rule))


def judge(col: pa.Array, order: list[Rule], keep_signals: tuple[str, ...] = ()) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Verdict of each text by the ordered rules, and ``keep_signals`` of every text."""
    n = len(col)
    rejected = np.zeros(n, bool)
    whole = Texts(col)
    rows, texts = np.arange(n), whole
    for rule in order:
        alive = ~rejected[rows]
        if not alive.any():
            break
        if alive.mean() < 0.8:  # worth narrowing the slice to the documents still in question
            rows = rows[alive]
            texts = Texts(texts.col.filter(pa.array(alive)))
        made = {s: texts.part(f"signal {s}", lambda s=s: SIGNALS[s](texts)) for s in rule.signals()}
        rejected[rows] |= rule.rejects(made)
    return ~rejected, {s: whole.part(f"signal {s}", lambda s=s: SIGNALS[s](whole)) for s in keep_signals}


def _judge_batches(order: list[Rule], text_at: int, keep_signals: tuple[str, ...], drop: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = tb.string_column(batch.column(text_at))
            for i, j in tb.slices(col):
                kept, values = judge(col[i:j], order, keep_signals)
                part = batch.slice(i, j - i)
                if drop:
                    yield part.filter(pa.array(kept))
                else:
                    columns = [*part.columns, *(pa.array(values[s]) for s in keep_signals), pa.array(kept)]
                    yield pa.record_batch(columns, names=[f"c{k}" for k in range(len(columns))])
    return run


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", keep_signals: tuple[str, ...] = (),
            drop: bool = False, order: list[Rule] | None = None) -> DataFrame:
    """All columns of ``docs`` plus ``keep_signals`` (long) and ``kept``; with
    ``drop``, the kept rows unchanged and no further column.

    NULL counts as the empty text, which has no word and fails the base rules.
    Input columns named like an added one are replaced by it.  Other columns,
    repeated rows and ids pass through untouched; an empty table stays empty.
    """
    order = order or plan_cascade(docs, rules, text_col)
    added = () if drop else (*keep_signals, "kept")
    fields = [f for f in docs.schema.fields if f.name not in added or f.name == text_col]
    if text_col in added:
        raise ValueError(f"the text column can't be named {text_col!r}")
    names = [f.name for f in fields]
    schema = docs.select(*(F.col(f"`{n}`") for n in names)).schema
    for s in added:
        schema = schema.add(s, "boolean" if s == "kept" else "long")
    return docs.select(*(F.col(f"`{n}`") for n in names)).mapInArrow(
        _judge_batches(order, names.index(text_col), tuple(keep_signals), drop), schema)
