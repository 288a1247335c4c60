"""Near-duplicate classes: fast similarity sketches, banding, exact check.

Sketch
    Every distinct shingle is thrown into one of ``t`` bins by a fresh hash
    each round; a bin keeps the value of the earliest round and, within it,
    the smallest hash.  Rounds go on until each bin is filled, at most ``t``
    of them, and round ``t + k`` puts all shingles in bin ``k``, so every
    coordinate fills.  Coordinates agree with probability equal to the Jaccard
    similarity, with concentration as for independent samples.
Banding
    ``r`` coordinates form a band; :func:`plan` takes the largest ``r`` for
    which the bands that push the miss rate at the threshold below 1e-6 fit
    the sketch.
Exact check
    Documents connected by equal bands form candidate clusters.  The whole
    shingle sets of a cluster meet in bounded blocks; in each pair of blocks an
    inverted index counts all intersections, and only a spanning star of the
    true links leaves the task.  No pair list is ever written.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import textbuf as tb
from vitrine.llm.common import components, step, written

MISS = 1e-6
MAX_COORDINATES = 360
#: Most shingles and documents of one block.
BLOCK_SHINGLES = 1 << 19
BLOCK_DOCS = 1024
_EMPTY = np.uint64((1 << 64) - 1)


def plan(percent: int) -> tuple[int, int]:
    """(rows per band, bands) for links from ``percent`` % similarity on; raises
    where no plan keeps the chance of a missed link below ``MISS`` (under 4 %)."""
    sim = percent / 100
    best = None
    for r in range(1, 16):
        hit = sim ** r
        b = 1 if hit >= 1 else math.ceil(math.log(MISS) / math.log1p(-hit))
        if r * b <= MAX_COORDINATES:
            best = (r, b)
    if best is None:
        raise ValueError(f"{percent} %: no band plan of {MAX_COORDINATES} coordinates finds links of so little similarity")
    return best


def shingle_sets(col: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each text) per slice."""
    for i, j in tb.slices(col):
        buf, off = tb.raw(col[i:j])
        buf = tb.LOWER[buf]
        s, e = tb.spans(~tb.SPACE[buf], off)
        h = tb.span_hashes(buf, s, e)
        at = tb.per_text(s, off)
        wide = tb.window_hashes(h, width)
        sets = []
        for k in range(j - i):
            a, b = int(at[k]), int(at[k + 1])
            if b - a >= width:
                sets.append(np.unique(wide[a:b - width + 1]))
            elif b > a:
                sets.append(tb.window_hashes(h[a:b], b - a) ^ np.uint64(b - a))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield i, sets


def sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Fast similarity sketch of each non-empty set: ``len(sets)`` x ``t``."""
    out = np.full((len(sets), t), _EMPTY, np.uint64)
    flat = out.reshape(-1)
    lens = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), lens)
    items = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    for k in range(2 * t):
        if not len(items):
            break
        x = tb.mix(items + np.uint64((k + 1) * 0xA0761D6478BD642F & ((1 << 64) - 1)))
        if k < t:
            bins = ((x >> np.uint64(40)) * np.uint64(t) >> np.uint64(24)).astype(np.int64)
        else:
            bins = np.full(len(x), k - t, np.int64)
        value = np.uint64(k << 40) | (x & np.uint64((1 << 40) - 1))
        np.minimum.at(flat, owner * t + bins, value)
        more = (out == _EMPTY).any(axis=1)[owner]
        items, owner = items[more], owner[more]
    return out


def bands_of(sketches: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit key per band."""
    out = np.empty((len(sketches), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(sketches), b + 1, np.uint64)
        for k in range(rows):
            key = tb.mix(key * np.uint64(0x9FB21C651E98DF25) + sketches[:, b * rows + k])
        out[:, b] = key
    return out.view(np.int64)


def _sketch_batches(rows: int, bands: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, col = batch.column(0), tb.string_column(batch.column(1))
            for i, sets in shingle_sets(col, width):
                full = [k for k, s in enumerate(sets) if len(s)]
                keys = bands_of(sketch([sets[k] for k in full], rows * bands), rows, bands)
                sizes = np.zeros(len(sets), np.int64)
                digest: list[bytes | None] = [None] * len(sets)
                lens = np.zeros(len(sets), np.int64)
                for k in full:
                    sizes[k] = len(sets[k])
                    digest[k] = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest()
                    lens[k] = bands
                offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))
                yield pa.record_batch([ids[i:i + len(sets)], pa.array(sizes), pa.array(digest, pa.binary()), lists],
                                      names=["doc_id", "n_shingles", "digest", "bands"])
    return run


def _set_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = tb.string_column(batch.column(1))
            for i, sets in shingle_sets(col, width):
                yield pa.record_batch([batch.column(0)[i:i + len(sets)], pa.array([s.tobytes() for s in sets], pa.binary())],
                                      names=["id", "shingles"])
    return run


def linked(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Star edges of the components of the sets' exact similarity graph."""
    n = len(sets)
    lens = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), lens)
    items = np.concatenate(sets)
    by = np.argsort(items, kind="stable")
    found, first, counts = np.unique(items[by], return_index=True, return_counts=True)
    posting = owner[by]
    term = np.repeat(np.arange(len(found)), counts)
    back = np.empty(len(items), np.int64)
    back[by] = term
    at = np.concatenate([[0], np.cumsum(lens)])
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for k in range(n):
        terms = back[at[k]:at[k + 1]]
        shared = counts[terms]
        terms, shared = terms[shared > 1], shared[shared > 1]
        if not len(terms):
            continue
        both = np.bincount(posting[tb.ranges(first[terms], shared)], minlength=n)
        both[:k + 1] = 0
        for j in np.flatnonzero(100 * both >= percent * (lens + lens[k] - both)):
            if both[j]:
                a, b = find(k), find(int(j))
                if a != b:
                    root[max(a, b)] = min(a, b)
    groups: dict[int, list[int]] = {}
    for k in range(n):
        groups.setdefault(find(k), []).append(int(ids[k]))
    return [(min(g), x) for g in groups.values() if len(g) > 1 for x in g if x != min(g)]


def _link_batches(percent: int):
    """Rows sorted by (cluster, lo, hi): one block pair after the other."""
    def done(key: tuple, rows: list[tuple[int, bytes]]) -> list[tuple[int, int]]:
        if len(rows) < 2:
            return []
        return linked(np.array([r[0] for r in rows], np.int64), [np.frombuffer(r[1], np.uint64) for r in rows], percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            edges = []
            for c, lo, hi, i, s in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if (c, lo, hi) != key:
                    edges += done(key, rows)
                    key, rows = (c, lo, hi), []
                rows.append((i, s))
            if edges:
                yield _edges(edges)
        if edges := done(key, rows):
            yield _edges(edges)
    return run


def _edges(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])


def duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, width: int = 5) -> DataFrame:
    """Near-duplicate component of every document.

    Two documents are linked when ``100 * intersection >= percent * union`` on
    their sets of ``width``-word shingles (A-Z lower-cased; a text with fewer
    words is one shingle).  Returns one row per input row: the id column,
    ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept``
    (id equals component).

    * NULL, empty and blank texts have no shingle and are linked with nothing.
    * Rows that share an id count as one document and merge.
    * A NULL id can't name a component: its row takes the component of its
      exact copies that have an id, or NULL; it is kept only in the latter case.
    * Extra columns are ignored; an empty table gives an empty result.
    """
    rows, bands = plan(percent)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketches = written(docs.mapInArrow(_sketch_batches(rows, bands, width), "doc_id long, n_shingles long, digest binary, bands array<long>"), "sketches")

    # exact copies: one representative per distinct set
    reps = (sketches.where("n_shingles > 0 and doc_id is not null").groupBy("digest")
            .agg(F.min("doc_id").alias("id"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands")))
    reps = written(reps, "representatives")
    exploded = reps.select("id", F.explode("bands").alias("band"))
    heads = exploded.groupBy("band").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("members")).where("members > 1")
    clusters = step(components(exploded.join(heads.select("band", "head"), "band")
                                       .select(F.col("head").alias("a"), F.col("id").alias("b"))))

    # blocks of a cluster, every pair of blocks once
    members = clusters.withColumnRenamed("component", "cluster").join(reps.groupBy("id").agg(F.sum("n").alias("n")), "id")
    blocks = members.groupBy("cluster").agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_DOCS)).cast("int").alias("blocks"))
    other = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != F.col("block")))
    placed = (members.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
              .select("id", "cluster", "block", F.explode(other).alias("with"))
              .select("id", "cluster", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi")))
    wanted = written(members.select("id").distinct(), "candidates")
    sets = (docs.withColumnRenamed("doc_id", "id").join(wanted, "id", "left_semi")
            .select("id", "text").mapInArrow(_set_batches(width), "id long, shingles binary"))
    meet = (placed.join(sets, "id").select("cluster", "lo", "hi", "id", "shingles")
            .repartition("cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi"))
    links = meet.mapInArrow(_link_batches(percent), "a long, b long")
    found = components(links).withColumnRenamed("component", "component_id")

    named = reps.select("digest", "id").join(found, "id", "left").select("digest", F.coalesce("component_id", "id").alias("component_id"))
    out = sketches.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select(F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.col("component_id").isNull()))
