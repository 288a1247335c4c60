"""Linear classifiers on sparse rows of any width (MDL04, MDL08): conjugate
gradients and L-BFGS whose products are aggregates over packed row blocks.

Nothing of size features x features exists.  Rows are packed once into blocks
(:func:`row_blocks`); each step broadcasts a features x classes matrix, every
task multiplies its blocks with it and back, and the tasks' partial results are
added up by feature range (:func:`totals`).  Classes are solved in groups
(:func:`class_groups`): no column of a solution depends on another one, so the
driver holds the model, at most ``MODEL_NUMBERS`` numbers, and a handful of
matrices of ``GROUP_NUMBERS``.

* :func:`fit_ridge`: the normal equations of all classes together.
* :func:`fit_svm`: squared hinge loss by Newton steps, each a conjugate gradient
  over the rows inside the margin, with a line search that tries all step sizes
  in one pass; a path of C values starts each at the last one's solution.
* :func:`fit_logistic`: softmax loss by L-BFGS, all classes together.

Blocks are files in the shared folder that the tasks map, so a pass moves no rows
between processes.  Ridge and SVM classes are solved whole in a task each where the
features x classes numbers of a job a pass would cost more (:func:`_alone`).
"""

from __future__ import annotations

import heapq
import itertools
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and entries of a block.
BLOCK_ROWS, BLOCK_ENTRIES = 1 << 13, 1 << 18
#: Entries whose scores are computed together in a prediction.
SCORE_ENTRIES = 1 << 17
#: Features that one task adds up.
RANGE = 1 << 13
#: Largest features x classes matrix: 1 GB of doubles.
MODEL_NUMBERS = 1 << 27
#: Numbers of a matrix of the classes that are solved together: 16 MB of doubles.
GROUP_NUMBERS = 1 << 21
#: Numbers that the tasks of a pass may send to the driver unsummed: 64 MB of doubles.
GATHERED_NUMBERS = 1 << 23
#: Entries that a task may pass over alone, to solve some classes without a job for each pass.
TASK_ENTRIES = 1 << 27
#: The same where the blocks' files are not local and the task holds them in memory.
HELD_ENTRIES = 1 << 24
#: Features x classes numbers of a pass from which that is worth while.
TASK_NUMBERS = 1 << 16
#: Entries x classes up to which one task fits a logistic regression.
ALONE_NUMBERS = 1 << 25
#: Numbers that the logistic regression keeps of its last steps.
HISTORY_NUMBERS = 1 << 25
#: Values whose spread ends the logistic regression.
LOSSES = 20
#: Step sizes of the line search.
STEPS = tuple(0.5 ** k for k in range(12))


@dataclass
class Block:
    """Rows of a sparse matrix; ``columns`` are positions in ``used``, some sorted
    columns, or columns of all ``used``.  Rows that all have every column may come without
    ``columns``.  Products go class by class: beside the result they hold a few
    numbers per entry, however many classes there are."""

    counts: np.ndarray   # entries of each row
    columns: np.ndarray  # of each entry
    values: np.ndarray
    used: np.ndarray | int  # or how many columns there are
    order: np.ndarray | None
    labels: np.ndarray
    memo: dict | None = None  # what a task keeps of the block from pass to pass

    def __post_init__(self) -> None:
        n, self.width = len(self.counts), self.used if isinstance(self.used, int) else len(self.used)
        self.used = slice(None) if isinstance(self.used, int) else self.used
        # rows that all have every column are a plain matrix
        self.matrix = None
        if _is_full(self.counts, self.columns, self.width, len(self.values)) and (isinstance(self.used, slice) or self.used[-1] == self.width - 1):
            self.matrix = self.values.reshape(n, self.width)
            return
        self.full = np.flatnonzero(self.counts)
        self.starts = (np.cumsum(self.counts) - self.counts)[self.full]
        self.columns = self.columns.astype(np.intp)  # numpy counts by 32-bit columns 6 times slower

    def times(self, m: np.ndarray) -> np.ndarray:
        """X m, rows x classes."""
        if self.matrix is not None:
            return self.matrix @ m[:self.matrix.shape[1]]
        out = np.zeros((len(self.counts), m.shape[1]))
        for k, own in enumerate(np.ascontiguousarray(m[self.used].T) if len(self.full) else ()):
            out[self.full, k] = np.add.reduceat(own[self.columns] * self.values, self.starts)
        return out

    def back(self, r: np.ndarray) -> np.ndarray:
        """X' r for the used columns."""
        if self.matrix is not None:
            return self.matrix.T @ r
        out = np.zeros((r.shape[1], self.width))
        for k, own in enumerate(np.ascontiguousarray(r.T) if len(self.columns) else ()):
            out[k] = np.bincount(self.columns, np.repeat(own, self.counts) * self.values, self.width)
        return out.T

    def back_squared(self) -> np.ndarray:
        """Sum of squares of the used columns."""
        if self.matrix is not None:
            return (self.matrix ** 2).sum(axis=0)
        return np.bincount(self.columns, self.values ** 2, self.width) if len(self.columns) else np.zeros(self.width)


def _is_full(counts: np.ndarray, columns: np.ndarray, width: int, n_values: int) -> bool:
    n = len(counts)
    if not width or n_values != n * width or (counts != width).any():
        return False
    return not len(columns) or np.array_equal(columns.reshape(n, width), np.broadcast_to(np.arange(width), (n, width)))


#: A block in its file.
_FILED = pa.schema([("counts", pa.binary()), ("columns", pa.binary()), ("values", pa.binary()), ("labels", pa.binary())])
_KINDS = ("<i8", "<i4", "<f8", "<f8")


def _pack_batches(folder: str, width: int):
    """(indices, values, label) rows -> packed blocks in a file of each task, of
    which (file, number, rows, entries) come back.  Without ``indices`` a row has every column."""
    def packed(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
        labels, n = batch.column(2).to_numpy(zero_copy_only=False), batch.num_rows
        counts = batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
        columns = batch.column(0).flatten().to_numpy(zero_copy_only=False)
        if n and batch.column(0).null_count == n:
            columns = np.arange(len(values)) - np.repeat(np.cumsum(counts) - counts, counts)
        at, i = np.append(0, np.cumsum(counts)), 0
        most = min(max(BLOCK_ENTRIES, 2 * width), 4 * BLOCK_ENTRIES)  # a product holds and adds ``width`` numbers a class
        while i < n:
            j = max(i + 1, min(i + BLOCK_ROWS, n, int(np.searchsorted(at, at[i] + most, side="right")) - 1))
            own = columns[at[i]:at[j]]
            if _is_full(counts[i:j], own, width, at[j] - at[i]):
                own = own[:0]
            parts = [x.astype(kind).tobytes() for x, kind in zip((counts[i:j], own, values[at[i]:at[j]], labels[i:j]), _KINDS, strict=True)]
            yield j - i, int(at[j] - at[i]), pa.record_batch([pa.array([x], pa.binary()) for x in parts], schema=_FILED)
            i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (b for batch in batches for b in packed(batch))
        first = next(blocks, None)
        if first is None:
            return
        target, root = pafs.FileSystem.from_uri(folder)
        target.create_dir(root, recursive=True)
        name, lines = f"{uuid.uuid4().hex}.arrow", []
        with target.open_output_stream(f"{root}/{name}") as sink, pa.ipc.new_file(sink, _FILED) as out:
            for rows, entries, block in itertools.chain([first], blocks):
                out.write_batch(block)
                lines.append((name, len(lines), rows, entries))
        yield pa.record_batch([pa.array(x) for x in zip(*lines, strict=True)], names=["file", "number", "rows", "entries"])
    return run


def _read_blocks(folder: str, refs: list[tuple[str, int]], width: int) -> Iterator[Block]:
    """Blocks by (file, number), mapped where the folder is local: pages that all
    workers of a machine share; else one block at a time is read."""
    source, root = pafs.FileSystem.from_uri(folder)
    for name, numbers in itertools.groupby(sorted(refs), key=lambda r: r[0]):
        path = f"{root}/{name}"
        with (pa.memory_map(path) if isinstance(source, pafs.LocalFileSystem) else source.open_input_file(path)) as raw, pa.ipc.open_file(raw) as file:
            for _, number in numbers:
                parts = [np.frombuffer(c[0].as_buffer(), kind) for c, kind in zip(file.get_batch(number).columns, _KINDS, strict=True)]
                yield Block(*parts[:3], width, None, parts[3])


def sparse_parts(features: str = "features"):
    """(indices, values) arrays of a vector column, JVM-side."""
    raw = F.unwrap_udt(F.col(features))
    dense = F.sequence(F.lit(0), F.size(raw["values"]) - 1)
    indices = F.when(raw["type"] == 0, raw["indices"]).when(F.size(raw["values"]) > 0, dense).otherwise(F.array().cast("array<int>"))
    return indices.alias("indices"), raw["values"].alias("values")


def _sum_blocks(blocks: Iterator[Block], work, sent: dict, n_sums: int, d: int, width: int) -> tuple[np.ndarray | None, np.ndarray]:
    """``work`` of some blocks added up: (features x width or None, sums)."""
    matrix, sums = None, np.zeros(n_sums)
    for block in blocks:
        own, scalars = work(block, sent)
        sums += scalars
        if width:
            matrix = np.zeros((width, d)).T if matrix is None else matrix
            matrix += own
    return matrix, sums


def _is_local(folder: str) -> bool:
    return isinstance(pafs.FileSystem.from_uri(folder)[0], pafs.LocalFileSystem)


@dataclass
class TaskBlocks:
    """All packed rows as one task sees them: ``totals`` without a job.  Local files
    are mapped in each pass, others are read once."""

    folder: str
    refs: list[tuple[str, int]]
    n_features: int
    n_classes: int
    passes: int = 0

    def __post_init__(self) -> None:
        self.refs = sorted(self.refs)
        self._memos: list[dict] = [{} for _ in self.refs]
        self._held: list[Block] | None = None

    def _blocks(self) -> Iterator[Block]:
        if self._held is None and not _is_local(self.folder):
            self._held = list(_read_blocks(self.folder, self.refs, self.n_features))
        for block, memo in zip(self._held or _read_blocks(self.folder, self.refs, self.n_features), self._memos, strict=True):
            block.memo = memo
            yield block

    def totals(self, work: Callable[[Block, dict], tuple[np.ndarray, np.ndarray]], n_sums: int, width: int, **sent) -> tuple[np.ndarray, np.ndarray]:
        self.passes += 1
        matrix, sums = _sum_blocks(self._blocks(), work, sent, n_sums, self.n_features, width)
        return np.zeros((self.n_features, width)) if matrix is None else matrix, sums


@dataclass
class RowBlocks:
    """Packed training rows in ``folder``: (file, number, rows, entries) of every
    block; ``n_features`` columns, ``n_classes`` labels."""

    spark: SparkSession
    n_features: int
    n_classes: int
    folder: str = ""
    lines: list[tuple[str, int, int, int]] = field(default_factory=list)
    passes: int = field(default=0, compare=False)

    def __post_init__(self) -> None:
        if (self.n_features + 1) * self.n_classes > MODEL_NUMBERS:
            raise ValueError(f"{self.n_features} features x {self.n_classes} classes exceed {MODEL_NUMBERS} numbers")
        self._dealt = None

    @property
    def n_entries(self) -> int:
        return sum(x[3] for x in self.lines)

    @property
    def refs(self) -> list[tuple[str, int]]:
        return [x[:2] for x in self.lines]

    def release(self) -> None:
        self._dealt = None

    def _tasks(self):
        """Blocks dealt to the cores by their entries."""
        if self._dealt is None:
            sc = self.spark.sparkContext
            heaps = [(0, k, []) for k in range(max(1, min(sc.defaultParallelism, len(self.lines))))]
            for name, number, rows, entries in sorted(self.lines, key=lambda x: (-x[3] - x[2], x[:2])):
                load, k, refs = heapq.heappop(heaps)
                refs.append((name, number))
                heapq.heappush(heaps, (load + entries + rows, k, refs))
            self._dealt = sc.parallelize([h[2] for h in heaps], len(heaps))
        return self._dealt

    def totals(self, work: Callable[[Block, dict], tuple[np.ndarray, np.ndarray]], n_sums: int, width: int, **sent) -> tuple[np.ndarray, np.ndarray]:
        """Sum over all blocks of ``work``: (features x ``width`` numbers,
        ``n_sums`` numbers) -> (features x width, sums).  ``sent`` is broadcast.
        Small results of the tasks go to the driver, others are added up by feature range."""
        self.passes += 1
        tasks, sc, d, folder = self._tasks(), self.spark.sparkContext, self.n_features, self.folder
        shared = sc.broadcast(sent)

        def each(parts: Iterator[list]) -> Iterator[tuple]:
            for refs in parts:
                matrix, sums = _sum_blocks(_read_blocks(folder, refs, d), work, shared.value, n_sums, d, width)
                yield -1, (None, sums)
                for k in range(0, d, RANGE) if matrix is not None else ():
                    at = np.flatnonzero(matrix[k:k + RANGE].any(axis=1)).astype(np.int32)
                    if len(at):
                        yield k // RANGE, (at, matrix[k + at])

        def add(parts: Iterator[tuple]) -> Iterator[tuple]:
            found: dict[int, np.ndarray] = {}
            for part, (at, numbers) in parts:
                if part < 0:
                    found[part] = found.get(part, 0) + numbers
                    continue
                if part not in found:
                    found[part] = np.zeros((min(RANGE, d - part * RANGE), width))
                found[part][at] += numbers
            yield from found.items()

        n = tasks.getNumPartitions()
        rows = tasks.mapPartitions(each)
        if n * d * width > GATHERED_NUMBERS:
            rows = rows.partitionBy(min(d // RANGE + 2, max(1, sc.defaultParallelism))).mapPartitions(add).collect()  # features x width numbers in all
        else:
            rows = list(add(rows.collect()))
        shared.destroy()
        matrix, sums = np.zeros((d, width)), np.zeros(n_sums)
        for part, numbers in rows:
            if part < 0:
                sums += numbers
            else:
                matrix[part * RANGE:(part + 1) * RANGE] = numbers
        return matrix, sums


def row_blocks(train: DataFrame, n_classes: int, n_features: int | None = None) -> RowBlocks:
    """Training rows (``features`` vector, ``label`` 0 ... n_classes - 1) packed and
    written once."""
    if n_features is None:
        first = train.first()
        n_features = first["features"].size if first is not None else 0
    return packed_rows(train.select(*sparse_parts(), F.col("label").cast("double").alias("label")), n_classes, n_features)


def packed_rows(parts: DataFrame, n_classes: int, n_features: int) -> RowBlocks:
    """(indices, values, label) rows packed; NULL indices stand for every column."""
    from vitrine.sources.store import new_folder
    folder = new_folder(parts.sparkSession, "row-blocks")
    lines = parts.mapInArrow(_pack_batches(folder, n_features), "file string, number long, rows long, entries long").collect()  # a line for each BLOCK_ENTRIES
    return RowBlocks(parts.sparkSession, n_features, n_classes, folder, [tuple(r) for r in lines])


@dataclass
class LinearModel:
    """Scores are ``x' weights + intercepts``; what the fit did."""

    weights: np.ndarray     # features x classes
    intercepts: np.ndarray
    iterations: int = 0
    passes: int = 0
    residual: float = 0.0   # largest relative residual or gradient of a class


def class_groups(blocks: RowBlocks) -> list[np.ndarray]:
    """Classes that are solved together, at most ``GROUP_NUMBERS`` numbers a matrix."""
    width = max(1, GROUP_NUMBERS // (blocks.n_features + 1))
    return [np.arange(k, min(k + width, blocks.n_classes)) for k in range(0, blocks.n_classes, width)]


def _signs(labels: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return np.where(labels[:, None] == classes, 1.0, -1.0)


def _alone(blocks: RowBlocks | TaskBlocks) -> bool:
    """Whether a task for each class, which passes over all rows block by block, is
    faster than all tasks on one class group after another: by seconds a pass, of the
    entries' work, of what a job costs and of the features x classes numbers it moves."""
    d, k = blocks.n_features, blocks.n_classes
    if not isinstance(blocks, RowBlocks) or k < 2 or d * k < TASK_NUMBERS or blocks.n_entries > (TASK_ENTRIES if _is_local(blocks.folder) else HELD_ENTRIES):
        return False
    cores = max(1, blocks.spark.sparkContext.defaultParallelism)
    work = blocks.n_entries * 7e-9
    return work * -(-k // cores) < work * k / cores + 0.2 * len(class_groups(blocks)) + cores * d * k * 8e-9


def _together(blocks: RowBlocks | TaskBlocks, solve: Callable[[RowBlocks | TaskBlocks, np.ndarray, LinearModel | None], LinearModel], start: LinearModel | None = None) -> LinearModel:
    """The model of all classes from those of the groups."""
    out = LinearModel(np.zeros((blocks.n_features, blocks.n_classes)), np.zeros(blocks.n_classes))
    alone = _alone(blocks)
    groups = [np.array([k]) for k in range(blocks.n_classes)] if alone else class_groups(blocks)
    starts = [None if start is None else LinearModel(start.weights[:, g], start.intercepts[g]) for g in groups]
    found = _by_task(blocks, solve, groups, starts) if alone else (solve(blocks, g, x) for g, x in zip(groups, starts, strict=True))
    for group, part in zip(groups, found, strict=True):
        out.weights[:, group], out.intercepts[group] = part.weights, part.intercepts
        out.iterations, out.residual = max(out.iterations, part.iterations), max(out.residual, part.residual)
        out.passes += part.passes
    return out


def _by_task(blocks: RowBlocks, solve, groups: list[np.ndarray], starts: list) -> list[LinearModel]:
    """Models of class groups, each solved whole in a task of its own."""
    alone = TaskBlocks(blocks.folder, blocks.refs, blocks.n_features, blocks.n_classes)

    def run(parts: Iterator[tuple]) -> Iterator[LinearModel]:
        for group, start in parts:
            yield solve(replace(alone), group, start)

    found = blocks.spark.sparkContext.parallelize(list(zip(groups, starts, strict=True)), len(groups)).mapPartitions(run).collect()  # features x classes numbers
    blocks.passes += sum(m.passes for m in found)
    return found


def conjugate_gradients(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, diagonal: np.ndarray, tol: float, max_iter: int,
                        start: np.ndarray | None = None) -> tuple[np.ndarray, int, np.ndarray]:
    """Solve ``product(x) = right`` column by column, all columns in each
    product, preconditioned by the diagonal.  Returns (x, products, relative
    residuals); a column that has converged stands still."""
    x = np.zeros_like(right) if start is None else start.copy()
    size = np.maximum(np.linalg.norm(right, axis=0), 1e-300)
    n = 0
    if start is None:
        r = right.copy()
    else:
        r, n = right - product(x), 1
    z = r / diagonal
    p, rz = z.copy(), (r * z).sum(axis=0)
    while n < max_iter and (np.linalg.norm(r, axis=0) > tol * size).any():
        going = (np.linalg.norm(r, axis=0) > tol * size).astype(float)
        q = product(p)
        n += 1
        curve = (p * q).sum(axis=0)
        step = going * rz / np.where(curve > 0, curve, 1.0)
        x += step * p
        r -= step * q
        z = r / diagonal
        new = (r * z).sum(axis=0)
        p = z + p * np.where(rz > 0, new / np.where(rz > 0, rz, 1.0), 0.0)
        rz = new
    return x, n, np.linalg.norm(r, axis=0) / size


def fit_ridge(blocks: RowBlocks, alpha: float = 1.0, tol: float = 1e-8, max_iter: int = 500) -> LinearModel:
    """MDL08: least squares on +/-1 targets with an L2 penalty on the weights, the
    intercept free.  ``residual`` is that of the centred normal equations."""
    return _together(blocks, lambda rows, classes, _: _fit_ridge(rows, classes, alpha, tol, max_iter))


def _fit_ridge(blocks: RowBlocks | TaskBlocks, classes: np.ndarray, alpha: float, tol: float, max_iter: int) -> LinearModel:
    k = len(classes)
    before = blocks.passes

    def moments(b: Block, _: dict):
        y = _signs(b.labels, classes)
        ones = np.ones((len(b.counts), 1))
        return np.hstack([b.back(ones), b.back_squared()[:, None], b.back(y)]), np.append(len(y), y.sum(axis=0))

    m, s = blocks.totals(moments, 1 + k, 2 + k)
    n = max(s[0], 1.0)
    mean_x, mean_y = m[:, 0] / n, s[1:] / n
    right = m[:, 2:] - np.outer(m[:, 0], mean_y)

    def product(p: np.ndarray) -> np.ndarray:
        through, _ = blocks.totals(lambda b, sent: (b.back(b.times(sent["p"])), np.zeros(0)), 0, k, p=p)
        return through - n * np.outer(mean_x, mean_x @ p) + alpha * p

    diagonal = np.maximum(m[:, 1] - n * mean_x ** 2, 0.0)[:, None] + alpha
    w, steps, residual = conjugate_gradients(product, right, diagonal, tol, max_iter)
    return LinearModel(w, mean_y - mean_x @ w, steps, blocks.passes - before, float(residual.max(initial=0.0)))


def _margins(b: Block, w: np.ndarray) -> np.ndarray:
    """Scores with the last row of ``w`` as the intercept."""
    return b.times(w[:-1]) + w[-1]


def _kept(b: Block, step: int, make: Callable[[], np.ndarray]) -> np.ndarray:
    """``make()``, once a step where the block remembers it."""
    if b.memo is None:
        return make()
    if b.memo.get("step") != step:
        b.memo.update(step=step, value=make())
    return b.memo["value"]


def fit_svm(blocks: RowBlocks, c: float = 1.0, start: LinearModel | None = None, tol: float = 1e-3, max_newton: int = 50, max_inner: int = 30,
            class_weights: np.ndarray | None = None) -> LinearModel:
    """MDL04: one-vs-rest linear SVM, ``w'w / 2 + C * sum of weighted squared
    hinge losses``, the intercept a penalised weight of a constant feature.

    Ends when every class' gradient is below ``tol`` of its size at zero;
    ``residual`` is the largest ratio left.  ``class_weights`` weigh the rows by
    their own class (MDL09)."""
    row_weight = np.ones(blocks.n_classes) if class_weights is None else np.asarray(class_weights, float)
    return _together(blocks, lambda rows, classes, begin: _fit_svm(rows, classes, c, begin, tol, max_newton, max_inner, row_weight), start)


def _fit_svm(blocks: RowBlocks | TaskBlocks, classes: np.ndarray, c: float, start: LinearModel | None, tol: float, max_newton: int, max_inner: int,
             row_weight: np.ndarray) -> LinearModel:
    k, d = len(classes), blocks.n_features
    before = blocks.passes
    w = np.zeros((d + 1, k)) if start is None else np.vstack([start.weights, start.intercepts])

    def gradient(b: Block, sent: dict):
        y = _signs(b.labels, classes)
        loss = np.maximum(1.0 - y * _margins(b, sent["w"]), 0.0)
        weigh = row_weight[b.labels.astype(int)][:, None]
        pull = -2.0 * c * weigh * y * loss
        return b.back(pull), np.concatenate([pull.sum(axis=0), c * (weigh * loss ** 2).sum(axis=0)])

    def at_zero(b: Block, _: dict):
        pull = -2.0 * c * row_weight[b.labels.astype(int)][:, None] * _signs(b.labels, classes)
        return np.hstack([b.back(pull), b.back_squared()[:, None]]), np.append(pull.sum(axis=0), len(b.counts))

    m, s = blocks.totals(at_zero, k + 1, k + 1)
    size = np.maximum(np.linalg.norm(np.vstack([m[:, :k], s[:k]]), axis=0), 1e-300)
    # a preconditioner need not be exact: all rows instead of those inside the margin
    diagonal = 1.0 + 2.0 * c * np.append(m[:, k], s[k])[:, None]

    def objective(found: tuple[np.ndarray, np.ndarray], w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return w + np.vstack([found[0], found[1][:k]]), (w ** 2).sum(axis=0) / 2 + found[1][k:]

    g, value = objective(blocks.totals(gradient, 2 * k, k, w=w), w)
    newton = 0
    while newton < max_newton and (np.linalg.norm(g, axis=0) > tol * size).any():
        newton += 1

        def product(p: np.ndarray, w: np.ndarray = w) -> np.ndarray:
            def inside(b: Block, sent: dict):
                active = _kept(b, newton, lambda: (_signs(b.labels, classes) * _margins(b, sent["w"]) < 1.0) * row_weight[b.labels.astype(int)][:, None])
                f = active * _margins(b, sent["p"])
                return b.back(f), f.sum(axis=0)
            own, bias = blocks.totals(inside, k, k, w=w, p=p)
            return p + 2.0 * c * np.vstack([own, bias])

        going = np.linalg.norm(g, axis=0) > tol * size
        direction, _, _ = conjugate_gradients(product, np.where(going, -g, 0.0), diagonal, 0.1, max_inner)

        def trial(b: Block, sent: dict):
            y, weigh = _signs(b.labels, classes), row_weight[b.labels.astype(int)][:, None]
            f, move = _margins(b, sent["w"]), _margins(b, sent["p"])
            return None, np.concatenate([c * (weigh * np.maximum(1.0 - y * (f + t * move), 0.0) ** 2).sum(axis=0) for t in STEPS])

        _, losses = blocks.totals(trial, k * len(STEPS), 0, w=w, p=direction)
        values = losses.reshape(len(STEPS), k) + np.stack([((w + t * direction) ** 2).sum(axis=0) / 2 for t in STEPS])
        best = values.argmin(axis=0)
        step = np.where(values[best, np.arange(k)] < value, np.array(STEPS)[best], 0.0)
        if not (step > 0).any():
            break  # rounding: no class can be improved
        w = w + step * direction
        g, value = objective(blocks.totals(gradient, 2 * k, k, w=w), w)
    return LinearModel(w[:-1], w[-1], newton, blocks.passes - before, float((np.linalg.norm(g, axis=0) / size).max(initial=0.0)))


def fit_logistic(blocks: RowBlocks | TaskBlocks, reg: float, tol: float = 1e-4, max_iter: int = 100, class_weights: np.ndarray | None = None) -> LinearModel:
    """MDL03: multinomial logistic regression, mean of the weighted losses plus
    ``reg / 2`` times the squared weights, the intercepts free, by L-BFGS
    with the curvature's diagonal at the start as its scale.

    Ends like Spark ML's: after ``max_iter`` steps, at a gradient below ``tol`` of the
    value, or once the last ``LOSSES`` values differ by less than ``tol`` of the first one."""
    d, k = blocks.n_features, blocks.n_classes
    if isinstance(blocks, RowBlocks) and 0 < blocks.n_entries * k <= ALONE_NUMBERS:  # a job takes longer than its work
        return _by_task(blocks, lambda rows, *_: fit_logistic(rows, reg, tol, max_iter, class_weights), [np.arange(k)], [None])[0]
    before = blocks.passes
    row_weight = np.ones(k) if class_weights is None else np.asarray(class_weights, float)

    def counted(b: Block, _: dict):
        return b.back_squared()[:, None], np.bincount(b.labels.astype(int), minlength=k).astype(float)

    def slope(b: Block, sent: dict):
        own, rows = b.labels.astype(int), np.arange(len(b.labels))
        weigh = row_weight[own]
        s = _margins(b, sent["w"])
        s -= s.max(axis=1, keepdims=True)
        at = s[rows, own]
        np.exp(s, out=s)
        whole = s.sum(axis=1)
        s *= (weigh / whole)[:, None]
        s[rows, own] -= weigh
        return b.back(s), np.append(s.sum(axis=0), weigh @ (np.log(whole) - at))

    squares, counts = blocks.totals(counted, k, 1)
    n = max(counts @ row_weight, 1e-300)
    shares = np.maximum(counts * row_weight / n, 1e-12)
    scale = np.vstack([squares / max(counts.sum(), 1.0), np.ones((1, 1))]) * np.maximum(shares * (1 - shares), 1e-12)
    scale[:-1] += reg

    def value_at(w: np.ndarray) -> tuple[float, np.ndarray]:
        g, s = blocks.totals(slope, k + 1, k, w=w)
        g = np.vstack([g, s[:k]]) / n
        g[:-1] += reg * w[:-1]
        return s[k] / n + reg / 2 * float((w[:-1] ** 2).sum()), g

    dot = lambda x, y: float(np.vdot(x, y))
    w = np.vstack([np.zeros((d, k)), np.log(shares)])
    value, g = value_at(w)
    values, pairs, steps = [value], [], 0
    most = max(3, min(10, HISTORY_NUMBERS // w.size))
    while steps < max_iter and np.linalg.norm(g) > max(tol * abs(value), 1e-8):
        p, past = g.copy(), []
        for s, y, sy in reversed(pairs):
            a = dot(s, p) / sy
            past.append(a)
            p -= a * y
        p /= scale
        if pairs:
            s, y, sy = pairs[-1]
            p *= sy / dot(y, y / scale)
        for (s, y, sy), a in zip(pairs, reversed(past), strict=True):
            p += (a - dot(y, p) / sy) * s
        down, t = dot(g, p), 1.0
        for _ in range(20):  # a step that lowers the value enough
            trial, slope_there = value_at(w - t * p)
            if trial <= value - 1e-4 * t * down:
                break
            t *= min(max(t * down / (2 * (trial - value + t * down)), 0.1), 0.5) if np.isfinite(trial) else 0.1
        else:
            if not pairs:
                break  # rounding: the value can't be lowered
            pairs = []
            continue
        steps += 1
        s, y = -t * p, slope_there - g
        w, value, g = w + s, trial, slope_there
        if dot(s, y) > 1e-12 * dot(y, y / scale):
            pairs = [*pairs[1 - most:], (s, y, dot(s, y))]
        values.append(value)
        if max(values[-LOSSES - 1:-1]) - value <= tol * abs(values[0]):
            break
    return LinearModel(w[:-1], w[-1], steps, blocks.passes - before, float(np.linalg.norm(g) / max(abs(value), 1e-300)))


def svm_path(blocks: RowBlocks, cs: list[float], **kw) -> list[LinearModel]:
    """EXP08: models of ascending ``cs``, each fit starting at the last one."""
    out: list[LinearModel] = []
    for c in sorted(cs):
        out.append(fit_svm(blocks, c, start=out[-1] if out else None, **kw))
    return out


def predict(model: LinearModel, df: DataFrame, features: str = "features") -> DataFrame:
    """Adds ``prediction``: the class with the largest score (ties: the first)."""
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.intercepts))

    @F.arrow_udf("double")
    def best(indices: pa.Array, values: pa.Array) -> pa.Array:
        weights, intercepts = shared.value
        counts = indices.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        columns, numbers = (x.flatten().to_numpy(zero_copy_only=False) for x in (indices, values))
        at, out, i = np.append(0, np.cumsum(counts)), np.zeros(len(counts)), 0
        while i < len(counts):  # a batch of long rows has entries x classes numbers too many for a worker
            j = max(i + 1, int(np.searchsorted(at, at[i] + SCORE_ENTRIES, side="right")) - 1)
            used, own = np.unique(columns[at[i]:at[j]], return_inverse=True)
            block = Block(counts[i:j], own, numbers[at[i]:at[j]], used, np.argsort(own, kind="stable"), np.zeros(j - i))
            out[i:j] = (block.times(weights) + intercepts).argmax(axis=1)
            i = j
        return pa.array(out)

    return df.withColumn("prediction", best(*sparse_parts(features)))
