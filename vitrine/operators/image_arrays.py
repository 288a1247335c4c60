"""Image operators on array columns: one row per image, ``pixels`` row-major
(channels last), and whole-batch numpy kernels in one ``mapInArrow``
(IMG02, IMG05-12, IMG15-17, UDF04).

The pixel-table forms of the same rules are in ``images``; the tests hold each
kernel against its table form.  An image is one row, so a batch is bounded by
Arrow's batch size times the image size, and nothing is shuffled by image.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions import fixed
from vitrine.operators import linear
from vitrine.operators.images import COLOR_LABELS

#: Most products of the discriminants' conjugate gradients.
MAX_STEPS = 200

#: Pixels whose images go through the kernels together.
BATCH_PIXELS = 1 << 16
#: Features up to which all their products are summed in one pass.
GRAM_FEATURES = 1 << 11
#: Rows of that matrix which a task sends, or adds up, together.
GRAM_ROWS = 1 << 7

Kernel = Callable[[np.ndarray], np.ndarray]


# ---------------------------------------------------------------------------
# kernels: (images, size, size[, 3]) -> (images, ...)
# ---------------------------------------------------------------------------

def gray(x: np.ndarray) -> np.ndarray:
    """IMG01."""
    x = x.astype(np.int64)
    return (x[..., 0] * 4899 + x[..., 1] * 9617 + x[..., 2] * 1868 + 8192) >> 14


def _grid(n: int, out: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left and right neighbour and the right one's share (half-pixel centres)."""
    at = np.clip((np.arange(out) + 0.5) * (n / out) - 0.5, 0, n - 1)
    left = np.floor(at).astype(int)
    return left, np.minimum(left + 1, n - 1), at - left


def resize(x: np.ndarray, out: int) -> np.ndarray:
    """IMG02: bilinear, each result rounded to the nearest even integer."""
    extra = (1,) * (x.ndim - 3)
    a, b, f = _grid(x.shape[1], out)
    f = f.reshape(-1, 1, *extra)
    rows = x[:, a] * (1 - f) + x[:, b] * f
    a, b, f = _grid(x.shape[2], out)
    f = f.reshape(-1, *extra)
    return np.clip(np.rint(rows[:, :, a] * (1 - f) + rows[:, :, b] * f), 0, 255).astype(np.int64)


def crop_boxes(x: np.ndarray, threshold: int, below: bool, padding: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """IMG09: (first, end, found) of rows and columns, images x 2.

    The pixels of interest are at or below (at or above) the threshold.  Their
    last row and column are the exclusive end.  The shorter side grows to the
    longer one plus padding, the longer one gets the padding; equal sides stay.
    An image with fewer than two such rows or columns is left whole.
    """
    size = x.shape[1]
    g = gray(x) if x.ndim == 4 else x
    here = g <= threshold if below else g >= threshold
    lines = np.stack([here.any(axis=2), here.any(axis=1)], axis=1)  # images x 2 x size
    found = (lines.sum(axis=2) >= 2).all(axis=1)
    lo, hi = lines.argmax(axis=2), size - 1 - lines[:, :, ::-1].argmax(axis=2)
    sides = hi - lo
    longest = sides.max(axis=1)
    pad = np.minimum((size - longest) // 2, padding)
    whole = (longest + 2 * pad)[:, None]
    short = sides < longest[:, None]
    grow = pad[:, None] * short.any(axis=1, keepdims=True)
    end = np.where(short, hi + (whole - sides) // 2, hi + grow)
    start = np.where(short, end - whole, lo - grow)
    return np.where(found[:, None], np.maximum(start, 0), 0), np.where(found[:, None], np.minimum(end, size), size), found


def crop(x: np.ndarray, threshold: int, below: bool, padding: int = 10) -> np.ndarray:
    """IMG09: each image cut to its box and resized to the old size."""
    out = x.copy()
    start, end, found = crop_boxes(x, threshold, below, padding)
    for k in np.flatnonzero(found & ((start > 0) | (end < x.shape[1])).any(axis=1)):
        (r0, c0), (r1, c1) = start[k], end[k]
        out[k] = resize(x[k:k + 1, r0:r1, c0:c1], x.shape[1])[0]
    return out


def cropped(x: np.ndarray, white: int = 240, black: int = 15, padding: int = 10) -> np.ndarray:
    """IMG09: the white background goes first, then the black one."""
    return crop(crop(x, white, True, padding), black, False, padding)


def hsv(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The table form's integer rules."""
    x = x.astype(np.float64)
    r, g, b = x[..., 0], x[..., 1], x[..., 2]
    v, low = x.max(axis=-1), x.min(axis=-1)
    diff = v - low
    share = lambda whole, part: np.where(part == 0, 0.0, np.floor(whole / np.where(part == 0, 1, part) + 0.5))
    s = np.floor((diff * share(1044480.0, v) + 2048) / 4096)
    turn = np.where(v == r, g - b, np.where(v == g, b - r + 2 * diff, r - g + 4 * diff))
    h = np.floor((turn * share(122880.0, diff) + 2048) / 4096)
    return np.where(h < 0, h + 180, h), s, v


def color_classes(x: np.ndarray) -> np.ndarray:
    """IMG06: class of each pixel, -1 if none; a later range wins."""
    out = np.full(x.shape[:-1], -1)
    parts = hsv(x)
    for k, (_, *ranges) in enumerate(fixed.COLOR_RANGES):
        inside = np.ones(out.shape, bool)
        for value, (lo, hi) in zip(parts, ranges, strict=True):
            inside &= (value >= lo) | (value < hi) if lo > hi else (value >= lo) & (value < hi)
        out[inside] = k
    return out


def one_hot(classes: np.ndarray) -> np.ndarray:
    """IMG06: a 0/1 plane per class; all 0 for a pixel without one."""
    return (classes[..., None] == np.arange(len(COLOR_LABELS))).astype(np.int64)


def proportions(classes: np.ndarray, categories: tuple[int, ...]) -> np.ndarray:
    """IMG07: share of each category among the pixels that have one (0 if none)."""
    n = np.stack([(classes == c).sum(axis=(1, 2)) for c in categories], axis=1)
    return n / np.maximum(n.sum(axis=1, keepdims=True), 1)


def histograms(x: np.ndarray, bins: int, lo: int = 0, hi: int = 256) -> np.ndarray:
    """IMG05: counts of each channel's bins, channel after channel."""
    n = len(x)
    out = np.zeros((n, x.shape[-1], bins))
    image, _, _, channel = np.indices(x.shape)
    inside = (x >= lo) & (x < hi)
    np.add.at(out, (image[inside], channel[inside], (x[inside] - lo) * bins // (hi - lo)), 1)
    return out.reshape(n, -1)


def min_max_diff(signal: np.ndarray, ranges: list[tuple[int, int]]) -> np.ndarray:
    """IMG08."""
    return np.min([np.diff(signal[:, lo:hi], axis=1).max(axis=1) for lo, hi in ranges], axis=0)[:, None]


def corners(x: np.ndarray, k: float = 0.05, threshold: float = 0.01, dilate: bool = True) -> np.ndarray:
    """IMG10: pixels whose (dilated) Harris response is above a share of the largest."""
    size = x.shape[1]
    p = np.pad(x.astype(float), ((0, 0), (1, 1), (1, 1)), mode="reflect")
    side = lambda q: q[:, :-2] + 2 * q[:, 1:-1] + q[:, 2:]
    gx = side(p)[:, :, 2:] - side(p)[:, :, :-2]
    gy = (side(p.swapaxes(1, 2))[:, :, 2:] - side(p.swapaxes(1, 2))[:, :, :-2]).swapaxes(1, 2)

    def box(a: np.ndarray) -> np.ndarray:
        q = np.pad(a, ((0, 0), (1, 0), (1, 0)), mode="reflect")
        return q[:, :-1, :-1] + q[:, :-1, 1:] + q[:, 1:, :-1] + q[:, 1:, 1:]
    xx, xy, yy = box(gx * gx), box(gx * gy), box(gy * gy)
    response = xx * yy - xy * xy - k * (xx + yy) ** 2
    if dilate:
        q = np.pad(response, ((0, 0), (1, 1), (1, 1)), constant_values=-np.inf)
        response = np.max([q[:, i:i + size, j:j + size] for i in range(3) for j in range(3)], axis=0)
    return (response > threshold * response.max(axis=(1, 2), keepdims=True)).sum(axis=(1, 2))[:, None]


def hog(x: np.ndarray, orientations: int = 9, cell: int = 2, block: int = 2, eps: float = 1e-5) -> np.ndarray:
    """IMG11: values in the order (block row, block column, cell row, cell column, bin)."""
    x = x.astype(float)
    gy, gx = np.zeros_like(x), np.zeros_like(x)
    gy[:, 1:-1] = x[:, 2:] - x[:, :-2]
    gx[:, :, 1:-1] = x[:, :, 2:] - x[:, :, :-2]
    angle = np.degrees(np.arctan2(gy, gx)) % 180.0
    bin_ = np.minimum((angle / (180.0 / orientations)).astype(int), orientations - 1)
    size = np.hypot(gy, gx)
    n = x.shape[1] // cell
    layers = np.where(bin_[..., None] == np.arange(orientations), size[..., None], 0.0)[:, :n * cell, :n * cell]
    cells = layers.reshape(len(x), n, cell, n, cell, orientations).mean(axis=(2, 4))
    m = n - block + 1
    parts = np.stack([cells[:, i:i + m, j:j + m] for i in range(block) for j in range(block)], axis=3)
    flat = parts.reshape(len(x), m, m, -1)
    clipped = np.minimum(flat / np.sqrt((flat ** 2).sum(axis=3, keepdims=True) + eps * eps), 0.2)
    return (clipped / np.sqrt((clipped ** 2).sum(axis=3, keepdims=True) + eps * eps)).reshape(len(x), -1)


# ---------------------------------------------------------------------------
# columns
# ---------------------------------------------------------------------------

def lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A numpy matrix as a list column."""
    x = x.reshape(len(x), -1)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1), kind))


def _step(size: int, channels: int) -> int:
    return max(1, BATCH_PIXELS // (size * size * channels))


def _images(batches: Iterator[pa.RecordBatch], size: int, channels: int, step: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, images) of (image_id, pixels) batches, ``step`` images at a time: a
    kernel's numbers are many times its images'."""
    pixels = size * size * channels
    for whole in batches:
        for at in range(0, whole.num_rows, step):
            batch = whole.slice(at, step)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            if len(flat) != batch.num_rows * pixels:
                raise ValueError(f"an image has not {size} x {size} x {channels} values")
            yield batch.column(0), flat.reshape(batch.num_rows, size, size, *([channels] if channels > 1 else []))


def map_images(df: DataFrame, size: int, channels: int, kernels: dict[str, Kernel], kind: str = "double") -> DataFrame:
    """(image_id, one array per kernel) of (image_id, pixels), all kernels on
    part of an Arrow batch.  Every image must have ``size * size * channels`` values;
    NULL pixels raise."""
    value, step = {"double": pa.float64(), "int": pa.int32()}[kind], _step(size, channels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _images(batches, size, channels, step):
            yield pa.record_batch([ids, *(lists(k(x), value) for k in kernels.values())], names=["image_id", *kernels])

    given = df.select("image_id", F.col("pixels").cast("array<int>"))
    return given.mapInArrow(run, ", ".join([f"image_id {given.schema['image_id'].dataType.simpleString()}", *(f"{name} array<{kind}>" for name in kernels)]))


# ---------------------------------------------------------------------------
# fitted projections: products over packed rows, only features x axes on the driver
# ---------------------------------------------------------------------------

class Scaled:
    """Standardised rows ``(x - mean) / std`` as an operator on packed rows."""

    def __init__(self, df: DataFrame, column: str, label: str | None = None):
        from pyspark.ml.functions import array_to_vector
        labels = [r[0] for r in df.select(label).distinct().orderBy(label).collect()] if label else [None]  # one per class
        index = F.array_position(F.array(*map(F.lit, labels)), F.col(label)) - 1 if label else F.lit(0)
        rows = df.select(array_to_vector(column).alias("features"), index.cast("double").alias("label"))
        k = len(labels)
        self.blocks = linear.row_blocks(rows, k)

        def moments(b: linear.Block, _: dict):
            member = (b.labels[:, None] == np.arange(k)).astype(float)
            return np.hstack([b.back(member), b.back_squared()[:, None]]), member.sum(axis=0)

        sums, self.counts = self.blocks.totals(moments, k, k + 1)
        self.n = max(self.counts.sum(), 1.0)
        self.class_sums = sums[:, :k]
        self.mean = self.class_sums.sum(axis=1) / self.n
        spread = np.sqrt(np.maximum(sums[:, k] / self.n - self.mean ** 2, 0.0))
        # a column that only rounding moves is constant
        self.std = np.where(spread > 1e-9 * np.maximum(np.abs(self.mean), 1.0), spread, 1.0)

    def scatter(self, p: np.ndarray) -> np.ndarray:
        """``X' X p`` of the standardised rows."""
        q = p / self.std[:, None]
        through, _ = self.blocks.totals(lambda b, sent: (b.back(b.times(sent["q"])), np.zeros(0)), 0, p.shape[1], q=q)
        return (through - self.n * np.outer(self.mean, self.mean @ q)) / self.std[:, None]

    def projection(self, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weights, offset) on the raw rows."""
        weights = axes / self.std[:, None]
        return weights, -self.mean @ weights


def _signed(axes: np.ndarray) -> np.ndarray:
    """Each axis with its largest entry positive."""
    return axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)


def fit_pca(df: DataFrame, column: str, k: int, extra: int = 10, powers: int = 6, seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """IMG15: (weights, offset, variances) of the first ``k`` principal axes of
    the standardised column, by a randomised range finder with ``powers`` passes.
    Fewer axes come back if the column has fewer dimensions."""
    x = Scaled(df, column)
    axes, values = _range_finder(x.scatter, x.blocks.n_features, k, extra, powers, seed)
    x.blocks.release()
    return *x.projection(axes), values / max(x.n - 1, 1.0)


def _range_finder(scatter: Kernel, d: int, k: int, extra: int = 10, powers: int = 6, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(axes, values) of the ``k`` largest eigenvalues of ``scatter``."""
    q = np.random.default_rng(seed).normal(size=(d, min(k + extra, d)))
    for _ in range(powers):
        q, _ = np.linalg.qr(scatter(q))
    values, turn = np.linalg.eigh(q.T @ scatter(q))
    top = np.argsort(-values)[:k]
    return _signed(q @ turn[:, top]), values[top]


def image_products(images: DataFrame, size: int, channels: int, kernel: Kernel) -> tuple[int, np.ndarray, np.ndarray]:
    """(images, sum, X'X) of a kernel's numbers, in one pass over the images and
    without a table of the numbers; refused beyond ``GRAM_FEATURES``."""
    step = _step(size, channels)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, gram = 0, None, None
        for _, x in _images(batches, size, channels, step):
            rows = kernel(x).reshape(len(x), -1).astype(float)
            if rows.shape[1] > GRAM_FEATURES:
                raise ValueError(f"{rows.shape[1]} features exceed {GRAM_FEATURES}")
            if gram is None:
                total, gram = np.zeros(rows.shape[1]), np.zeros((rows.shape[1], rows.shape[1]))
            n += len(rows)
            total += rows.sum(axis=0)
            gram += rows.T @ rows
        if gram is not None:
            yield pa.record_batch([pa.array([-1], pa.int64()), pa.array([np.append(total, n).tobytes()], pa.binary())], names=["part", "numbers"])
            for k in range(0, len(gram), GRAM_ROWS):
                yield pa.record_batch([pa.array([k // GRAM_ROWS], pa.int64()), pa.array([gram[k:k + GRAM_ROWS].tobytes()], pa.binary())], names=["part", "numbers"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, numbers in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found[part] = found.get(part, 0) + np.frombuffer(numbers.as_buffer())
        for part, numbers in found.items():
            yield pa.record_batch([pa.array([part], pa.int64()), pa.array([numbers.tobytes()], pa.binary())], names=["part", "numbers"])

    cores = images.sparkSession.sparkContext.defaultParallelism
    given = images.select("image_id", F.col("pixels").cast("array<int>")).coalesce(cores)  # a matrix a core, however many files there are
    parts = given.mapInArrow(products, "part long, numbers binary").repartition(cores, "part").mapInArrow(add, "part long, numbers binary").collect()
    got = {r["part"]: np.frombuffer(r["numbers"]) for r in parts}  # features x features numbers
    if not got:
        return 0, np.zeros(0), np.zeros((0, 0))
    d = len(got[-1]) - 1
    return int(got[-1][-1]), got[-1][:-1], np.concatenate([got[k] for k in range(-(-d // GRAM_ROWS))]).reshape(d, d)


def fit_image_pca(images: DataFrame, size: int, channels: int, kernel: Kernel, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`fit_pca` of a kernel's numbers: the same axes from their products, of
    which nothing is written."""
    n, total, gram = image_products(images, size, channels, kernel)
    n = max(n, 1)
    mean = total / n
    spread = np.sqrt(np.maximum(np.diag(gram) / n - mean ** 2, 0.0))
    std = np.where(spread > 1e-9 * np.maximum(np.abs(mean), 1.0), spread, 1.0)
    scatter = (gram - n * np.outer(mean, mean)) / np.outer(std, std)
    axes, values = _range_finder(lambda q: scatter @ q, len(scatter), k)
    weights = axes / std[:, None]
    return weights, -mean @ weights, values / max(n - 1, 1.0)


def fit_discriminants(df: DataFrame, column: str, label: str, k: int, shrink: float = 1e-4, tol: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """IMG16: (weights, offset) of up to ``k`` linear discriminant axes of the
    standardised column (classes less one at most), scaled to a within-class
    variance of 1.  The within-class scatter, shrunk by ``shrink`` of its mean
    diagonal, is never formed: conjugate gradients solve it for the class means,
    which leaves a classes x classes eigenproblem.  Ends at a relative residual of
    ``tol``, or after ``MAX_STEPS`` products."""
    x = Scaled(df, column, label)
    n_classes = len(x.counts)
    means = (x.class_sums / x.counts - x.mean[:, None]) / x.std[:, None]
    diagonal = np.maximum((x.std != 1.0) * x.n - (means ** 2) @ x.counts, 0.0)
    floor = shrink * max(diagonal.mean(), 1e-12)
    within = lambda p: x.scatter(p) - means @ (x.counts[:, None] * (means.T @ p)) + floor * p
    solved, _, _ = linear.conjugate_gradients(within, means, (diagonal + floor)[:, None], tol, MAX_STEPS)
    values, turn = np.linalg.eig(x.counts[:, None] * (means.T @ solved))
    top = np.argsort(-values.real)[:min(k, n_classes - 1)]
    axes = solved @ turn[:, top].real
    spread = np.sqrt(np.maximum((axes * (within(axes) - floor * axes)).sum(axis=0) / max(x.n - n_classes, 1.0), 1e-300))
    x.blocks.release()
    return x.projection(_signed(axes / spread))


def project(df: DataFrame, column: str, fitted: tuple[np.ndarray, np.ndarray], out: str) -> DataFrame:
    """Adds ``out``: the array column times the weights plus the offset."""
    shared = df.sparkSession.sparkContext.broadcast(fitted[:2])

    @F.arrow_udf("array<double>")
    def axes(col: pa.Array) -> pa.Array:
        weights, offset = shared.value
        flat = col.flatten().to_numpy(zero_copy_only=False)
        return lists(flat.reshape(len(col), weights.shape[0]) @ weights + offset, pa.float64())

    return df.withColumn(out, axes(F.col(column).cast("array<double>")))


def word_histograms(descriptors: DataFrame, images: DataFrame, k: int = 100, seed: int = 42) -> DataFrame:
    """IMG12: (image_id, words): share of each of the ``k`` visual words among an
    image's descriptors; zeros for an image without one."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    d = descriptors.select("image_id", array_to_vector("descriptor").alias("features"))
    assigned = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="word").fit(d).transform(d)
    counts = assigned.groupBy("image_id", "word").agg(F.count(F.lit(1)).alias("n"))
    by_image = counts.groupBy("image_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("m"), F.sum("n").alias("all"))  # k entries at most
    share = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda w: F.coalesce(F.element_at("m", w) / F.col("all"), F.lit(0.0)))
    return images.select("image_id").join(by_image, "image_id", "left").select("image_id", share.alias("words"))


def standardized(df: DataFrame, column: str, out: str = "features") -> DataFrame:
    """Adds ``out``: the array column with mean 0 and standard deviation 1."""
    x = Scaled(df, column)
    x.blocks.release()
    mean, std = (F.array(*map(F.lit, v.tolist())) for v in (x.mean, x.std))
    return df.withColumn(out, F.zip_with(F.zip_with(column, mean, lambda a, b: a - b), std, lambda a, b: a / b))


#: Colour classes of the union: from red on.
UNION_COLORS = tuple(range(3, 12))
_DARK, _LIGHT = 15, 240


def union_parts(size: int, side: int, small: int) -> dict[str, Kernel]:
    """Per-image blocks of the feature union on cropped images: gray ``side`` for
    corners and HOG, colour ``side`` for histograms and proportions, colour
    ``small`` flattened for the discriminants."""
    span = _LIGHT - _DARK
    thirds = [(i * span, (i + 1) * span) for i in range(3)]

    def on(make: Kernel, first: Kernel) -> Kernel:
        return lambda x: make(first(x))

    base = lambda x: resize(cropped(x), side)
    gray_base = lambda x: resize(gray(cropped(x)), side)
    return {"corners": on(corners, gray_base), "hog": on(lambda g: hog(g, cell=side // 8), gray_base),
            "hist": on(lambda x: histograms(x, 16), base), "hist_diff": on(lambda x: min_max_diff(histograms(x, span, _DARK, _LIGHT), thirds), base),
            "colors": on(lambda x: proportions(color_classes(x), UNION_COLORS), base), "flat": lambda x: resize(cropped(x), small)}


def feature_union(images: DataFrame, descriptors: DataFrame, size: int, side: int = 16, small: int = 16, n_pca: int = 150, n_words: int = 100, n_axes: int = 26) -> DataFrame:
    """IMG17: (image_id, features) of (image_id, pixels, label): the standardised
    union of corner count, HOG axes, visual words, colour histograms, their
    largest steps, colour proportions and discriminant axes of cropped images."""
    from vitrine.sources.store import new_folder
    spark = images.sparkSession
    parts = map_images(images, size, 3, union_parts(size, side, small)).join(images.select("image_id", "label"), "image_id")
    path = new_folder(spark, "image-features")
    parts.write.parquet(path)  # read by both fits and the projections
    parts = spark.read.schema(parts.schema).parquet(path)
    parts = project(parts, "hog", fit_pca(parts, "hog", n_pca), "hog_axes")
    parts = project(parts, "flat", fit_discriminants(parts, "flat", "label", n_axes, tol=1e-3), "axes")
    parts = parts.join(word_histograms(descriptors, images, n_words), "image_id")
    return standardized(parts.select("image_id", F.concat("corners", "hog_axes", "words", "hist", "hist_diff", "colors", "axes").alias("raw")), "raw").select("image_id", "features")
