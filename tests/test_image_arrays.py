"""Array image kernels against their pixel-table forms and plain numpy; fitted
projections against closed forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import image_arrays as ia
from vitrine.operators import images as im

SIZE = 8


@pytest.fixture(scope="module")
def pictures():
    rng = np.random.default_rng(11)
    x = rng.integers(0, 256, (12, SIZE, SIZE, 3))
    x[0] = 255                      # nothing but background
    x[1] = 250; x[1, 2:6, 3:5] = 40   # a tall thing on white
    x[2] = 250; x[2, 4:6, 1:7] = 90   # a wide thing on white
    x[3] = 3; x[3, 1:5, 2:6] = 130    # a square on black
    x[4, ..., 1] = x[4, ..., 0]
    x[5] = 0
    return x


@pytest.fixture(scope="module")
def tables(spark, pictures):
    rgb = [(k, y, x, *map(int, pictures[k, y, x])) for k in range(len(pictures)) for y in range(SIZE) for x in range(SIZE)]
    px = spark.createDataFrame(rgb, "image_id long, y long, x long, r int, g int, b int").cache()
    gray = px.select("image_id", "y", "x", im.gray_from_rgb(F.col("r"), F.col("g"), F.col("b")).alias("v")).cache()
    arrays = spark.createDataFrame([(k, pictures[k].reshape(-1).tolist()) for k in range(len(pictures))], "image_id long, pixels array<int>").cache()
    return px, gray, arrays


def by_id(df, column):
    return [r[column] for r in df.orderBy("image_id").collect()]


def test_colours_and_histograms_equal_the_table_forms(tables, pictures):
    px, gray, arrays = tables
    h, s, v = im.hsv(F.col("r"), F.col("g"), F.col("b"))
    want = np.array([r[0] for r in px.select(im.color_class(h, s, v), "image_id", "y", "x").orderBy("image_id", "y", "x").collect()]).reshape(-1, SIZE, SIZE)
    got = ia.color_classes(pictures)
    assert np.array_equal(got, want) and np.array_equal(ia.gray(pictures).reshape(-1), [r.v for r in gray.orderBy("image_id", "y", "x").collect()])
    hot = ia.one_hot(got)
    assert np.array_equal(hot.sum(-1), (got >= 0).astype(int)) and np.array_equal(np.where(got >= 0, hot.argmax(-1), -1), got)
    props = im.color_proportions(px, list(ia.UNION_COLORS)).orderBy("image_id").collect()
    assert np.allclose(ia.proportions(got, ia.UNION_COLORS), [list(r)[1:] for r in props])
    counts = np.zeros((len(pictures), 3, 16))
    for r in im.channel_histogram(px, 16).collect():
        counts[r.image_id, "rgb".index(r.channel), r.bin] = r["count"]
    assert np.array_equal(ia.histograms(pictures, 16), counts.reshape(len(pictures), -1))


def test_boxes_equal_the_table_form(tables, pictures):
    _, gray, _ = tables
    for threshold, below in ((240, True), (15, False), (100, True), (100, False)):
        for padding in (0, 1, 10):
            want = im.crop_box(gray, SIZE, threshold, sup=below, padding=padding).orderBy("image_id").collect()
            start, end, found = ia.crop_boxes(pictures, threshold, below, padding)
            assert [(r.r_min, r.r_max, r.c_min, r.c_max, r.cropped) for r in want] == [(*map(int, (s[0], e[0], s[1], e[1])), bool(f)) for s, e, f in zip(start, end, found)]


def plain_resize(img, out):
    h, w = img.shape[:2]
    res = np.zeros((out, out, *img.shape[2:]))
    for y in range(out):
        for x in range(out):
            sy, sx = (min(max((k + 0.5) * (n / out) - 0.5, 0), n - 1) for k, n in ((y, h), (x, w)))
            y0, x0 = int(sy), int(sx)
            y1, x1, fy, fx = min(y0 + 1, h - 1), min(x0 + 1, w - 1), sy - int(sy), sx - int(sx)
            res[y, x] = (img[y0, x0] * (1 - fy) + img[y1, x0] * fy) * (1 - fx) + (img[y0, x1] * (1 - fy) + img[y1, x1] * fy) * fx
    return np.rint(res)


def test_crop_and_resize_equal_a_plain_loop(spark, tables, pictures):
    _, _, arrays = tables
    want = []
    for img in pictures:
        for threshold, below in ((240, True), (15, False)):
            start, end, _ = ia.crop_boxes(img[None], threshold, below, 10)
            (r0, c0), (r1, c1) = start[0], end[0]
            if (r0, c0, r1, c1) != (0, 0, SIZE, SIZE):
                img = plain_resize(img[r0:r1, c0:c1], SIZE)
        want.append(img)
    got = by_id(ia.map_images(arrays, SIZE, 3, {"p": ia.cropped}, "int"), "p")
    assert np.array_equal(np.array(got).reshape(-1, SIZE, SIZE, 3), np.array(want))
    big = ia.resize(pictures, 13)
    assert np.array_equal(big, np.array([plain_resize(p, 13) for p in pictures]))


def test_hog_equals_the_table_form(tables, pictures):
    _, gray, _ = tables
    got = ia.hog(ia.gray(pictures)).reshape(-1, 3, 3, 2, 2, 9)
    want = np.zeros_like(got)
    for r in im.hog(gray, SIZE).collect():
        want[r.image_id, r.by, r.bx, r.cy, r.cx, r.bin] = r.value
    assert np.allclose(got, want, atol=1e-9)


def test_corners_equal_a_plain_loop(pictures):
    def plain(img):
        at = lambda y, x: img[abs(y) if y < SIZE else 2 * SIZE - 2 - y, abs(x) if x < SIZE else 2 * SIZE - 2 - x]
        g = np.zeros((SIZE, SIZE, 2))
        for y in range(SIZE):
            for x in range(SIZE):
                for d, w in ((-1, 1), (0, 2), (1, 1)):
                    g[y, x] += w * np.array([at(y + d, x + 1) - at(y + d, x - 1), at(y + 1, x + d) - at(y - 1, x + d)])
        r = np.zeros((SIZE, SIZE))
        for y in range(SIZE):
            for x in range(SIZE):
                w = [g[abs(y - i), abs(x - j)] for i in (0, 1) for j in (0, 1)]
                xx, yy, xy = sum(a * a for a, _ in w), sum(b * b for _, b in w), sum(a * b for a, b in w)
                r[y, x] = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
        d = np.array([[r[max(y - 1, 0):y + 2, max(x - 1, 0):x + 2].max() for x in range(SIZE)] for y in range(SIZE)])
        return int((d > 0.01 * d.max()).sum())
    g = ia.gray(pictures)
    assert ia.corners(g).ravel().tolist() == [plain(img.astype(float)) for img in g]


def test_largest_steps(spark):
    signal = np.array([[0, 5, 1, 9, 2, 3], [4, 4, 4, 4, 4, 7]])
    assert ia.min_max_diff(signal, [(0, 3), (3, 6)]).ravel().tolist() == [1, 0]
    table = im.min_max_diff(spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(signal)], "image_id long, pixels array<int>"), [(0, 3), (3, 6)])
    assert by_id(table, "min_max_diff") == [1, 0]


def test_wrong_sizes_raise(spark):
    df = spark.createDataFrame([(1, [1, 2, 3])], "image_id long, pixels array<int>")
    with pytest.raises(Exception, match="has not 8 x 8 x 1"):
        ia.map_images(df, 8, 1, {"p": lambda x: x}, "int").collect()


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 4, 160)
    x = rng.normal(size=(160, 12)) @ rng.normal(size=(12, 12)) + 3 * np.eye(4)[y] @ rng.normal(size=(4, 12))
    x[:, 7] = 2.5  # constant
    df = spark.createDataFrame([(i, x[i].tolist(), f"l{y[i]}") for i in range(160)], "image_id long, v array<double>, label string").repartition(5).cache()
    return x, y, df


def test_pca_equals_numpy_up_to_sign(points):
    x, _, df = points
    weights, offset, variances = ia.fit_pca(df, "v", 5)
    std = x.std(0)
    std[7] = 1
    z = (x - x.mean(0)) / std
    values, vectors = np.linalg.eigh(z.T @ z / (len(z) - 1))
    assert np.allclose(variances, values[::-1][:5], rtol=1e-6)
    got = np.array(by_id(ia.project(df, "v", (weights, offset), "c"), "c"))
    want = z @ vectors[:, ::-1][:, :5]
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-3 * np.abs(want).max())


def test_discriminants_equal_the_closed_form(points):
    x, y, df = points
    weights, offset = ia.fit_discriminants(df, "v", "label", 26)
    assert weights.shape == (12, 3)
    std = x.std(0)
    std[7] = 1
    z = (x - x.mean(0)) / std
    means = np.array([z[y == c].mean(0) for c in range(4)])
    sw = sum((z[y == c] - means[c]).T @ (z[y == c] - means[c]) for c in range(4))
    n = np.bincount(y)
    sb = (means.T * n) @ means
    floor = 1e-4 * np.diag(sw).mean()
    values, vectors = np.linalg.eig(np.linalg.solve(sw + floor * np.eye(12), sb))
    want = z @ vectors[:, np.argsort(-values.real)[:3]].real
    got = np.array(by_id(ia.project(df, "v", (weights, offset), "c"), "c"))
    for k in range(3):
        assert abs(np.corrcoef(got[:, k], want[:, k])[0, 1]) > 1 - 1e-6
    within = np.mean([((got[y == c] - got[y == c].mean(0)) ** 2).sum(0) for c in range(4)], axis=0) * 4 / (160 - 4)
    assert np.allclose(within, 1, atol=1e-3)


def test_words_of_images_without_descriptors_are_zero(spark):
    desc = spark.createDataFrame([(1, [0.0, 0.0]), (1, [9.0, 9.0]), (1, [9.0, 9.1]), (2, [0.1, 0.0])], "image_id long, descriptor array<double>")
    images = spark.createDataFrame([(1,), (2,), (3,)], "image_id long")
    got = {r.image_id: sorted(r.words) for r in ia.word_histograms(desc, images, k=2).collect()}
    assert got[1] == pytest.approx([1 / 3, 2 / 3]) and got[2] == [0, 1] and got[3] == [0, 0]


def test_union_is_standardised(spark, tables, pictures):
    _, _, arrays = tables
    labelled = arrays.withColumn("label", F.concat(F.lit("l"), (F.col("image_id") % 3).cast("string")))
    desc = spark.createDataFrame([(k % 9, [float(k), float(k * k % 7)]) for k in range(40)], "image_id long, descriptor array<double>")
    rows = ia.feature_union(labelled, desc, SIZE, n_pca=5, n_words=6, n_axes=26).orderBy("image_id").collect()
    x = np.array([r.features for r in rows])
    assert x.shape == (12, 1 + 5 + 6 + 48 + 1 + 9 + 2) and np.isfinite(x).all()
    spread = x.std(0)
    assert np.allclose(x.mean(0), 0, atol=1e-6) and ((np.abs(spread - 1) < 1e-6) | (spread < 1e-6)).all()


def test_pca_of_images_needs_no_table_of_their_numbers(spark, monkeypatch):
    """The axes of the kernel's products are those of the written numbers; kernels see few images at a time."""
    rng = np.random.default_rng(8)
    x = rng.integers(0, 256, (300, 8, 8))
    images = spark.createDataFrame([(i, p.reshape(-1).tolist()) for i, p in enumerate(x)], "image_id long, pixels array<int>").repartition(5)
    kernel = lambda p: np.stack([p.mean(axis=(1, 2)), p[:, 0].sum(axis=1) * 2.0, p.max(axis=(1, 2)) * 1.0, np.full(len(p), 7.0)], axis=1)
    monkeypatch.setattr(ia, "GRAM_ROWS", 3)
    rows = kernel(x)
    scaled = (rows - rows.mean(0)) / np.where(rows.std(0) > 0, rows.std(0), 1.0)
    weights, offset, variances = ia.fit_image_pca(images, 8, 1, kernel, 2)
    want = np.sort(np.linalg.eigvalsh(scaled.T @ scaled))[::-1][:2] / 299
    np.testing.assert_allclose(variances, want, rtol=1e-9)
    old = ia.fit_pca(ia.map_images(images, 8, 1, {"n": kernel}), "n", 2)
    np.testing.assert_allclose(rows @ weights + offset, rows @ old[0] + old[1], atol=1e-8)
    monkeypatch.setattr(ia, "BATCH_PIXELS", 640)

    def small(p):
        assert len(p) <= 10
        return kernel(p)
    assert ia.image_products(images, 8, 1, small)[0] == 300 and ia.map_images(images, 8, 1, {"n": small}).count() == 300
    assert ia.image_products(images.limit(0), 8, 1, kernel)[0] == 0
    monkeypatch.setattr(ia, "GRAM_FEATURES", 3)
    with pytest.raises(Exception, match="exceed"):
        ia.image_products(images, 8, 1, kernel)
