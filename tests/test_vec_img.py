"""Vectorisation and image properties."""

import math

import numpy as np
from pyspark.sql import functions as F

from vitrine.operators import images as im
from vitrine.operators import vectorize as V
from vitrine.sources import views
from conftest import SF_SMALL


def test_tfidf_rows_have_unit_norm(spark):
    lst = views.listing_doc(spark, SF_SMALL)
    cfg = V.build_vectorizer("tfidf", ngram_range=(1, 2), max_features=200)
    _, long = V.fit_transform(lst, "row_id", F.col("description"), cfg)
    norms = long.groupBy("row_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n")).collect()
    assert norms and all(abs(r.n - 1.0) < 1e-9 for r in norms)


def test_term_counts_match_python(spark):
    df = spark.createDataFrame([(1, "b a b c b"), (2, ""), (3, "z")], "row_id long, t string")
    cfg = V.build_vectorizer("count", analyzer="whitespace", ngram_range=(1, 1), min_df=1, max_df=1.0)
    got = sorted(tuple(r) for r in V.term_counts(V.analyze(df, "row_id", F.col("t"), cfg), "row_id").collect())
    assert got == [(1, "a", 1), (1, "b", 3), (1, "c", 1), (3, "z", 1)]


def test_factory_errors():
    import pytest
    with pytest.raises(ValueError):
        V.build_vectorizer("tfidf", preset="nope")
    with pytest.raises(ValueError):
        V.build_vectorizer("bag")


def test_hsv_matches_reference_formula(spark):
    rng = np.random.default_rng(0)
    px = rng.integers(0, 256, size=(300, 3))
    df = spark.createDataFrame([tuple(int(x) for x in p) for p in px], "r int, g int, b int")
    got = df.select("r", "g", "b", *im.hsv(F.col("r"), F.col("g"), F.col("b"))).collect()
    for row in got:
        r, g, b, h, s, v = row
        vmax, vmin = max(r, g, b), min(r, g, b)
        diff = vmax - vmin
        sdiv = 0 if vmax == 0 else round((255 << 12) / vmax)
        hdiv = 0 if diff == 0 else round((180 << 12) / (6 * diff))
        hr = (g - b) if vmax == r else (b - r + 2 * diff) if vmax == g else (r - g + 4 * diff)
        hh = (hr * hdiv + 2048) >> 12
        hh = hh + 180 if hh < 0 else hh
        assert (h, s, v) == (hh, (diff * sdiv + 2048) >> 12, vmax)


def test_resize_identity_and_constant(spark):
    rows = [(1, y, x, (y * 8 + x) % 256) for y in range(8) for x in range(8)] + [(2, y, x, 77) for y in range(8) for x in range(8)]
    df = spark.createDataFrame(rows, "image_id long, y long, x long, v int")
    same = {(r.image_id, r.y, r.x): r.v for r in im.resize(df, 8, 8).collect()}
    assert all(same[(i, y, x)] == v for i, y, x, v in rows)
    small = im.resize(df, 8, 4).filter("image_id = 2").collect()
    assert len(small) == 16 and all(r.v == 77 for r in small)


def test_unflatten_rejects_non_square(spark):
    import pytest
    df = spark.createDataFrame([(1, [1, 2, 3])], "image_id long, pixels array<int>")
    with pytest.raises(Exception):
        im.unflatten(df).collect()


def _png(path, rgb):
    """Write a tiny RGB PNG with the standard library (zlib + struct)."""
    import struct
    import zlib
    h, w, _ = rgb.shape
    raw = b"".join(b"\x00" + bytes(rgb[y].astype("uint8").ravel()) for y in range(h))

    def chunk(t, d):
        c = struct.pack(">I", len(d)) + t + d
        return c + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + \
        chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    with open(path, "wb") as f:
        f.write(data)


def test_image_source_reads_rgb(spark, tmp_path):
    from vitrine.sources.store import read_images
    rgb = np.zeros((3, 4, 3), dtype=np.uint8)
    rgb[..., 0] = 200
    rgb[1, 2] = [10, 20, 30]
    _png(tmp_path / "image_1_product_2.png", rgb)
    px = {(r.y, r.x): (r.r, r.g, r.b) for r in read_images(spark, str(tmp_path)).collect()}
    assert len(px) == 12 and px[(0, 0)] == (200, 0, 0) and px[(1, 2)] == (10, 20, 30)


def test_hog_matches_numpy(spark):
    rng = np.random.default_rng(3)
    img = rng.integers(0, 256, size=(8, 8)).astype(float)
    df = spark.createDataFrame([(1, y, x, int(img[y, x])) for y in range(8) for x in range(8)],
                               "image_id long, y long, x long, v int")
    got = {(r.by, r.bx, r.cy, r.cx, r.bin): r.value for r in im.hog(df, 8, 9, 2, 2).collect()}
    gy = np.zeros_like(img); gx = np.zeros_like(img)
    gy[1:-1, :] = img[2:, :] - img[:-2, :]
    gx[:, 1:-1] = img[:, 2:] - img[:, :-2]
    mag = np.hypot(gx, gy)
    ori = np.rad2deg(np.arctan2(gy, gx)) % 180
    cells = np.zeros((4, 4, 9))
    for y in range(8):
        for x in range(8):
            b = min(int(ori[y, x] // 20), 8)
            cells[y // 2, x // 2, b] += mag[y, x] / 4
    for by in range(3):
        for bx in range(3):
            blk = cells[by:by + 2, bx:bx + 2, :]
            v = blk / np.sqrt((blk ** 2).sum() + 1e-10)
            v = np.minimum(v, 0.2)
            v = v / np.sqrt((v ** 2).sum() + 1e-10)
            for cy in range(2):
                for cx in range(2):
                    for b in range(9):
                        g = got.get((by, bx, cy, cx, b), 0.0)
                        assert abs(g - v[cy, cx, b]) < 1e-9 or (v[cy, cx, b] == 0 and (by, bx, cy, cx, b) not in got)


def test_unbounded_vocabulary_uses_distributed_index(spark):
    lst = views.listing_doc(spark, SF_SMALL)
    cfg = V.build_vectorizer("count", ngram_range=(1, 1), max_features=None, min_df=2, max_df=1.0)
    fitted = V.fit(lst, "row_id", F.col("description"), cfg)
    rows = fitted.vocab.orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(len(rows)))
    assert [r.term for r in rows] == sorted(r.term for r in rows)
