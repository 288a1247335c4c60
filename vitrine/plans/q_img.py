"""Image queries over the pixel views (IMG01-09, IMG12-15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import fixed
from vitrine.operators import image_arrays as ia
from vitrine.operators import images as im
from vitrine.plans import sqlkit as S
from vitrine.plans.registry import query
from vitrine.sources import views

R = 6
SIZE = 8

GRAY_SQL = ("gray_px AS (SELECT vec_id AS image_id, CAST((i - 1) // 8 AS BIGINT) AS y, CAST((i - 1) % 8 AS BIGINT) AS x, "
            "CAST(least(greatest(floor((CAST(embedding[i] AS DOUBLE) + 1) * 127.5), 0), 255) AS INTEGER) AS v "
            "FROM embeddings, range(1, 65) r(i))")
RGB_SQL = ("rgb_px AS (SELECT image_id, y, x, coalesce(max(CASE WHEN ch = 0 THEN v END), 0) AS r, "
           "coalesce(max(CASE WHEN ch = 1 THEN v END), 0) AS g, coalesce(max(CASE WHEN ch = 2 THEN v END), 0) AS b FROM "
           "(SELECT image_id // 3 AS image_id, image_id % 3 AS ch, y, x, v FROM gray_px) GROUP BY image_id, y, x)")
HSV_SQL = ("hsv_px AS (SELECT *, CASE WHEN h0 < 0 THEN h0 + 180 ELSE h0 END AS h FROM (SELECT *, "
           "floor((s_raw * sdiv + 2048) / 4096.0) AS s, floor((hraw * hdiv + 2048) / 4096.0) AS h0 FROM (SELECT *, "
           "vmax - vmin AS s_raw, CASE WHEN vmax = 0 THEN 0.0 ELSE round(1044480.0 / vmax) END AS sdiv, "
           "CASE WHEN vmax - vmin = 0 THEN 0.0 ELSE round(122880.0 / (vmax - vmin)) END AS hdiv, "
           "CASE WHEN vmax = r THEN g - b WHEN vmax = g THEN b - r + 2 * (vmax - vmin) ELSE r - g + 4 * (vmax - vmin) END AS hraw "
           "FROM (SELECT *, greatest(r, g, b) AS vmax, least(r, g, b) AS vmin FROM rgb_px))))")


def _within_sql(x, rng):
    lo, hi = float(rng[0]), float(rng[1])
    return f"({x} >= {lo} OR {x} < {hi})" if lo > hi else f"({x} >= {lo} AND {x} < {hi})"


def _color_sql() -> str:
    parts = []
    for i, (_, hue, saturation, value) in reversed(list(enumerate(fixed.COLOR_RANGES))):
        parts.append(f"WHEN {_within_sql('h', hue)} AND {_within_sql('s', saturation)} AND {_within_sql('vmax', value)} THEN {i}")
    return "CASE " + " ".join(parts) + " ELSE -1 END"


@query("image_gray_and_color", ops=("IMG01", "IMG06"),
       sql=S.with_(GRAY_SQL, RGB_SQL, HSV_SQL) + "SELECT image_id, y, x, CAST(floor((r * 4899 + g * 9617 + b * 1868 + 8192) / 16384.0) AS INTEGER) AS gray, "
       f"CAST(h AS INTEGER) AS h, CAST(s AS INTEGER) AS s, CAST(vmax AS INTEGER) AS v, {_color_sql()} AS color_class FROM hsv_px")
def image_gray_and_color(spark, sf_dir):
    px = views.rgb_pixels(spark, sf_dir)
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    h, s, v = im.hsv(r, g, b)
    return px.select("image_id", "y", "x", im.gray_from_rgb(r, g, b).alias("gray"), h.alias("h"), s.alias("s"),
                     v.alias("v"), im.color_class(h, s, v).alias("color_class"))


@query("image_mean_rgb", ops=("IMG04", "IMG14"),
       sql=S.with_(GRAY_SQL, RGB_SQL, HSV_SQL) + "SELECT image_id, "
       + ", ".join(f"round(coalesce(avg(CASE WHEN vmax > 70 AND (s > 40 OR vmax < 200) THEN {c} END), 127.0), {R}) AS mean_{c}" for c in "rgb")
       + ", " + ", ".join(f"round(avg({c}), {R}) AS all_mean_{c}, round(stddev_samp({c}), {R}) AS std_{c}" for c in "rgb")
       + " FROM hsv_px GROUP BY image_id")
def image_mean_rgb(spark, sf_dir):
    px = views.rgb_pixels(spark, sf_dir)
    m = im.mean_rgb(px)
    st = im.channel_stats(px)
    st = st.select("image_id", *[F.col(f"mean_{c}").alias(f"all_mean_{c}") for c in "rgb"],
                   *[F.col(f"std_{c}") for c in "rgb"])
    out = m.join(st, "image_id")
    cols = [F.round(f"mean_{c}", R).alias(f"mean_{c}") for c in "rgb"]
    cols += [x for c in "rgb" for x in (F.round(f"all_mean_{c}", R).alias(f"all_mean_{c}"), F.round(f"std_{c}", R).alias(f"std_{c}"))]
    return out.select("image_id", *cols)


@query("image_color_one_hot", ops=("IMG06",),
       sql=S.with_(GRAY_SQL, RGB_SQL, HSV_SQL, f"c AS (SELECT image_id, y, x, {_color_sql()} AS cc FROM hsv_px)")
       + "SELECT image_id, y, x, " + ", ".join(f"CAST(cc = {k} AS INTEGER) AS is_{name}" for k, name in enumerate(im.COLOR_LABELS)) + " FROM c")
def image_color_one_hot(spark, sf_dir):
    px = views.rgb_pixels(spark, sf_dir)
    c = px.select("image_id", "y", "x", im.color_class(*im.hsv(F.col("r"), F.col("g"), F.col("b"))).alias("cc"))
    return c.select("image_id", "y", "x", *((F.col("cc") == k).cast("int").alias(f"is_{name}") for k, name in enumerate(im.COLOR_LABELS)))


@query("image_histograms", ops=("IMG05",),
       sql=S.with_(GRAY_SQL, RGB_SQL) + "SELECT image_id, channel, CAST(floor(value * 16 / 256.0) AS INTEGER) AS bin, count(*) AS count FROM ("
       + " UNION ALL ".join(f"SELECT image_id, '{c}' AS channel, {c} AS value FROM rgb_px" for c in "rgb")
       + ") GROUP BY ALL")
def image_histograms(spark, sf_dir):
    return im.channel_histogram(views.rgb_pixels(spark, sf_dir), bins=16)


PROP_CATS = list(ia.UNION_COLORS)


@query("image_color_proportions", ops=("IMG06", "IMG07"),
       sql=S.with_(GRAY_SQL, RGB_SQL, HSV_SQL, f"c AS (SELECT image_id, {_color_sql()} AS cc FROM hsv_px)",
                   "n AS (SELECT image_id, " + ", ".join(f"sum(CASE WHEN cc = {k} THEN 1 ELSE 0 END) AS c{k}" for k in PROP_CATS)
                   + " FROM c GROUP BY image_id)")
       + "SELECT image_id, " + ", ".join(
           f"round(CASE WHEN ({' + '.join(f'c{k}' for k in PROP_CATS)}) > 0 THEN c{c} / ({' + '.join(f'c{k}' for k in PROP_CATS)}) "
           f"ELSE 0.0 END, {R}) AS prop_{im.COLOR_LABELS[c]}" for c in PROP_CATS) + " FROM n")
def image_color_proportions(spark, sf_dir):
    p = im.color_proportions(views.rgb_pixels(spark, sf_dir), PROP_CATS)
    return p.select("image_id", *[F.round(c, R).alias(c) for c in p.columns if c != "image_id"])


RANGES = [(0, 16), (16, 32), (32, 48), (48, 64)]


@query("image_flatten_minmaxdiff", ops=("IMG03", "IMG08"),
       sql=S.with_(GRAY_SQL, "fl AS (SELECT image_id, list(v ORDER BY y * 8 + x) AS pixels FROM gray_px GROUP BY image_id)")
       + "SELECT image_id, pixels, least(" + ", ".join(
           f"list_max(list_transform(range({lo + 1}, {hi}), lambda i: pixels[i + 1] - pixels[i]))" for lo, hi in RANGES)
       + ") AS min_max_diff FROM fl")
def image_flatten_minmaxdiff(spark, sf_dir):
    flat = im.flatten(views.gray_pixels(spark, sf_dir), SIZE)
    back = im.unflatten(flat)  # round trip (IMG03 inverse) re-flattened below
    flat2 = im.flatten(back, SIZE)
    mm = im.min_max_diff(flat2, RANGES)
    return flat2.join(mm, "image_id")


def _crop_sql(threshold: int, padding: int, sign: str = "<=") -> str:
    a = (f"a AS (SELECT image_id, min(CASE WHEN v {sign} {threshold} THEN y END) AS r0, max(CASE WHEN v {sign} {threshold} THEN y END) AS r1, "
         f"min(CASE WHEN v {sign} {threshold} THEN x END) AS c0, max(CASE WHEN v {sign} {threshold} THEN x END) AS c1, "
         f"count(DISTINCT CASE WHEN v {sign} {threshold} THEN y END) AS n_rows, count(DISTINCT CASE WHEN v {sign} {threshold} THEN x END) AS n_cols "
         "FROM gray_px GROUP BY image_id)")
    b = (f"b AS (SELECT *, least(({SIZE} - greatest(r1 - r0, c1 - c0)) // 2, {padding}) AS pad, "
         f"greatest(r1 - r0, c1 - c0) + 2 * least(({SIZE} - greatest(r1 - r0, c1 - c0)) // 2, {padding}) AS crop FROM a)")
    c = ("c AS (SELECT *, (r1 - r0) < crop - 2 * pad AS cond1, (c1 - c0) < crop - 2 * pad AS cond2 FROM b)")
    d = ("d AS (SELECT *, CASE WHEN cond1 THEN r1 + (crop - (r1 - r0)) // 2 ELSE r1 END AS r1a, "
         "CASE WHEN cond1 THEN r1 + (crop - (r1 - r0)) // 2 - crop ELSE r0 END AS r0a, "
         "CASE WHEN cond1 THEN c0 - pad ELSE c0 END AS c0a, CASE WHEN cond1 THEN c1 + pad ELSE c1 END AS c1a FROM c)")
    e = ("e AS (SELECT *, CASE WHEN cond2 THEN c1a + (crop - (c1 - c0)) // 2 ELSE c1a END AS c1b, "
         "CASE WHEN cond2 THEN c1a + (crop - (c1 - c0)) // 2 - crop ELSE c0a END AS c0b, "
         "CASE WHEN cond2 THEN r0a - pad ELSE r0a END AS r0b, CASE WHEN cond2 THEN r1a + pad ELSE r1a END AS r1b FROM d)")
    ok = "(n_rows >= 2 AND n_cols >= 2)"
    return (S.with_(GRAY_SQL, a, b, c, d, e)
            + f"SELECT image_id, CAST(CASE WHEN {ok} THEN greatest(0, r0b) ELSE 0 END AS INTEGER) AS r_min, "
              f"CAST(CASE WHEN {ok} THEN least({SIZE}, r1b) ELSE {SIZE} END AS INTEGER) AS r_max, "
              f"CAST(CASE WHEN {ok} THEN greatest(0, c0b) ELSE 0 END AS INTEGER) AS c_min, "
              f"CAST(CASE WHEN {ok} THEN least({SIZE}, c1b) ELSE {SIZE} END AS INTEGER) AS c_max, {ok} AS cropped FROM e")


CROP_T, CROP_PAD = 100, 1


@query("image_crop_box", ops=("IMG09",), sql=_crop_sql(CROP_T, CROP_PAD))
def image_crop_box(spark, sf_dir):
    return im.crop_box(views.gray_pixels(spark, sf_dir), SIZE, CROP_T, sup=True, keep_proportion=True, padding=CROP_PAD)


@query("image_crop_box_black", ops=("IMG09",), sql=_crop_sql(CROP_T, CROP_PAD, ">="))
def image_crop_box_black(spark, sf_dir):
    return im.crop_box(views.gray_pixels(spark, sf_dir), SIZE, CROP_T, sup=False, keep_proportion=True, padding=CROP_PAD)


@query("image_crop", ops=("IMG09", "UDF04"))
def image_crop(spark, sf_dir):
    """Colour images without their white, then their black background, resized
    to the old size; tested against a plain numpy crop."""
    return ia.map_images(views.rgb_arrays(spark, sf_dir), SIZE, 3, {"pixels": ia.cropped}, "int")


def _edges_sql() -> str:
    vals = ", ".join(f"({dy}, {dx}, {float(im.SOBEL_V[dy][dx])}, {float(im.SOBEL_H[dy][dx])})" for dy in range(3) for dx in range(3))
    return (S.with_(GRAY_SQL, f"k AS (SELECT * FROM (VALUES {vals}) t(dy, dx, wv, wh))",
                    "cv AS (SELECT image_id, y - dy AS oy, x - dx AS ox, sum(v * wv) AS conv_v, sum(v * wh) AS conv_h "
                    "FROM gray_px, k WHERE y - dy BETWEEN 0 AND 5 AND x - dx BETWEEN 0 AND 5 GROUP BY ALL)")
            + f"SELECT image_id, CAST(oy // 2 AS INTEGER) AS py, CAST(ox // 2 AS INTEGER) AS px, round(max(conv_v), {R}) AS pool_v, "
              f"round(max(conv_h), {R}) AS pool_h, round(max(sqrt(conv_v * conv_v + conv_h * conv_h)), {R}) AS pool_magnitude FROM cv GROUP BY ALL")


@query("image_directional_edges", ops=("IMG13",), sql=_edges_sql())
def image_directional_edges(spark, sf_dir):
    e = im.directional_edges(views.gray_pixels(spark, sf_dir), SIZE)
    return e.select("image_id", "py", "px", *[F.round(c, R).alias(c) for c in ("pool_v", "pool_h", "pool_magnitude")])


_HALF = ", ".join(f"CAST(round_even((p[{2 * y * SIZE + 2 * x + 1}] + p[{2 * y * SIZE + 2 * x + 2}] + p[{(2 * y + 1) * SIZE + 2 * x + 1}] + p[{(2 * y + 1) * SIZE + 2 * x + 2}]) / 4.0, 0) AS INTEGER)"
                  for y in range(SIZE // 2) for x in range(SIZE // 2))


@query("image_resize", ops=("IMG02", "UDF04"),
       sql=S.with_(GRAY_SQL, "fl AS (SELECT image_id, list(v ORDER BY y * 8 + x) AS p FROM gray_px GROUP BY image_id)") + f"SELECT image_id, [{_HALF}] AS pixels FROM fl")
def image_resize(spark, sf_dir):
    """Bilinear 8x8 -> 4x4, a batch of images at a time."""
    return ia.map_images(views.gray_arrays(spark, sf_dir), SIZE, 1, {"pixels": lambda x: ia.resize(x, SIZE // 2)}, "int")


@query("image_bovw", ops=("IMG12",))
def image_bovw(spark, sf_dir):
    """100 visual words; every colour image, with descriptors or without."""
    return ia.word_histograms(views.descriptors(spark, sf_dir), views.rgb_arrays(spark, sf_dir), k=100)


@query("image_pca", ops=("IMG11", "IMG15"))
def image_pca(spark, sf_dir):
    """150 principal axes of the HOG descriptors (1,764 numbers) of the images at 16 x 16."""
    images = views.gray_arrays(spark, sf_dir)
    kernel = lambda x: ia.hog(ia.resize(x, 16))
    weights, offset, _ = ia.fit_image_pca(images, SIZE, 1, kernel, 150)
    return ia.map_images(images, SIZE, 1, {"components": lambda x: kernel(x) @ weights + offset})


@query("image_hog", ops=("IMG11",))
def image_hog(spark, sf_dir):
    """HOG (9 orientations, 2x2-pixel cells, 2x2-cell blocks, L2-Hys); tested
    against a numpy statement of the same rule."""
    return im.hog(views.gray_pixels(spark, sf_dir), SIZE, orientations=9, ppc=2, cpb=2)


@query("image_corners", ops=("IMG10", "UDF04"))
def image_corners(spark, sf_dir):
    counted = ia.map_images(views.gray_arrays(spark, sf_dir), SIZE, 1, {"n": ia.corners}, "int")
    return counted.select("image_id", F.get("n", F.lit(0)).cast("long").alias("n_corners"))


@query("image_lda", ops=("IMG16",))
def image_lda(spark, sf_dir):
    """Up to 26 discriminant axes (one less than there are labels) of the colour
    images at 16 x 16, flattened and standardised."""
    flat = (ia.map_images(views.rgb_arrays(spark, sf_dir), SIZE, 3, {"flat": lambda x: ia.resize(x, 16)})
            .join(views.rgb_arrays(spark, sf_dir).select("image_id", "label"), "image_id"))
    return ia.project(flat, "flat", ia.fit_discriminants(flat, "flat", "label", 26, tol=1e-3), "components").select("image_id", "label", "components")


@query("image_feature_union", ops=("IMG17", "IMG02", "IMG05", "IMG06", "IMG07", "IMG08", "IMG09", "IMG10", "IMG11", "IMG12", "IMG15", "IMG16"))
def image_feature_union(spark, sf_dir):
    """All image features, standardised, one array per image."""
    return ia.feature_union(views.rgb_arrays(spark, sf_dir), views.descriptors(spark, sf_dir), SIZE)
