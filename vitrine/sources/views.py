"""Derived views over the driver tables (deterministic, same rules as the
SQL in ``vitrine.plans.oracle``).

* ``listing_doc``  documents as product listings (title / nullable description)
* ``listing_page`` pages: <title> as title, html as description
* ``listing_part`` part rows with a numeric-rich description
* ``tags``         labels as boolean drop-tags
* ``predictions``  per-model class probabilities from embedding centroids
* ``gray_pixels`` / ``rgb_pixels`` / ``descriptors``  image tables
* ``epoch_log``    events as a per-run epoch history
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import fixed
from vitrine.sources.tables import table, text_table

N_CLASSES = len(fixed.CANONICAL_CLASSES)


def class_code_at(idx: Column) -> Column:
    """canonical class code at 0-based index ``idx % 27`` (a literal array, no join)."""
    arr = F.array(*[F.lit(c) for c in fixed.CANONICAL_CLASSES])
    return F.element_at(arr, (idx % N_CLASSES).cast("int") + 1)


def listing_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing_doc_from(text_table(spark, sf_dir, "documents", ["doc_id", "text", "source", "lang"]))


def listing_doc_from(d: DataFrame) -> DataFrame:
    """The listing projection over any documents frame (batch or streaming)."""
    nl = F.instr(F.col("text"), "\n")
    rest = F.when(nl > 0, F.expr("substring(text, instr(text, '\\n') + 1)")).otherwise(F.lit(""))
    src_idx = F.coalesce(F.regexp_extract("source", r"(\d+)", 1).try_cast("int"), F.lit(0))
    return d.select(
        F.col("doc_id").alias("row_id"),
        F.when(nl > 0, F.expr("substring(text, 1, instr(text, '\\n') - 1)")).otherwise(F.col("text")).alias("designation"),
        F.when((rest == "") | (F.col("doc_id") % 3 == 0), F.lit(None).cast("string")).otherwise(rest).alias("description"),
        (F.col("doc_id") * 10 + 1).alias("productid"),
        (F.col("doc_id") * 10 + 2).alias("imageid"),
        F.col("source").alias("category"),
        class_code_at(src_idx).alias("prdtypecode"),
        F.col("lang"),
    )


def listing_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = text_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    return p.select(
        F.col("page_id").alias("row_id"),
        F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("designation"),
        F.col("html").alias("description"),
        F.regexp_extract("url", r"^[A-Za-z]+://([^/?#:]+)", 1).alias("category"),
        class_code_at(F.col("page_id") % 5).alias("prdtypecode"),
    )


def part_description() -> Column:
    """Numeric-rich text built from part columns."""
    c = F.col
    return F.concat_ws(
        ", ",
        F.concat(c("p_size").cast("string"), F.lit(" x "), (c("p_size") + 2).cast("string"), F.lit(" x 3 cm")),
        F.concat(((c("p_partkey") % 40) * 50).cast("string"), F.lit(" g")),
        F.concat(F.floor(c("p_retailprice")).cast("bigint").cast("string"), F.lit(" euros")),
        F.concat((c("p_size") % 6).cast("string"), F.lit("-"), (c("p_size") % 6 + 3).cast("string"), F.lit(" ans")),
        (F.lit(1890) + c("p_partkey") % 140).cast("string"),
        F.concat((F.lit(4) * (c("p_partkey") % 32 + 1)).cast("string"), F.lit(" Go")),
        F.concat((c("p_partkey") % 101).cast("string"), F.lit(" %")),
        F.lit("L x H x L"),
        F.lit("24 h / 24"),
    )


#: Tasks per core that the parts are dealt to: their rows differ in cost.
PART_TASKS = 4


def listing_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as listings.  A part is a few bytes in the file but a thousandth of a
    second of pattern work, so the rows are dealt out before it."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice", "p_type")
    p = p.repartition(PART_TASKS * spark.sparkContext.defaultParallelism)
    return p.select(
        F.col("p_partkey").alias("row_id"),
        F.col("p_name").alias("designation"),
        part_description().alias("description"),
        F.col("p_type").alias("category"),
        class_code_at(F.ascii("p_type") + F.length("p_type")).alias("prdtypecode"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    return lab.select(F.col("doc_id").alias("row_id"),
                      (F.col("toxic") == 1).alias("is_toxic"),
                      (F.col("quality") == 0).alias("is_low_quality"))


def category_dim(spark: SparkSession) -> DataFrame:
    """27-row category dimension (code, name, short_name, group, class_idx)."""
    group_of = {code: g for g, codes in fixed.CATEGORY_GROUPS.items() for code in codes}
    rows = [(code, fixed.CATEGORY_NAMES[code], fixed.CATEGORY_SHORT_NAMES[code], group_of.get(code), i)
            for i, code in enumerate(fixed.CANONICAL_CLASSES)]
    return spark.createDataFrame(rows, "code INT, name STRING, short_name STRING, grp STRING, class_idx INT")


# ---------------------------------------------------------------------------
# predictions: class scores from embedding centroids
# ---------------------------------------------------------------------------

MODEL_SLICES = {"model_a": (1, 32), "model_b": (33, 64), "model_c": (1, 64)}
MAX_CENTROID_CELLS = 1_000_000  # classes x dims fetched to the driver, checked


def class_centroids(emb: DataFrame) -> list[tuple[int, list[float]]]:
    """Per-label mean vector; a bounded aggregate (labels x 64), fetched once."""
    n = 64
    aggs = [F.avg(F.element_at("embedding", i + 1)).alias(f"m{i}") for i in range(n)]
    rows = emb.groupBy("label").agg(*aggs).collect()
    if len(rows) * n > MAX_CENTROID_CELLS:
        raise ValueError(f"{len(rows)} classes x {n} dims exceeds the centroid bound")
    rows = sorted(rows, key=lambda r: r["label"])
    return [(r["label"], [float(r[f"m{i}"]) for i in range(n)]) for r in rows]


def _sq_dist(x, centroid_slice):
    """sum of squared differences, summed in dimension order."""
    return F.aggregate(F.zip_with(x, centroid_slice, lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                       lambda acc, v: acc + v)


def predictions(spark: SparkSession, sf_dir: str, models=None) -> DataFrame:
    """(model, split, idx, probs ARRAY<DOUBLE>, y_true, classes ARRAY<INT>).

    score_c = 1 / (1 + euclidean distance to the centroid of class c on the
    model's dimension slice), normalised to sum 1.  split = 'val' for
    vec_id % 5 = 0 else 'train'.  The centroids (classes x 64 numbers,
    size-checked) travel as literals: no join, one pass over the rows.
    """
    emb = table(spark, sf_dir, "embeddings")
    cents = class_centroids(emb)
    labels = [lab for lab, _ in cents]
    base = emb.select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("__e"))
    per_model = []
    for model, (lo, hi) in (models or MODEL_SLICES).items():
        n = hi - lo + 1
        x = F.slice("__e", lo, n)
        scores = F.array(*[F.lit(1.0) / (F.lit(1.0) + F.sqrt(_sq_dist(x, F.array(*[F.lit(v) for v in vec[lo - 1:hi]]))))
                           for _, vec in cents])
        per_model.append(F.struct(F.lit(model).alias("model"), scores.alias("s")))
    # one scan: every model's scores in the same projection, then one row per model
    step = base.select("vec_id", "label", F.explode(F.array(*per_model)).alias("__m"))
    step = step.select("vec_id", "label", F.col("__m.model").alias("model"), F.col("__m.s").alias("__s"))
    step = step.withColumn("__t", F.aggregate("__s", F.lit(0.0), lambda acc, v: acc + v))
    res = step.select(
        "model",
        F.when(F.col("vec_id") % 5 == 0, "val").otherwise("train").alias("split"),
        F.col("vec_id").alias("idx"),
        F.transform("__s", lambda v: v / F.col("__t")).alias("probs"),
        F.col("label").cast("int").alias("y_true"),
    )
    return res.withColumn("classes", F.array(*[F.lit(int(x)) for x in labels]))


# ---------------------------------------------------------------------------
# image tables
# ---------------------------------------------------------------------------

def gray_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, y, x, v): 8x8 gray image per embedding row."""
    emb = table(spark, sf_dir, "embeddings")
    px = emb.select(F.col("vec_id").alias("image_id"), F.posexplode("embedding").alias("pos", "f"))
    return px.select("image_id", (F.col("pos") / 8).cast("int").alias("y"),
                     (F.col("pos") % 8).alias("x"), _byte(F.col("f")).alias("v"))


def rgb_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, y, x, r, g, b): three consecutive embeddings as r, g, b planes;
    a plane that the last image lacks is 0."""
    g = gray_pixels(spark, sf_dir)
    g = g.withColumn("ch", F.col("image_id") % 3).withColumn("image_id", (F.col("image_id") / 3).cast("long"))
    plane = lambda ch: F.coalesce(F.max(F.when(F.col("ch") == ch, F.col("v"))), F.lit(0))
    return g.groupBy("image_id", "y", "x").agg(plane(0).alias("r"), plane(1).alias("g"), plane(2).alias("b"))


def gray_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, pixels): the gray images as row-major arrays, one row each."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("image_id"), F.transform("embedding", _byte).alias("pixels"))


def _byte(f):
    return F.least(F.greatest(F.floor((f.cast("double") + 1) * 127.5), F.lit(0)), F.lit(255)).cast("int")


def rgb_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, pixels, label): the colour images as row-major arrays, channels
    last; a plane that the last image lacks is 0; the label of the first plane."""
    emb = table(spark, sf_dir, "embeddings").select((F.col("vec_id") / 3).cast("long").alias("image_id"), (F.col("vec_id") % 3).alias("ch"),
                                                    F.transform("embedding", _byte).alias("v"), "label")
    plane = lambda ch: F.max(F.when(F.col("ch") == ch, F.col("v")))
    planes = emb.groupBy("image_id").agg(*(plane(k).alias(f"p{k}") for k in range(3)), F.min_by("label", "ch").alias("label"))
    value = lambda k, i: F.coalesce(F.get(f"p{k}", i), F.lit(0))
    pixels = F.transform(F.sequence(F.lit(0), F.lit(191)), lambda i: F.when(i % 3 == 0, value(0, (i / 3).cast("int"))).when(i % 3 == 1, value(1, (i / 3).cast("int")))
                         .otherwise(value(2, (i / 3).cast("int"))))
    return planes.select("image_id", pixels.alias("pixels"), "label")


def descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, desc_id, descriptor ARRAY<DOUBLE>)."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select((F.col("vec_id") / 10).cast("long").alias("image_id"),
                      F.col("vec_id").alias("desc_id"),
                      F.transform("embedding", lambda x: x.cast("double")).alias("descriptor"))


def epoch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, epoch, val_f1, val_loss): events as training histories.

    name = 'run_' || user_id; epoch = row number by (ts, event_id) within the
    user (skew-safe ranking); val_f1 = value scaled to [0, 1]; val_loss = 1 - val_f1.
    """
    from vitrine.operators.ranking import ranged_row_number
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    lo, hi = ev.agg(F.min("value"), F.max("value")).first()  # two scalars
    # micros since the epoch, valid for TIMESTAMP and TIMESTAMP_NTZ alike
    ev = ev.withColumn("ts_us", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"))
    ranked = ranged_row_number(ev, ["user_id"], ["ts_us", "event_id"], out_col="epoch")
    f1 = (F.col("value") - F.lit(lo)) / F.lit(hi - lo)
    return ranked.select(F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("name"),
                         F.col("epoch"), f1.alias("val_f1"), (F.lit(1.0) - f1).alias("val_loss"))
