"""Sources and sinks (SRC05-09, SRC11-12).

Everything is written under a folder of the cluster's shared
``spark.checkpoint.dir`` (never a machine-local path) as Parquet / JSON / CSV
and read back with explicit schemas and partition discovery.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.operators.quality import class_fingerprint, split_signature
from vitrine.operators.vectorize import VectorizerConfig, build_vectorizer
from vitrine.session import shared_dir


def new_folder(spark: SparkSession, kind: str) -> str:
    return shared_dir(spark, f"{kind}/{uuid.uuid4().hex}")


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` computed once into a new folder and read back."""
    path = new_folder(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------------------
# prediction sets (SRC06, SRC07)
# ---------------------------------------------------------------------------

META_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("split_name", T.StringType()),
    T.StructField("split_signature", T.StringType()), T.StructField("classes_fp", T.StringType()),
    T.StructField("num_classes", T.IntegerType()), T.StructField("num_samples", T.LongType()),
    T.StructField("has_y_true", T.BooleanType()),
    T.StructField("probs_shape", T.ArrayType(T.LongType())), T.StructField("probs_dtype", T.StringType()),
])


def export_predictions(preds: DataFrame, root: str) -> None:
    """Write ``(model, split, idx, probs FLOAT[], classes, y_true)`` partitioned by
    (model, split) plus one metadata row per set (an aggregate, not a collect)."""
    out = preds.withColumn("probs", F.transform("probs", lambda p: p.cast("float")))
    out.write.mode("overwrite").partitionBy("model", "split").parquet(f"{root}/predictions")
    sig = split_signature(preds, ["model", "split"])
    meta = preds.groupBy("model", "split").agg(
        F.count(F.lit(1)).alias("num_samples"), F.max(F.size("probs")).alias("num_classes"),
        F.max(class_fingerprint(F.col("classes"))).alias("classes_fp"),
        (F.sum(F.col("y_true").isNull().cast("int")) == 0).alias("has_y_true")).join(sig, ["model", "split"])
    meta = meta.select(F.col("model").alias("model_name"), F.col("split").alias("split_name"), "split_signature",
                       "classes_fp", F.col("num_classes").cast("int"), "num_samples", "has_y_true",
                       F.array(F.col("num_samples"), F.col("num_classes").cast("long")).alias("probs_shape"),
                       F.lit("float32").alias("probs_dtype"))
    meta.coalesce(1).write.mode("overwrite").json(f"{root}/meta")


def load_predictions(spark: SparkSession, root: str, name_like: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Read every prediction set (partition discovery) and its metadata; keep
    the models whose name matches ``name_like`` (SQL LIKE)."""
    preds = spark.read.parquet(f"{root}/predictions")
    meta = spark.read.schema(META_SCHEMA).json(f"{root}/meta")
    if name_like:
        preds = preds.filter(F.col("model").like(name_like))
        meta = meta.filter(F.col("model_name").like(name_like))
    return preds, meta


def set_problems(preds: DataFrame, meta: DataFrame) -> DataFrame:
    """QC02: (model, split, problem), one row for each prediction set that
    disagrees with its metadata or lacks rows, metadata or labels."""
    found = preds.groupBy("model", "split").agg(
        F.count(F.lit(1)).alias("n"), F.min(class_fingerprint(F.col("classes"))).alias("fp_lo"), F.max(class_fingerprint(F.col("classes"))).alias("fp_hi"),
        F.sum(F.col("y_true").isNull().cast("int")).alias("unlabelled")).join(
        split_signature(preds, ["model", "split"]).withColumnRenamed("split_signature", "signature"), ["model", "split"])
    said = meta.withColumnRenamed("model_name", "model").withColumnRenamed("split_name", "split")
    both = found.join(said, ["model", "split"], "full_outer")
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    problem = (F.when(F.col("n").isNull(), "no rows").when(F.col("split_signature").isNull(), "no metadata")
               .when(differs("n", "num_samples"), "row count").when(differs("signature", "split_signature"), "split signature")
               .when(differs("fp_lo", "classes_fp") | differs("fp_hi", "classes_fp"), "class fingerprint")
               .when(F.col("has_y_true") & (F.col("unlabelled") > 0), "labels missing"))
    return both.select("model", "split", problem.alias("problem")).where("problem is not null")


def verified_predictions(preds: DataFrame, meta: DataFrame, skip_broken: bool = False) -> DataFrame:
    """QC02 / SRC07: the prediction rows of sets that agree with their metadata.
    A set that doesn't raises, or is left out with ``skip_broken``."""
    problems = set_problems(preds, meta)
    if skip_broken:
        return preds.join(problems.select("model", "split"), ["model", "split"], "left_anti")
    bad = problems.orderBy("model", "split").collect()  # one row per set
    if bad:
        raise ValueError("; ".join(f"{r['model']}/{r['split']}: {r['problem']}" for r in bad))
    return preds


# ---------------------------------------------------------------------------
# splits (SRC05), result tables (SRC08), cleaned exports (SRC11)
# ---------------------------------------------------------------------------

def export_splits(split_df: DataFrame, root: str, label: str, seed: int, holdout: float) -> None:
    split_df.write.mode("overwrite").partitionBy("split").parquet(f"{root}/splits")
    meta = split_df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.sum((F.col("split") == "train").cast("long")).alias("dev_samples"),
        F.sum((F.col("split") == "test").cast("long")).alias("test_samples"),
        F.countDistinct(label).alias("num_classes")).select(
        "*", F.lit(holdout).alias("holdout_size"), F.lit(seed).alias("random_state"))
    meta.coalesce(1).write.mode("overwrite").json(f"{root}/split_meta")


def save_results(df: DataFrame, path: str, metadata: dict | None = None) -> None:
    """SRC08: results as CSV (header) and an optional JSON metadata file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/results")
    if metadata is not None:
        df.sparkSession.createDataFrame([(json.dumps(metadata, sort_keys=True),)], "metadata STRING") \
            .coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def export_cleaned(df: DataFrame, path: str, columns: list[str]) -> None:
    """SRC11: the cleaned table restricted to a column list."""
    df.select(*columns).write.mode("overwrite").parquet(path)


# ---------------------------------------------------------------------------
# vectoriser configuration (SRC09, SRC12)
# ---------------------------------------------------------------------------

CONFIG_SCHEMA = T.StructType([
    T.StructField("vectorizer_type", T.StringType()), T.StructField("strategy", T.StringType()),
    T.StructField("ngram_range", T.ArrayType(T.IntegerType())), T.StructField("max_features", T.IntegerType()),
    T.StructField("max_features_title", T.IntegerType()), T.StructField("max_features_desc", T.IntegerType()),
    T.StructField("min_df", T.IntegerType()), T.StructField("max_df", T.DoubleType()),
    T.StructField("title_weight", T.DoubleType()), T.StructField("feature_columns", T.ArrayType(T.StringType())),
    T.StructField("metadata", T.StructType([T.StructField("f1_score", T.DoubleType()),
                                            T.StructField("n_train", T.LongType()),
                                            T.StructField("vocab_size", T.LongType())])),
])


def save_config(spark: SparkSession, config: dict, path: str) -> None:
    spark.createDataFrame([config], CONFIG_SCHEMA).coalesce(1).write.mode("overwrite").json(path)


def load_config(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONFIG_SCHEMA).json(path)


def blocks_from_config(config: DataFrame) -> list[tuple[str, VectorizerConfig, float]]:
    """SRC09: the text blocks (name, vectoriser, weight) that a saved
    configuration stands for, ready to be fitted."""
    c = config.first()

    def vectorizer(max_features: int) -> VectorizerConfig:
        return build_vectorizer(c["vectorizer_type"], ngram_range=tuple(c["ngram_range"]), max_features=max_features,
                                min_df=c["min_df"], max_df=c["max_df"])
    if c["strategy"] == "split":
        return [("title", vectorizer(c["max_features_title"]), c["title_weight"] or 1.0), ("description", vectorizer(c["max_features_desc"]), 1.0)]
    return [("text", vectorizer(c["max_features"]), 1.0)]


def config_summary(cfg: DataFrame) -> DataFrame:
    """SRC12: the printed summary as rows (key, value)."""
    kv = F.create_map(
        F.lit("vectorizer"), F.upper("vectorizer_type"), F.lit("strategy"), F.initcap("strategy"),
        F.lit("ngram_range"), F.concat(F.lit("("), F.array_join(F.col("ngram_range").cast("array<string>"), ", "), F.lit(")")),
        F.lit("max_features"), F.when(F.col("strategy") == "split",
                                      F.concat_ws(" / ", F.col("max_features_title").cast("string"),
                                                  F.col("max_features_desc").cast("string"))).otherwise(F.col("max_features").cast("string")),
        F.lit("min_df"), F.col("min_df").cast("string"), F.lit("max_df"), F.col("max_df").cast("string"),
        F.lit("feature_columns"), F.coalesce(F.size("feature_columns").cast("string"), F.lit("0")),
        F.lit("vocab_size"), F.col("metadata.vocab_size").cast("string"))
    return cfg.select(F.explode(kv).alias("key", "value"))


def config_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """VEC13: full outer join of two (key, value) tables; missing -> 'N/A'."""
    x = a.select("key", F.col("value").alias("config_1"))
    y = b.select("key", F.col("value").alias("config_2"))
    return (x.join(y, "key", "full_outer")
             .select("key", F.coalesce("config_1", F.lit("N/A")).alias("config_1"),
                     F.coalesce("config_2", F.lit("N/A")).alias("config_2"),
                     (F.coalesce("config_1", F.lit("N/A")) != F.coalesce("config_2", F.lit("N/A"))).alias("differs")))


# ---------------------------------------------------------------------------
# image files (SRC02)
# ---------------------------------------------------------------------------

def read_images(spark: SparkSession, path: str, grayscale: bool = False) -> DataFrame:
    """SRC02: decode image files with Spark's ``image`` source (JVM decode, BGR
    byte order) into a pixel table ``(origin, y, x, r, g, b)`` or ``(origin, y, x, v)``
    (OpenCV gray rule).  Resizing is ``images.resize`` on the pixel table.
    Files that can't be decoded are listed by :func:`undecodable_images`."""
    from vitrine.operators.images import gray_from_rgb
    img = spark.read.format("image").option("dropInvalid", False).load(path).where("image.height > 0")
    x = img.select(F.col("image.origin").alias("origin"), F.col("image.height").alias("h"),
                   F.col("image.width").alias("w"), F.col("image.nChannels").alias("c"), F.col("image.data").alias("data"))
    # one byte per (pixel, channel): explode positions, read the byte as unsigned
    x = x.select("origin", "w", "c", "data", F.explode(F.sequence(F.lit(0), F.col("h") * F.col("w") - 1)).alias("p"))
    def byte_at(off):
        b = F.conv(F.hex(F.substring("data", F.col("p") * F.col("c") + off + 1, 1)), 16, 10).cast("int")
        return b
    px = x.select("origin", (F.col("p") / F.col("w")).cast("long").alias("y"), (F.col("p") % F.col("w")).alias("x"),
                  F.when(F.col("c") >= 3, byte_at(2)).otherwise(byte_at(0)).alias("r"),
                  F.when(F.col("c") >= 3, byte_at(1)).otherwise(byte_at(0)).alias("g"),
                  byte_at(0).alias("b"))
    if grayscale:
        return px.select("origin", "y", "x", gray_from_rgb(F.col("r"), F.col("g"), F.col("b")).alias("v"))
    return px


def undecodable_images(spark: SparkSession, path: str) -> DataFrame:
    """(origin) of the files under ``path`` that are no images."""
    img = spark.read.format("image").option("dropInvalid", False).load(path)
    return img.where("image.height <= 0").select(F.col("image.origin").alias("origin"))
