"""Stateless column functions on a streaming source (§2.15 extension).

The reference has no streaming.  The cleaning and feature functions are plain
column expressions, so they run unchanged on a file stream; this job reads
the documents as a stream, derives listings, cleans them and computes the 12
text features, writing Parquet under the shared checkpoint folder with an
``availableNow`` trigger (exactly-once file sink + checkpoint).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import features as tf
from vitrine.functions import text as tx
from vitrine.sources import views
from vitrine.sources.store import new_folder


#: Files of a micro-batch: enough for the cluster's cores.
FILES_PER_TRIGGER = 64


def listing_features_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/documents.parquet"
    schema = spark.read.parquet(path).schema
    # the table is a file or a folder of files; a stream takes either by pattern
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(f"{path[:-1]}[{path[-1]}]")
    lst = views.listing_doc_from(stream.select("doc_id", "text", "source", "lang"))
    cleaned = lst.select("row_id", "category",
                         tx.native_final_cleaner(F.col("designation")).alias("designation"),
                         F.when(F.col("description").isNull(), F.lit(None))
                          .otherwise(tx.native_final_cleaner(F.col("description"))).alias("description"))
    feats = cleaned.select("row_id", "category", *tf.text_feature_columns())
    root = new_folder(spark, "stream")
    q = (feats.writeStream.format("parquet").option("path", f"{root}/out")
              .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")
