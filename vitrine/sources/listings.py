"""Labelled listings from CSV and class lists from JSON (SRC01, SRC10).

A listing file is read with an explicit schema; fields may be quoted and hold
line breaks and quotes.  No row goes silently: a record that does not fit the
schema comes back in a second table with its text, and both together are all
records of the file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.sources.store import new_folder

X_SCHEMA = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("designation", T.StringType()), T.StructField("description", T.StringType()),
                         T.StructField("productid", T.LongType()), T.StructField("imageid", T.LongType())])
Y_SCHEMA = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("prdtypecode", T.LongType())])
_CORRUPT = "__corrupt"
#: What the parser gives for a quoted empty field ('' itself would read as NULL).
_EMPTY = "\ufdd0"
#: A quote inside a field is doubled; blanks belong to the field.
_CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


@dataclass
class Records:
    """``rows`` that fit the schema and ``refused`` ones (``record``: their text)."""

    rows: DataFrame
    refused: DataFrame


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> Records:
    """All records of the CSV files under ``path``.

    * A record with too few or too many fields, or a field that is no number
      where one is due, or without ``row_id``, is refused.
    * An empty unquoted field is NULL, a quoted one ''; an empty file gives two empty tables.
    * Parsed once into a table in the shared folder, so both parts come from one pass.
    """
    full = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = spark.read.schema(full).options(**_CSV, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, emptyValue=_EMPTY).csv(path)
    folder = new_folder(spark, "listings")
    strings = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    parsed = parsed.withColumns({c: F.when(F.col(c) == _EMPTY, F.lit("")).otherwise(F.col(c)) for c in strings})
    parsed.write.parquet(folder)
    parsed = spark.read.schema(full).parquet(folder)
    key = schema.fields[0].name
    good = F.col(_CORRUPT).isNull() & F.col(key).isNotNull()
    text = F.coalesce(_CORRUPT, F.concat_ws(",", *(F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in schema.fields)))
    return Records(parsed.where(good).drop(_CORRUPT), parsed.where(~good).select(text.alias("record")))


def write_csv(df: DataFrame, path: str) -> None:
    """``df`` as CSV that :func:`read_csv` reads back; '' and NULL stay apart."""
    options = {k: v for k, v in _CSV.items() if k != "multiLine"}
    df.write.options(**options, quoteAll=False, emptyValue='""', nullValue="").csv(path)


def load_labelled(spark: SparkSession, x_path: str, y_path: str) -> tuple[DataFrame, Records, Records]:
    """SRC01: (row_id, designation, description, prdtypecode, text_raw) of rows in
    both files, and the records of each; text_raw is the trimmed title and the
    trimmed description with a space between, trimmed."""
    x, y = read_csv(spark, x_path, X_SCHEMA), read_csv(spark, y_path, Y_SCHEMA)
    part = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    joined = x.rows.join(y.rows, "row_id")
    text = F.trim(F.concat(part("designation"), F.lit(" "), part("description")))
    return joined.select("row_id", "designation", "description", "prdtypecode", text.alias("text_raw")), x, y


def read_classes(spark: SparkSession, path: str) -> DataFrame:
    """SRC10: (class_idx, prdtypecode) of a JSON object's ``classes`` array; order
    is the index.  A file without that array raises."""
    raw = spark.read.schema("classes array<long>").option("multiLine", True).json(path)
    checked = raw.select(F.coalesce("classes", F.raise_error(F.lit("no classes array")).cast("array<long>")).alias("classes"))
    return checked.select(F.posexplode("classes").alias("class_idx", "prdtypecode"))
