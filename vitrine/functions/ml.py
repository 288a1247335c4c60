"""Spark ML stages for the reference's transformer surface (UDF01, UDF02, UDF05).

* ``TextCleaner``   — stateless Transformer: the configurable cleaner on a column.
* ``TextFeatures``  — stateless Transformer: the 12 length/composition features.
* ``TfidfBlock``    — Estimator fitting the scikit-style vocabulary and idf on
  the long table; its Model keeps the vocabulary (at most ``maxTerms``, else the
  fit raises) and builds the weighted block as a SparseVector inside each row,
  so a fitted pipeline also transforms a stream.

All are ``DefaultParamsWritable`` so a fitted ``PipelineModel`` saves and loads,
and each exposes ``get_feature_names_out``.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions import features as tf
from vitrine.functions import text as tx


class TextCleaner(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    flags = Param(Params._dummy(), "flags", "JSON object of cleaning flags", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, flags="{}"):
        super().__init__()
        self._setDefault(flags="{}")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        flags = json.loads(self.getOrDefault(self.flags))
        return df.withColumn(self.getOutputCol(), tx.clean_text(F.col(self.getInputCol()), **flags))

    def get_feature_names_out(self):
        return [self.getOutputCol()]


class TextFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    textCols = Param(Params._dummy(), "textCols", "text columns", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, textCols=None):
        super().__init__()
        self._setDefault(textCols=["designation", "description"])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return tf.add_text_features(df, tuple(self.getOrDefault(self.textCols)))

    def get_feature_names_out(self):
        return tf.feature_names(tuple(self.getOrDefault(self.textCols)))


class _TfidfParams(HasInputCol, HasOutputCol):
    idCol = Param(Params._dummy(), "idCol", "row id column", typeConverter=TypeConverters.toString)
    config = Param(Params._dummy(), "config", "JSON vectoriser config", typeConverter=TypeConverters.toString)
    weight = Param(Params._dummy(), "weight", "block weight", typeConverter=TypeConverters.toFloat)


class TfidfBlock(Estimator, _TfidfParams, DefaultParamsReadable, DefaultParamsWritable):
    maxTerms = Param(Params._dummy(), "maxTerms", "most terms the model may hold", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, idCol="row_id", config="{}", weight=1.0, maxTerms=1 << 20):
        super().__init__()
        self._setDefault(idCol="row_id", config="{}", weight=1.0, maxTerms=1 << 20)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "TfidfBlockModel":
        from vitrine.operators import rowvec
        from vitrine.operators import vectorize as V
        cfg = V.VectorizerConfig(**json.loads(self.getOrDefault(self.config)))
        block = rowvec.fit_block(df, self.getOutputCol(), F.col(self.getInputCol()), cfg, id_col=self.getOrDefault(self.idCol),
                                 max_terms=self.getOrDefault(self.maxTerms))
        return TfidfBlockModel(inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
                               idCol=self.getOrDefault(self.idCol), config=self.getOrDefault(self.config),
                               weight=self.getOrDefault(self.weight),
                               vocabulary=json.dumps(list(zip(block.terms, block.idf, strict=True))))


class TfidfBlockModel(Model, _TfidfParams, DefaultParamsReadable, DefaultParamsWritable):
    vocabulary = Param(Params._dummy(), "vocabulary", "JSON [[term, idf], ...] in index order",
                       typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, idCol="row_id", config="{}", weight=1.0, vocabulary="[]"):
        super().__init__()
        self._set(**self._input_kwargs)

    def get_feature_names_out(self):
        return [t for t, _ in json.loads(self.getOrDefault(self.vocabulary))]

    def _transform(self, df: DataFrame) -> DataFrame:
        from vitrine.operators import rowvec
        from vitrine.operators import vectorize as V
        cfg = V.VectorizerConfig(**json.loads(self.getOrDefault(self.config)))
        vocab = json.loads(self.getOrDefault(self.vocabulary))
        block = rowvec.FittedBlock(self.getOutputCol(), F.col(self.getInputCol()), cfg, [t for t, _ in vocab], [float(i) for _, i in vocab],
                                   self.getOrDefault(self.weight))
        return rowvec.row_vectors(df, [block], out_col=self.getOutputCol())
