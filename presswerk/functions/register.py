"""Functions for SQL: indel_ratio, text_key, html_extract and the table function segments."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswerk.functions.similarity import indel_ratio_udf, text_key_udf
from presswerk.operators import rerank
from presswerk.sources import html


_PAGE = T.StructType([T.StructField(c.split()[0], T.StringType()) for c in html.EXTRACTED.split(", ")])
_SEGMENT = T.StructType([T.StructField("position", T.IntegerType()), T.StructField("segment", T.StringType()), T.StructField("score", T.DoubleType())])


@F.pandas_udf(_PAGE)
def html_extract_udf(page: pd.Series, url: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([html.extract(u or "", p or "") for p, u in zip(page, url, strict=True)], columns=_PAGE.names)


@F.udtf(returnType=_SEGMENT)
class Segments:
    """The segments of a repaired text in order, with their scores beside a title."""

    def eval(self, text: str, title: str):
        words = rerank.title_words(title or "")
        for i, segment in enumerate(rerank.segments(rerank.repair_words(text or ""))):
            yield i, segment, float(rerank.segment_score(segment, words))


def register(spark: SparkSession) -> None:
    """Make the functions known to a session's SQL."""
    for name, function in (("indel_ratio", indel_ratio_udf), ("text_key", text_key_udf), ("html_extract", html_extract_udf)):
        spark.udf.register(name, function)
    spark.udtf.register("segments", Segments)
