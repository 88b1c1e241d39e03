"""Python functions for SQL and DataFrames: scalar, Arrow-batched, grouped and table functions. Built-ins are faster; these are for what they cannot say."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.udf(T.StringType())
def brand_code(brand):
    """A row at a time: for rare use outside hot paths."""
    return None if brand is None else brand.split("#")[-1].zfill(4)


@F.pandas_udf(T.DoubleType())
def discounted(price: pd.Series, discount: pd.Series) -> pd.Series:
    """A batch at a time, by Arrow."""
    return price * (1 - discount)


@F.pandas_udf(T.DoubleType())
def least(values: pd.Series) -> float:
    """A grouped aggregate: the least value. A worker gets all values of a group, so a large group is salted and aggregated twice."""
    return float(values.min())


@F.pandas_udf(T.DoubleType())
def most(values: pd.Series) -> float:
    """A grouped aggregate: the greatest value."""
    return float(values.max())


@F.udtf(returnType=T.StructType([T.StructField("part", T.IntegerType()), T.StructField("word", T.StringType())]))
class WordsOf:
    """A table function: the words of a text with their numbers."""

    def eval(self, text: str):
        for i, word in enumerate((text or "").split()):
            yield i, word
