"""ROUGE-L F1 over white-space tokens, as a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from corpusmill.functions import lcs

_rouge = F.pandas_udf(lcs.scores, DoubleType())


def rouge_l(prediction: Column, reference: Column) -> Column:
    """Null where there is no reference to score against."""
    return _rouge(prediction, F.nullif(reference, F.lit("")))
