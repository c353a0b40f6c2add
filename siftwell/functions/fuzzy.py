"""Similarities that need Python: the matching-blocks ratio of two strings, in Arrow batches."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType

from siftwell.functions.company import jaccard, plain_name


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)], dtype="float64")


def name_score(query: Column, candidate: Column) -> Column:
    """1 for equal names, .9 where one contains the other, else a mix of spelling and shared words."""
    return plain_score(plain_name(query), plain_name(candidate))


def plain_score(q: Column, c: Column) -> Column:
    """``name_score`` of names that ``plain_name`` has been applied to."""
    near = F.round(0.6 * ratio(q, c) + 0.4 * jaccard(q, c), 4)
    return F.when((q == "") | (c == ""), 0.0).when(q == c, 1.0).when(q.contains(c) | c.contains(q), 0.9).otherwise(near)
