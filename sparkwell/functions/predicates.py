"""Predicates that need more than one built-in expression."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.BooleanType())
def mentions_often(text: pd.Series) -> pd.Series:
    """A deliberately costly test: at least five occurrences of "the"."""
    return text.str.count("the").fillna(0) >= 5


def guarded_flag(cheap: Column, text: Column) -> Column:
    """Run the costly test only where ``cheap`` holds: the others pass NULL through."""
    return cheap & mentions_often(F.when(cheap, text))


def search_filter(category: str | None = None, q: str | None = None) -> Column:
    """Exact category and case-insensitive name part; both optional."""
    cond = F.lit(True)
    if category is not None:
        cond = cond & (F.col("p_type") == category)
    if q is not None:
        cond = cond & F.contains(F.lower("p_name"), F.lit(q.lower()))
    return cond
