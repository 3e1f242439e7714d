"""The few user functions that built-in expressions cannot state, all Arrow-batched."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_records(lines: DataFrame, value: str) -> DataFrame:
    """Odd ``key=value;...`` lines to typed rows, one Arrow batch at a time; unknown fields are NULL."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fields = pdf[value].str.extractall(r"(?P<k>\w+)=(?P<v>[^;]*)").reset_index()
            wide = fields.pivot_table(index="level_0", columns="k", values="v", aggfunc="first")
            wide = wide.reindex(index=range(len(pdf)), columns=["id", "kind", "amount"])
            yield pd.DataFrame(
                {
                    "id": pd.to_numeric(wide["id"], errors="coerce").astype("Int64"), "kind": wide["kind"],
                    "amount": pd.to_numeric(wide["amount"], errors="coerce"),
                }
            )

    reset = lines.select(value)
    return reset.mapInPandas(run, "id BIGINT, kind STRING, amount DOUBLE")


def harmonic_total(values: Column) -> Column:
    """Fold of 1 / x over an array."""
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + 1 / x)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Custom aggregate from two sums, so it combines map-side."""
    return F.sum(value * weight) / F.nullif(F.sum(weight), F.lit(0.0))
