"""Cubes kept by month: mergeable state a cell, rebuilt for the months whose files changed."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwell.sources.ledger import FileLedger


@dataclass(frozen=True)
class Cube:
    """Cells of one month, as counts of each value of a measure, or as sums.

    Counts of values merge by addition over any months or days, and exact percentiles follow from their
    running totals, which sketches or stored medians would not allow.
    """

    name: str
    cell: dict[str, str]  # expressions over the landed rows
    #: the measure whose values are counted, as ``value`` and ``n``; None if the cube has sums only
    value: str | None = None
    sums: dict[str, str] = field(default_factory=dict)
    keep: str | None = None

    def build(self, rows: DataFrame) -> DataFrame:
        """Stored rows from those of a landing folder; ``name`` is the month."""
        rows = rows if self.keep is None else rows.filter(self.keep)
        measures = self.sums if self.value is None else {"value": self.value}
        cells = rows.select("name", *[F.expr(e).alias(n) for n, e in (self.cell | measures).items()])
        if self.value is None:
            return cells.groupBy("name", *self.cell).agg(*[F.sum(n).alias(n) for n in self.sums])
        return cells.filter("value IS NOT NULL").groupBy("name", *self.cell, "value").agg(F.count(F.lit(1)).alias("n"))


class CubeStore:
    """The cubes of one landing folder, on shared files."""

    def __init__(self, spark: SparkSession, landing: str, schema: str, path: str):
        self.spark, self.landing, self.schema, self.path = spark, landing, schema, path

    def _ledger(self, cube: Cube) -> FileLedger:
        # a cube that is defined anew starts anew
        return FileLedger(self.spark, f"{self.path}/{cube.name}-{hashlib.sha1(repr(cube).encode()).hexdigest()[:8]}")

    def refresh(self, cube: Cube) -> list[str]:
        """Rebuild the months whose files came or changed, drop those whose files are gone; returns the rebuilt months."""
        return self._ledger(cube).ingest_folder(self.landing, self.schema, cube.build, drop_missing=True)

    def read(self, cube: Cube, months: Sequence[str] | None = None) -> DataFrame:
        """The stored rows, of some months (first to last) or all; nothing else is read."""
        shape = cube.build(self.spark.createDataFrame([], f"{self.schema}, name STRING")).schema
        rows = self._ledger(cube).read(shape)
        return rows if months is None else rows.filter(F.col("name").between(months[0], months[-1]))
