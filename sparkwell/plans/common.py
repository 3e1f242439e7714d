"""Shared names for the query modules."""

from pyspark.sql import DataFrame, Window  # noqa: F401
from pyspark.sql import functions as F  # noqa: F401

from sparkwell.registry import query  # noqa: F401
from sparkwell.tables import Tables  # noqa: F401

col, lit, when = F.col, F.lit, F.when


def rows():
    """COUNT(*)."""
    return F.count(F.lit(1))


def net():
    """Line revenue after discount; the test table's price is already quantity x unit price."""
    return col("l_extendedprice") * (1 - col("l_discount"))


def day(name):
    return F.to_date(col(name))


def big(column):
    return column.cast("bigint")
