"""Readers with declared schemas. Bad rows are split off, never dropped silently."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ORDER_STATUSES = ("pending", "completed", "cancelled")  # fixed value set

ZONE_SCHEMA = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"


def read_csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a given schema: no inference pass."""
    return spark.read.schema(schema).option("header", True).csv(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): line numbers from 1 per file, also for files read in several splits.

    The row position inside a split comes from the partition id order; the count
    of the earlier splits of the file is added. There is one row per split.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), "value",
    )
    splits = lines.groupBy("file", "block").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    joined = lines.join(offsets, ["file", "block"])
    return joined.select("file", (F.col("pos") - F.col("first") + F.col("before") + 1).alias("line_no"), "value")


def with_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``reasons``: the names of the rules whose test is false or unknown."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*failed)))


def split_good_bad(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = df.filter(F.size("reasons") == 0).drop("reasons")
    return good, df.filter(F.size("reasons") > 0)


def parse_customer_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """id,name,email rows checked: positive id, non-blank name, "@" in the e-mail."""
    fields = F.from_csv(F.col(value), "id STRING, name STRING, email STRING", {"mode": "PERMISSIVE"})
    typed = lines.withColumn("_f", fields).select(
        *[c for c in lines.columns if c != value], F.expr("try_cast(_f.id AS BIGINT)").alias("id"),
        F.col("_f.name").alias("name"), F.col("_f.email").alias("email"),
    )
    rules = {
        "id": F.col("id") > 0, "name": F.trim("name") != "", "email": F.contains(F.col("email"), F.lit("@")),
    }
    return with_reasons(typed, rules)


ORDER_FIELDS = "id BIGINT, customer_id BIGINT, amount DOUBLE, status STRING"


def _order_rules() -> dict[str, Column]:
    return {
        "id": F.col("id") > 0, "customer_id": F.col("customer_id") > 0, "amount": F.col("amount") >= 0,
        "status": F.col("status").isin(*ORDER_STATUSES),
    }


def parse_order_documents(documents: DataFrame, content: str = "content") -> DataFrame:
    """JSON documents, each an array of orders or one order; checked row by row.

    A document that cannot be read is one row of nulls, which fails every rule; an empty array has no rows.
    """
    fields = f"STRUCT<{ORDER_FIELDS.replace(' ', ': ').replace(',: ', ', ')}>"
    text = F.trim(F.col(content))
    items = F.when(F.startswith(text, F.lit("[")), F.from_json(text, f"ARRAY<{fields}>")).otherwise(
        F.array(F.from_json(text, fields))
    )
    unread = F.array(F.lit(None).cast(fields))
    rows = documents.select(F.explode(F.coalesce(items, unread)).alias("o")).select("o.*")
    return with_reasons(rows, _order_rules())


def read_order_files(spark: SparkSession, path: str) -> DataFrame:
    """JSON files, each an array of orders or one order; (id, customer_id, amount, status, unreadable, reasons).

    An array is parsed order by order as the file is read. A file that cannot be read to its end gives one row of nulls with
    ``unreadable`` set and none of its orders, so that it is loaded whole or not at all.
    """
    text = spark.read.schema(f"{ORDER_FIELDS}, _corrupt_record STRING").option("multiLine", True).option("recursiveFileLookup", True).json(path)
    marked = text.select("id", "customer_id", "amount", "status", F.col("_corrupt_record").isNotNull().alias("unreadable"))
    return with_reasons(marked, _order_rules())


ENVELOPE = "id BIGINT, type STRING, created_at STRING, actor BIGINT, repo BIGINT"


def read_event_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Hourly ``YYYY-MM-DD-H`` files of JSON lines: typed envelope, raw line, and the file's hour.

    The hour is not zero-padded. The payload stays raw text, so new fields and
    unknown types pass through unchanged.
    """
    name = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{4}-\d{2}-\d{2}-\d{1,2})(?:[./]|$)", 1)
    parsed = spark.read.text(path).select(
        name.alias("file_hour"), F.from_json("value", ENVELOPE).alias("e"),
        F.get_json_object("value", "$.payload").alias("payload"), F.col("value").alias("raw"),
    )
    return parsed.select("file_hour", "e.*", "payload", "raw")


def route_by_type(envelopes: DataFrame, known: Sequence[str]) -> DataFrame:
    """Adds ``route``: the type itself when known, else "unknown"; no row is lost."""
    return envelopes.withColumn("route", F.when(F.col("type").isin(*known), F.col("type")).otherwise("unknown"))


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 1000, **options: str) -> None:
    """Append to a database in batches from the executors."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch)
    writer.options(**options).mode("append").save()
