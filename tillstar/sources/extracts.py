"""The three CSV extracts, landed as text by column position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillstar import schemas

CUSTOMERS_FILE = "customer_details.csv"
PRODUCTS_FILE = "product_details.csv"
ORDERS_FILE = "orders_2024.csv"


def read_extract(
    spark: SparkSession, path: str, schema: T.StructType, line_breaks_in_fields: bool = True
) -> DataFrame:
    """UTF-8 CSV with a header line that is skipped, quote and escape both '"'.

    A quoted field may hold line breaks, so by default a file is never split: one task
    reads one file, and a big extract should be a folder of many files. For an
    extract known to have no such fields, line_breaks_in_fields=False lets Spark split
    files. A row with the wrong number of columns stops the job, whichever columns it reads.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", line_breaks_in_fields)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)  # a pruned read would not see that a row is torn
        .csv(path)
    )


def read_customers_raw(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_extract(spark, path, schemas.CUSTOMERS_RAW, **options)


def read_products_raw(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_extract(spark, path, schemas.PRODUCTS_RAW, **options)


def read_orders_raw(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_extract(spark, path, schemas.ORDERS_RAW, **options)
