"""Layered Parquet tables under one root, and scratch space for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LAYERS = ("raw", "stg", "core")


class MissingTableError(LookupError):
    """A table that a later step depends on is not there."""


def _files(spark: SparkSession, path: str):
    """The file system that holds a path, and the path as it wants it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def ensure_layers(spark: SparkSession, root: str) -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}/{layer}'")


#: Tables that are stored in folders by the value of a column, in builds.
BY_DATE = {"stg.stg_orders": "in_2024", "core.fact_sales": "order_date"}


class Warehouse:
    """Tables named layer.table, each a Parquet folder root/layer/table.

    Writing replaces the old table, so a build can run again. With catalog=True the
    tables also exist as raw.*, stg.* and core.* for spark.sql. `layout` names the column by
    which a table is split into folders: filters and joins on it read only the folders they need.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        catalog: bool = False,
        layout: dict[str, str] | None = None,
        marked: bool = True,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.catalog = catalog
        self.layout = layout or {}
        self.marked = marked
        if catalog:
            ensure_layers(spark, self.root)

    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def _writer(self, df: DataFrame, table: str) -> DataFrameWriter:
        by = self.layout.get(table)
        if by:
            # all rows of a folder in few files, but a large folder's rows in many tasks
            df = df.hint("rebalance", by)
        writer = df.write.mode("overwrite").format("parquet")
        if not self.marked:
            writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        return writer.partitionBy(by) if by else writer

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """Store df and return the stored table, with the columns in the order of df."""
        writer = self._writer(df, table)
        if self.catalog:
            writer.option("path", self.path(table)).saveAsTable(table)
        else:
            writer.save(self.path(table))
        return self.read(table, df.schema).select(df.columns)

    def replace(self, df: DataFrame, table: str, first, last) -> list[str]:
        """Put df in the place of the folders from `first` to `last` of a table with a layout.

        No other folder is touched. df is stored apart before, so it may come from the table
        itself, and a failure in it changes nothing. Returns the values whose folder went or came.
        """
        by = self.layout[table]
        apart = scratch(self.spark)
        apart.layout = self.layout
        rows = apart.write(df.where(F.col(by).between(first, last)), table)
        new = set(apart.folders(table, first, last))
        gone = set(self.folders(table, first, last)) - new
        writer = self._writer(rows, table).option("partitionOverwriteMode", "dynamic")
        writer.save(self.path(table))
        files, path = _files(self.spark, self.path(table))
        for value in gone:
            files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(path, f"{by}={value}"), True)
        if self.catalog:
            self.spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
            self.spark.catalog.refreshTable(table)
        return sorted(new | gone)

    def folders(self, table: str, first, last) -> list[str]:
        """Values of a table's layout column from `first` to `last`, by its folders."""
        files, path = _files(self.spark, self.path(table))
        names = [status.getPath().getName() for status in files.listStatus(path)]
        start = f"{self.layout[table]}="
        values = [n.removeprefix(start) for n in names if n.startswith(start)]
        return sorted(v for v in values if str(first) <= v <= str(last))

    def drop(self, table: str) -> None:
        if self.catalog:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        files, path = _files(self.spark, self.path(table))
        files.delete(path, True)

    def write_all(self, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Store frames that do not depend on each other as concurrent jobs."""
        write = inheritable_thread_target(self.spark)(self.write)
        with ThreadPoolExecutor(max_workers=len(frames)) as pool:
            jobs = {name: pool.submit(write, df, name) for name, df in frames.items()}
        return {name: job.result() for name, job in jobs.items()}

    def read(self, table: str, schema: StructType | None = None) -> DataFrame:
        """A stored table; a known schema spares the look into a footer."""
        if self.catalog:
            return self.spark.table(table)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(self.path(table))

    def require(self, *tables: str) -> None:
        if self.catalog:
            require_tables(self.spark, tables)
            return
        found = [_files(self.spark, self.path(t)) for t in tables]
        missing = [t for t, (files, path) in zip(tables, found) if not files.exists(path)]
        if missing:
            raise MissingTableError(f"missing tables: {', '.join(missing)}")


def require_tables(spark: SparkSession, tables) -> None:
    missing = [t for t in tables if not spark.catalog.tableExists(t)]
    if missing:
        raise MissingTableError(f"missing tables: {', '.join(missing)}")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir.

    Only a local session may go without; it gets a new temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tillstar-")


def scratch(spark: SparkSession) -> Warehouse:
    """A new, empty warehouse in the shared folder, which is deleted when the application ends."""
    root = f"{shared_folder(spark).rstrip('/')}/tillstar-{uuid.uuid4().hex}"
    files, path = _files(spark, root)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return Warehouse(spark, root, marked=False)
