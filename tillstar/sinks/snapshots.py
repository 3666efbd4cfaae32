"""CSV exports with a header: quotes only where needed, NULL as nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def export_csv(df: DataFrame, path: str) -> None:
    """Write df to the folder `path` in its own order.

    A sorted frame is range-partitioned, so its part files are in order. AQE merges
    small partitions, so a report is one file, and a large result is not forced
    through one task.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def export_all(spark: SparkSession, frames: dict[str, DataFrame], out: str) -> list[str]:
    """Export each frame to out/<name>.csv.

    All are written to a staging folder first, so a failing query replaces nothing. The folders
    are replaced one after another; `publish` changes all at once.
    """
    out = out.rstrip("/")
    staging = f"{out}/_staging-{uuid.uuid4().hex}"
    paths = spark._jvm.org.apache.hadoop.fs.Path
    fs = paths(out).getFileSystem(spark._jsc.hadoopConfiguration())
    targets = {name: f"{out}/{name}.csv" for name in frames}
    try:
        for name, df in frames.items():
            export_csv(df, f"{staging}/{name}.csv")
        for name, target in targets.items():
            fs.delete(paths(target), True)
            if not fs.rename(paths(f"{staging}/{name}.csv"), paths(target)):
                raise OSError(f"could not publish {target}")
    finally:
        fs.delete(paths(staging), True)
    return list(targets.values())


#: Folders of publish(): immutable snapshots, and one small file per publication.
_SNAPSHOTS, _POINTERS = "snapshots", "published"


def publish(spark: SparkSession, frames: dict[str, DataFrame], out: str) -> str:
    """Export all frames at once: readers see all old ones or all new ones, whatever fails.

    The frames go to a new folder that nobody else writes. Then a numbered pointer file names that
    folder; it is created, never replaced, so of two publications at a time the second takes the
    next number. Returns the folder.
    """
    out = out.rstrip("/")
    name = f"{_SNAPSHOTS}/{uuid.uuid4().hex}"
    for frame, df in frames.items():
        export_csv(df, f"{out}/{name}/{frame}.csv")
    paths = spark._jvm.org.apache.hadoop.fs.Path
    fs = paths(out).getFileSystem(spark._jsc.hadoopConfiguration())
    number = max([n for n, _ in _pointers(spark, out)], default=0) + 1
    taken = True
    while taken:
        pointer = paths(f"{out}/{_POINTERS}/{number:012d}")
        taken = fs.exists(pointer)
        if not taken:
            # fails if another publication has just taken the number
            stream = fs.create(pointer, False)
            stream.write(bytearray(name.encode()))
            stream.close()
        number += 1
    return f"{out}/{name}"


def _pointers(spark: SparkSession, out: str) -> list[tuple[int, int]]:
    """Number and length of each pointer file."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    folder = paths(f"{out}/{_POINTERS}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return [(int(s.getPath().getName()), s.getLen()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()]


def published(spark: SparkSession, out: str) -> str:
    """The folder of the latest complete publication. A pointer that is still empty doesn't count."""
    out = out.rstrip("/")
    complete = [n for n, length in _pointers(spark, out) if length]
    if not complete:
        raise LookupError(f"nothing is published in {out}")
    pointer = f"{out}/{_POINTERS}/{max(complete):012d}"
    return f"{out}/{spark.read.text(pointer, wholetext=True).first()[0].strip()}"


def read_published(spark: SparkSession, out: str, name: str, schema) -> DataFrame:
    """One frame of the latest publication."""
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    return reader.csv(f"{published(spark, out)}/{name}.csv")
