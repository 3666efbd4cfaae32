"""Session settings that suit these jobs at any size.

They leave the choice of join to adaptive execution, which knows the sizes by then.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # split a hot key's partition, merge small ones
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # hash instead of sort where every partition of the thin side is this small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # large scans: fewer, longer tasks
    "spark.sql.files.maxPartitionBytes": "256m",
}


def shuffle_partitions(shuffled_bytes: int, cores: int, per_task: int = 128 << 20) -> int:
    """Partitions for the largest shuffle: about per_task bytes each, all cores busy."""
    return max(cores, -(-shuffled_bytes // per_task))


#: Stored Parquet against the same rows in a shuffle.
SHUFFLED_PER_STORED = 4


@contextmanager
def sized_shuffles(spark: SparkSession, *paths: str):
    """For a while, enough shuffle partitions for jobs over what is stored under `paths`. Never
    fewer than the session has; adaptive execution merges those that turn out small."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    size = SHUFFLED_PER_STORED * stored_bytes(spark, *paths)
    wanted = shuffle_partitions(size, spark.sparkContext.defaultParallelism)
    spark.conf.set(key, str(max(int(before), wanted)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of files and folders; what isn't there has none."""
    total = 0
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(path):
            total += files.getContentSummary(path).getLength()
    return total


def session(
    app: str = "tillstar", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings above, or with `settings` where both name a key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | (settings or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
