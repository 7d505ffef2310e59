"""Session settings and the shared folder that stage tables go to."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime re-planning does the skew and broadcast work of this library: joins are
# never hinted, so a side is broadcast only once its measured size is under the
# threshold, and hot keys of the remaining shuffled joins are split.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# drops the shuffle files of a write as soon as the written table replaces them
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# lets joins keep rows where they were dealt by some of the join's keys; partitions
# stay small, as several steps then run in one task
TOGETHER = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

# paths of the stage tables made while others are built, those of the innermost last
_made: list[list[str]] = []


def tune(spark: SparkSession) -> SparkSession:
    """Set the adaptive options the user has not set, neither at start nor at run time."""
    given = spark.conf.getAll
    for key, value in ADAPTIVE.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the checkpoint folder of the session.

    One given to ``setCheckpointDir`` comes before ``spark.checkpoint.dir``. There is no
    local fallback: files on one machine are lost to all others.
    """
    configured = (spark.conf.get("spark.checkpoint.dir", None) or "").rstrip("/")
    given = spark.sparkContext.getCheckpointDir() or ""
    bare = configured.removeprefix("file://").removeprefix("file:")
    if given and not (bare and bare in given):
        return given.rstrip("/")
    if configured:
        return configured
    raise ValueError("set spark.checkpoint.dir, or call setCheckpointDir, to a folder all executors share")


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _options(spark: SparkSession, options: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in options}
    for key, value in options.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _write(df: DataFrame, path: str, together: bool, mode: str = "overwrite", **options: str) -> None:
    with _options(df.sparkSession, {CLEANUP: "true"} | (TOGETHER if together else {})):
        df.write.mode(mode).options(**options).parquet(path)


def stage(df: DataFrame, name: str, together: bool = False) -> DataFrame:
    """Write ``df`` once as a stage table and return the scan of it.

    Stages feed several later plans; reading them back from shared storage cuts the
    lineage and survives the loss of executors. ``unstage`` removes one that is done.
    With ``together`` its joins keep rows dealt by some of their keys, so tables that were
    dealt by one column are shuffled once, whatever else they are joined by.
    """
    path = stage_path(df.sparkSession, name)
    _write(df, path, together)
    if _made:
        _made[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(
    spark: SparkSession, name: str, build: Callable[..., DataFrame], together: bool = False, parts: int = 0
) -> DataFrame:
    """``build()`` as a stage table; the stage tables made on the way to it are removed once it is written.

    Those made inside ``lasting`` stay. With ``parts`` the table is put together of ``build(0)``, ``build(1)``
    and so on, written one after the other, so that only the shuffle files of one are on disk at a time.
    """
    path = stage_path(spark, name)
    _made.append([])
    try:
        for nth in range(max(1, parts)):
            df = build(nth) if parts else build()
            _write(df, path, together, "append" if nth else "overwrite", compression="zstd")
        for passing in _made[-1]:
            _remove(spark, passing)
    finally:
        _made.pop()
    if _made:
        _made[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


# bytes of a staged table that are worth a part, and the most parts, as each reads all tables
PART_BYTES = 32 << 20
PARTS = 8


def parts_of(table: DataFrame) -> int:
    """How many parts a table made from the stage table ``table`` is to be written in."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, min(PARTS, -(-size // PART_BYTES)))


def part(df: DataFrame, key: str, like: DataFrame, nth: int, parts: int) -> DataFrame:
    """The rows of ``df`` that can meet those of the same part of ``like`` in joins by ``key``.

    Equal values of different types have different hashes; a table whose key has another type than in
    ``like`` takes part as a whole.
    """
    if parts == 1 or key not in df.columns or df.schema[key].dataType != like.schema[key].dataType:
        return df
    return df.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == nth)


def apart(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()``, a stage table; the others made on the way to it are removed."""
    _made.append([])
    try:
        table = build()
        *passing, path = _made[-1]
        for folder in passing:
            _remove(spark, folder)
    finally:
        _made.pop()
    if _made:
        _made[-1].append(path)
    return table


@contextmanager
def lasting() -> Iterator[None]:
    """Stage tables made in here outlive the table they are made for."""
    _made.append([])
    try:
        yield
    finally:
        _made.pop()


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unstage(*tables: DataFrame) -> None:
    """Remove stage tables that nothing will read again."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            _remove(table.sparkSession, folder)
