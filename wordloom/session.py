"""Session builder and the staging of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: list[tempfile.TemporaryDirectory] = []

#: Shuffle files of a staged step go when it is written, not when the driver's JVM comes to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PASSES = 4  # parts of a wide step that are run one after the other
ROWS_PER_PASS = 1_000_000


def build_session(app: str = "wordloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; everything else is left to the cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``; a ``file:`` folder is taken only with a local
    master, which may also fall back to a folder of its own, removed when Python exits.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.startswith("local")
    if named and (local or not named.startswith("file:")):
        return named.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
    if not _local_dirs:
        _local_dirs.append(tempfile.TemporaryDirectory(prefix="wordloom-"))
    return _local_dirs[0].name


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/wordloom/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """A scan's rows over all cores if the files came in fewer splits than there are cores.

    For scans alone, before any join: then counting the splits starts no job. Large inputs pass unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


_scopes: list[list[DataFrame]] = []


@contextmanager
def passing() -> Iterator[None]:
    """Tables staged inside are removed at the end, unless they are staged with ``keep``: these belong to the scope around it, if any."""
    _scopes.append([])
    try:
        yield
    finally:
        for df in _scopes.pop():
            discard(df)


@contextmanager
def lasting() -> Iterator[None]:
    """Tables staged inside belong to no scope around it."""
    held, _scopes[:] = _scopes[:], []
    try:
        yield
    finally:
        _scopes[:] = held


def discard(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing will read again."""
    context = df.sparkSession.sparkContext
    for path in df.__dict__.pop("_staged", []):
        path = context._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def same_files(df: DataFrame, staged: DataFrame) -> DataFrame:
    """``df``, which reads a staged table, as that table: to ``discard`` it removes the files."""
    df._staged = staged._staged
    return df


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the true
    size of the table, so that it broadcasts it only below its own threshold.
    ``keep`` as in ``passing``.
    """
    return stage_each([df], name, keep)


def stage_each(parts: Iterable[DataFrame], name: str, keep: bool = False) -> DataFrame:
    """``stage`` for a table that is made in parts, one after the other: the shuffle files of one part go before the next is made."""
    paths = []
    for df in parts:
        paths.append(new_path(df.sparkSession, name))
        conf = df.sparkSession.conf
        before = conf.get(CLEANUP, "false")
        conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(paths[-1])
        finally:
            conf.set(CLEANUP, before)
    staged = df.sparkSession.read.schema(df.schema).parquet(*paths)
    staged._staged = paths
    scopes = _scopes[:-1] if keep else _scopes
    if scopes:
        scopes[-1].append(staged)
    return staged


def passes(rows: int) -> int:
    """In how many parts a step over so many rows is made."""
    return max(1, min(PASSES, rows // ROWS_PER_PASS))
