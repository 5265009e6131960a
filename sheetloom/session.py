"""Session defaults and the shared scratch area."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

_TO_DELETE_AT_EXIT: set[str] = set()
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def get_spark(app_name: str = "sheetloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans in this package expect."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # call sites of single expressions are not worth their cost in plans this wide
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is the folder named by ``spark.checkpoint.dir``. A local-mode session that names none uses a folder below
    the warehouse; on a cluster the setting is required, because its folder must be one that all executors reach.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`scratch_dir`. The application's scratch folder goes when the application ends."""
    folder = f"{scratch_dir(spark)}/sheetloom/{spark.sparkContext.applicationId}"
    if folder not in _TO_DELETE_AT_EXIT:
        _TO_DELETE_AT_EXIT.add(folder)
        p, fs = hadoop_path(spark, folder)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, when no result that reads them may be in use any more."""
    if _STAGED.get() is not None:  # the outer scope deletes them
        yield
        return
    paths: list[str] = []
    token = _STAGED.set(paths)
    try:
        yield
    finally:
        _STAGED.reset(token)
        for path in paths:
            p, fs = hadoop_path(spark, path)
            fs.delete(p, True)


@dataclass(frozen=True)
class StagedSize:
    """What was written: rows, and a rough size of their values (None if not asked for)."""

    rows: int
    bytes: int | None


def row_width(df: DataFrame) -> Column:
    """Rough size of a row, as text with the names of its columns. Only nested columns are written out for it."""

    def width(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0))
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0))
        return F.lit(8)

    return reduce(Column.__add__, map(width, df.schema), F.lit(sum(len(c) + 6 for c in df.columns)).cast("long"))


def stage(df: DataFrame, name: str, measured: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage to recompute after an executor is lost and is computed once however
    often it is used. Its row count, and with ``measured`` its size, are taken while writing and
    kept on the result (:func:`staged_size`), so a later size check costs nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (staged_here := _STAGED.get()) is not None:
        staged_here.append(path)
    seen = Observation()
    wanted = [F.count(F.lit(1)).alias("rows")]
    if measured:
        wanted.append(F.sum(row_width(df)).alias("bytes"))
    df.observe(seen, *wanted).write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    size = seen.get
    staged._staged_size = StagedSize(size["rows"], (size["bytes"] or 0) if measured else None)
    return staged


def staged_size(df: DataFrame) -> StagedSize | None:
    """The size of a staged table; None for any other DataFrame."""
    return getattr(df, "_staged_size", None)
