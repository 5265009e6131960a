"""The published dataset.

A target's rows are dealt into a fixed number of buckets by their id. A version is a small file that lists the folder of
every bucket, and the small tables that belong to it; readers take the newest. A full write makes all buckets anew; a
merge writes only the buckets that get rows and lists the others where they are, so an increment rewrites what it touches.

A run writes into a folder of its own, so what is being read is never overwritten and a failed or repeated run leaves the
published data as it was. Publishing creates the file of the next version, which only one of several runs can do; the
others get a :class:`PublishConflict` and merge again onto the winner's version.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from itertools import count

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sheetloom.operators.dedup import merge_upsert
from sheetloom.operators.lookup import DEFAULT_LIMITS, LookupLimits
from sheetloom.operators.quality import check_columns, check_counts
from sheetloom.operators.shape import conform_schema
from sheetloom.session import hadoop_path
from sheetloom.spec import DatasetSpec

PUBLISHED = "_published"
BUCKET = "bucket"

# The small tables that may belong to a version: the runs of rows read, the header rows of the tabs, what is known of the
# blocks of the landing, and what the load did with each tab.
_TAB = "source_spreadsheet string, source_sheet string"
TABLES = {
    "marks": f"{_TAB}, first bigint, last bigint",
    "headers": f"{_TAB}, landed_seq bigint, cells array<string>",
    "blocks": f"{_TAB}, block bigint, files string, waiting boolean",
    "report": f"{_TAB}, n_rows bigint, last_row bigint, new_rows bigint, note string",
}


class PublishConflict(RuntimeError):
    """Another run published first."""


def bucket_of(record_id: Column, buckets: int) -> Column:
    """The bucket of an id: the same hash by which a shuffle on the id deals rows, so that with as many shuffle
    partitions as buckets every task of a keep-last holds whole buckets."""
    return F.pmod(F.hash(record_id), F.lit(buckets))


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = hadoop_path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(p)] if fs.exists(p) else []


def _published(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, in order."""
    found = (re.fullmatch(r"([0-9]+)\.json", name) for name in _names(spark, f"{path}/{PUBLISHED}"))
    return sorted(int(m[1]) for m in found if m)


def _create(spark: SparkSession, file: str, text: str) -> bool:
    """Create a file unless it exists; of several callers exactly one succeeds.

    On local disk a finished draft is linked to the name. Elsewhere the file system's own exclusive create decides.
    """
    p, fs = hadoop_path(spark, file)
    fs.mkdirs(p.getParent())
    if fs.getScheme() == "file":
        final = p.toUri().getPath()
        draft = f"{os.path.dirname(final)}/.draft-{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(draft, final)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    try:
        stream = fs.create(p, False)
    except Exception as error:  # noqa: BLE001
        if fs.exists(p):
            return False
        raise error
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    return True


def _read(spark: SparkSession, file: str) -> str:
    p, fs = hadoop_path(spark, file)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _content(spark: SparkSession, path: str, version: int, patience: float = 10.0) -> dict:
    """A version's file. One that is only just being written is waited for."""
    waited = 0.0
    while True:
        text = _read(spark, f"{path}/{PUBLISHED}/{version}.json")
        try:
            return json.loads(text)
        except json.JSONDecodeError:
            if waited >= patience:
                raise
            time.sleep(0.2)
            waited += 0.2


def _publish(spark: SparkSession, path: str, version: int, content: dict) -> None:
    if not _create(spark, f"{path}/{PUBLISHED}/{version}.json", json.dumps(content)):
        raise PublishConflict(f"version {version} of {path} was published by another run")


def _own_folder(spark: SparkSession, path: str, version: int) -> str:
    """A folder below ``path`` that no other run has or will get."""
    taken = set(_names(spark, path))
    for k in count():
        name = f"v={version}.{k}" if k else f"v={version}"
        if name not in taken and _create(spark, f"{path}/{name}/_owner", uuid.uuid4().hex):
            return name
    raise AssertionError


def target_exists(spark: SparkSession, path: str) -> bool:
    """Is there a published version? Decides between a full and an incremental load."""
    return bool(_published(spark, path))


def target_info(spark: SparkSession, path: str) -> dict:
    """What was recorded when the current version was published; an error if there is none.

    ``next`` is the number that the version after it will have. The file of a run that died while publishing stays
    unreadable and is passed over.
    """
    versions = _published(spark, path)
    for version in reversed(versions):
        try:
            return _content(spark, path, version) | {"next": versions[-1] + 1}
        except json.JSONDecodeError:
            continue
    raise FileNotFoundError(f"no published dataset at {path}")


def _scan(spark: SparkSession, path: str, info: dict, spec: DatasetSpec, buckets: list[int] | None = None) -> DataFrame:
    parts = [info["parts"][b] for b in (range(len(info["parts"])) if buckets is None else buckets)]
    folders = [f"{path}/{p['folder']}" for p in parts if p["rows"]]
    if not folders:
        return spark.createDataFrame([], spec.stored_schema)
    return spark.read.schema(spec.stored_schema).parquet(*folders)


def scan_target(spark: SparkSession, path: str, spec: DatasetSpec) -> DataFrame:
    """The current version; an error if nothing was published."""
    return _scan(spark, path, target_info(spark, path), spec)


def scan_table(spark: SparkSession, path: str, name: str, info: dict | None = None) -> DataFrame | None:
    """A small table kept with the version (one of :data:`TABLES`), if it has it."""
    folder = (info or target_info(spark, path))["tables"].get(name)
    return spark.read.schema(TABLES[name]).parquet(f"{path}/{folder}") if folder else None


def scan_marks(spark: SparkSession, path: str) -> DataFrame | None:
    """The runs of rows read up to the current version, if it has any."""
    return scan_table(spark, path, "marks")


def scan_report(spark: SparkSession, path: str) -> DataFrame | None:
    """The tab report of the load that published the current version, if it has one."""
    return scan_table(spark, path, "report")


def _base(spark: SparkSession, path: str) -> dict:
    """The newest version, or what stands for it before the first."""
    return target_info(spark, path) if target_exists(spark, path) else {"next": 1, "parts": [], "tables": {}}


def _write_all(spark: SparkSession, path: str, folder: str, rows: DataFrame | None, tables: dict[str, DataFrame] | None) -> dict[str, str]:
    """Write the rows by buckets and the small tables, all at once; returns the folders of the tables."""

    def write_rows() -> None:
        rows.write.partitionBy(BUCKET).option("compression", "snappy").parquet(f"{path}/{folder}/data")

    def write_table(name: str) -> None:
        columns = [c.split()[0] for c in TABLES[name].split(", ")]
        tables[name].select(*columns).write.parquet(f"{path}/{folder}/{name}")

    runs = [write_rows] if rows is not None else []
    runs += [partial(write_table, name) for name in tables or {}]
    with ThreadPoolExecutor(max(1, len(runs))) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(run)) for run in runs]:
            done.result()
    return {name: f"{folder}/{name}" for name in tables or {}}


def _write_version(
    df: DataFrame,
    path: str,
    spec: DatasetSpec,
    base: dict,
    parts: list[dict],
    tables: dict[str, DataFrame] | None,
    name: str,
    carried: dict[str, str],
) -> int:
    """Write ``df``, in the stored schema, by buckets, validate the files, and publish them with the other ``parts`` as the
    version after ``base``."""
    spark, version = df.sparkSession, base["next"]
    folder = _own_folder(spark, path, version)
    rows = df.select(*spec.columns, bucket_of(F.col("record_id"), len(parts)).alias(BUCKET))
    written_tables = _write_all(spark, path, folder, rows, tables)
    written = spark.read.schema(T.StructType([*spec.stored_schema, T.StructField(BUCKET, T.IntegerType())])).parquet(f"{path}/{folder}/data")
    check_columns(written, spec, name, stored=True)
    counted = written.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("record_id").isNull()).alias("nulls"))
    found = counted.collect()  # one row per bucket
    check_counts(sum(r["rows"] for r in found), sum(r["nulls"] for r in found), name)
    for r in found:
        parts[r[BUCKET]] = {"folder": f"{folder}/data/{BUCKET}={r[BUCKET]}", "rows": r["rows"]}
    total = sum(p["rows"] for p in parts)
    about = {"version": version, "rows": total, "folder": folder, "unique_ids": True, "parts": parts, "tables": carried | written_tables}
    _publish(spark, path, version, about)
    return total


def write_target(
    df: DataFrame,
    path: str,
    spec: DatasetSpec,
    name: str = "table",
    tables: dict[str, DataFrame] | None = None,
    buckets: int | None = None,
    stripped: bool = False,
) -> int:
    """Write ``df`` as a new version in the stored schema, validate it, and publish it. Ids must be unique.

    Validation reads one column of the files just written, so the plan behind ``df`` runs once. An
    empty or invalid version is never published. Returns the row count. ``buckets`` defaults to the number of
    shuffle partitions: then rows that come from a keep-last are written without another shuffle. ``stripped``: as for
    :func:`~sheetloom.operators.shape.conform_schema`.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    none = [{"folder": None, "rows": 0}] * buckets
    return _write_version(conform_schema(df, spec, stripped), path, spec, _base(spark, path), none, tables, name, {})


def merge_target(
    new: DataFrame,
    path: str,
    spec: DatasetSpec,
    info: dict,
    name: str = "table",
    tables: dict[str, DataFrame] | None = None,
    limits: LookupLimits = DEFAULT_LIMITS,
) -> int:
    """Merge ``new`` (staged, in the stored schema, unique ids) into the version ``info`` and publish the result.

    Only the buckets that hold an id of ``new`` are read and written. Raises :class:`PublishConflict` if ``info`` is no
    longer the current version when it is done.
    """
    spark, parts = new.sparkSession, list(info["parts"])
    bucket = bucket_of(F.col("record_id"), len(parts)).alias(BUCKET)
    touched = sorted(r[BUCKET] for r in new.select(bucket).distinct().collect())  # at most one row per bucket
    existing = _scan(spark, path, info, spec, touched)
    merged = merge_upsert(existing, new, existing_unique=bool(info.get("unique_ids")), new_unique=True, limits=limits, by_key=True)
    return _write_version(merged, path, spec, info, parts, tables, name, info["tables"])


def publish_tables(spark: SparkSession, path: str, info: dict, tables: dict[str, DataFrame]) -> None:
    """A version with the rows of ``info`` and other small tables."""
    version = info["next"]
    folder = _own_folder(spark, path, version)
    written = info["tables"] | _write_all(spark, path, folder, None, tables)
    _publish(spark, path, version, info | {"version": version, "folder": folder, "tables": written})


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` published versions, and every older folder that none of those lists."""
    published = _published(spark, path)
    kept, old = published[-max(keep, 1) :], published[: -max(keep, 1)]
    if not kept:
        return []
    infos = []
    for version in kept:
        try:
            infos.append(_content(spark, path, version))
        except json.JSONDecodeError:  # died while publishing
            continue
    if not infos:
        return []
    for version in old:
        p, fs = hadoop_path(spark, f"{path}/{PUBLISHED}/{version}.json")
        fs.delete(p, True)
    listed = {p["folder"] for info in infos for p in info["parts"]} | {f for info in infos for f in info["tables"].values()}
    listed |= {info["folder"] for info in infos}
    for name in _names(spark, path):
        number = re.fullmatch(r"v=([0-9]+)(?:\.[0-9]+)?", name)
        if not number or int(number[1]) >= kept[0] or name in listed:
            continue
        inside = [f"{name}/data/{b}" for b in _names(spark, f"{path}/{name}/data") if b.startswith(f"{BUCKET}=")]
        inside += [f"{name}/{t}" for t in _names(spark, f"{path}/{name}") if t not in ("data", "_owner")]
        gone = [folder for folder in inside if folder not in listed]
        for folder in gone if len(gone) < len(inside) else [name]:
            p, fs = hadoop_path(spark, f"{path}/{folder}")
            fs.delete(p, True)
    return old
