"""Writers that can be repeated: a rerun of the same cycle leaves the same table.

Tables are Parquet folders on storage all executors share.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

KEEP_PREFIX = "hist_moyenne_"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def _delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def _children(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)))


def write_snapshot(df: DataFrame, folder: str, prefix: str, stamp: dt.datetime) -> str:
    """CSV export named ``{prefix}_YYYYMMDD_HHMMSS.csv`` with a header in every part."""
    path = f"{folder}/{prefix}_{stamp:%Y%m%d_%H%M%S}.csv"
    df.write.mode("overwrite").option("header", True).option(
        "timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"
    ).option("escape", '"').csv(path)
    return path


def write_large_rows(df: DataFrame, path: str) -> None:
    """Add rows that may be many megabytes each, like payloads, to a Parquet folder.

    By default Parquet looks at its buffers after 100 rows only, a reader decodes the rows of a group
    together, and the statistics of a text column are whole values, kept until the file is closed.
    Here a group ends after about a megabyte of compressed data and texts have no statistics, so that
    writers and readers hold one large row at a time. zstd compresses without buffers of a row's length.
    """
    options = {"compression": "zstd", "parquet.block.size": 1 << 20, "parquet.enable.dictionary": "false"}
    options |= {f"parquet.page.size.row.check.{bound}": 1 for bound in ("min", "max")}  # after every row
    options |= {f"parquet.column.statistics.enabled#{c}": "false" for c, kind in df.dtypes if kind == "string"}
    df.write.mode("append").options(**options).parquet(path)


def append_history(
    df: DataFrame, path: str, cycle: int | str, partition_by: Sequence[str] = ()
) -> None:
    """Add the rows of one cycle. The path is created by the first append.

    Every cycle owns its partitions, and writing it again replaces them all: a
    restarted batch cannot add its rows twice, and files of days that the rerun
    no longer has go after its job has committed.
    """
    _append(df.withColumn("cycle", F.lit(str(cycle))), path, [cycle], partition_by)


def append_cycles(df: DataFrame, path: str, cycles: Sequence[int | str], partition_by: Sequence[str] = ()) -> None:
    """:func:`append_history` for several cycles in one job; ``df`` has a column ``cycle``.

    All of ``cycles`` are replaced, those without rows too. The rows of a partition meet in one task.
    """
    whole = df.withColumn("cycle", F.col("cycle").cast("string")).repartition(*partition_by, "cycle")
    _append(whole, path, cycles, partition_by)


def _append(df: DataFrame, path: str, cycles: Sequence[int | str], partition_by: Sequence[str]) -> None:
    spark, depth = df.sparkSession, len(partition_by)
    before = _cycle_files(spark, path, cycles, depth)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, "cycle")
        .parquet(path)
    )
    # a partition that was written again has new files only
    for stale in before & _cycle_files(spark, path, cycles, depth):
        _delete(spark, stale)


def _cycle_files(spark: SparkSession, path: str, cycles: Sequence[int | str], depth: int) -> set[str]:
    """Data files of some cycles, below ``depth`` other partition columns."""
    found: set[str] = set()
    for cycle in cycles:
        pattern = _path(spark, f"{path}/{'*/' * depth}cycle={cycle}/part-*")
        found |= {s.getPath().toString() for s in _fs(spark, path).globStatus(pattern) or []}
    return found


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None before its first append."""
    if not exists(spark, path):
        return None
    return spark.read.option("mergeSchema", "false").parquet(path)


def read_day(spark: SparkSession, path: str, service_date: str) -> DataFrame | None:
    """One service day of a table partitioned by it, or None; other days are not even listed."""
    if not exists(spark, f"{path}/service_date={service_date}"):
        return None
    return spark.read.option("basePath", path).parquet(f"{path}/service_date={service_date}")


def _version_name(version: int) -> str:
    return f"v{version:020d}"  # wide enough for a time in microseconds


def _versions(spark: SparkSession, path: str) -> list[str]:
    return [v for v in _children(spark, path) if exists(spark, f"{path}/{v}/_SUCCESS")]


def rebuild(df: DataFrame, path: str, version: int, keep: int = 2) -> DataFrame:
    """Replace a derived table by a new version and return it.

    The new version gets its own folder, so ``df`` may read the current one. A
    version counts once its job has committed; older ones beyond ``keep`` go.
    """
    spark = df.sparkSession
    name = _version_name(version)
    df.write.mode("overwrite").parquet(f"{path}/{name}")
    for old in _versions(spark, path)[:-keep]:
        if old != name:
            _delete(spark, f"{path}/{old}")
    return spark.read.parquet(f"{path}/{name}")


def current_path(spark: SparkSession, path: str, before: int | None = None) -> str | None:
    """Folder of the newest committed version (older than ``before``), or None."""
    found = [v for v in _versions(spark, path) if before is None or v < _version_name(before)]
    return f"{path}/{found[-1]}" if found else None


def read_current(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    newest = current_path(spark, path, before)
    return spark.read.parquet(newest) if newest else None


def drop_versions(spark: SparkSession, path: str) -> None:
    if exists(spark, path):
        _delete(spark, path)


def archive_and_retain(
    spark: SparkSession,
    tables: Mapping[str, str],
    archive: str,
    service_date: str,
    keep_prefix: str = KEEP_PREFIX,
) -> dict[str, int]:
    """Close a service day: export every table, then drop what is not kept.

    ``tables`` maps names to paths. Tables partitioned by service_date lose that
    partition only, other ones go whole; names with ``keep_prefix`` lose nothing.
    Returns rows exported per table.

    The exports count once a manifest of their rows and checksums is in place, put there by
    a rename; nothing is dropped before. The counts come from the write itself, the check of
    the written files reads them once. A run that ends anywhere can be repeated: with a
    manifest it goes on dropping, without one it exports again. A table that has changed
    since its export is exported again, beside what was archived of it before.
    """
    manifest = _manifest(spark, archive, service_date)
    if manifest is None:
        manifest = _export(spark, tables, archive, service_date)
        _write_text(spark, f"{_manifest_path(archive, service_date)}.open", json.dumps(manifest))
    for name, entry in manifest["tables"].items():
        if name.startswith(keep_prefix) or not exists(spark, entry["source"]):
            continue
        if _size(spark, entry["source"]) != entry["size"]:
            _delete(spark, f"{_manifest_path(archive, service_date)}.open")
            raise RuntimeError(f"{name} has changed since its export; close {service_date} again")
        _delete(spark, entry["source"])
    done, n = f"{_manifest_path(archive, service_date)}.done", manifest["run"]
    _fs(spark, done).rename(_path(spark, f"{_manifest_path(archive, service_date)}.open"), _path(spark, f"{done}-{n}"))
    return {name: entry["rows"] for name, entry in manifest["tables"].items()}


def _manifest_path(archive: str, service_date: str) -> str:
    return f"{archive}/_manifests/{service_date}"


def _manifest(spark: SparkSession, archive: str, service_date: str) -> dict | None:
    path = f"{_manifest_path(archive, service_date)}.open"
    if not exists(spark, path):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is either whole or absent."""
    fs, part = _fs(spark, path), f"{path}.tmp"
    out = fs.create(_path(spark, part), True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not fs.rename(_path(spark, part), _path(spark, path)):
        raise RuntimeError(f"{path} could not be put in place")


def _size(spark: SparkSession, path: str) -> list[int]:
    summary = _fs(spark, path).getContentSummary(_path(spark, path))
    return [summary.getFileCount(), summary.getLength()]


def _checksum(columns: Sequence[str]) -> Column:
    """Of rows as text, in any order."""
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]
    return F.coalesce(F.sum(F.xxhash64(*texts).cast("decimal(38,0)")), F.lit(0)).cast("string")


def _export(spark: SparkSession, tables: Mapping[str, str], archive: str, service_date: str) -> dict:
    before = [c for c in _children(spark, f"{archive}/_manifests") if c.startswith(f"{service_date}.done-")]
    run, entries = len(before), {}
    for name, path in tables.items():
        if not exists(spark, path):
            continue
        part = f"{path}/service_date={service_date}"
        source = part if any(c.startswith("service_date=") for c in _children(spark, path)) else path
        if not exists(spark, source):
            continue
        size = _size(spark, source)
        df = spark.read.parquet(source)
        df = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
        target = f"{archive}/{name}/service_date={service_date}" + (f"/run={run}" if run else "")
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), _checksum(df.columns).alias("checksum")).write.mode("overwrite").option(
            "header", True).option("escape", '"').csv(target)
        wanted = seen.get
        back = spark.read.schema(_as_text(df)).option("header", True).option("escape", '"').option("multiLine", True).csv(target)
        written = back.agg(F.count(F.lit(1)).alias("rows"), _checksum(df.columns).alias("checksum")).first().asDict()
        if written != wanted:
            raise RuntimeError(f"{name}: {wanted} in the table, {written} in its export")
        entries[name] = {"rows": wanted["rows"], "checksum": wanted["checksum"], "source": source, "size": size, "export": target}
    return {"service_date": service_date, "run": run, "tables": entries}


def _as_text(df: DataFrame) -> str:
    return ", ".join(f"`{c}` string" for c in df.columns)
