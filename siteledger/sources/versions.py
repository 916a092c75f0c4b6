"""Replacing several tables together: write a version, audit it, then swap one pointer."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# An audit gives (check, violations) for the tables it is handed; any violation stops the load.
Audit = Callable[[Mapping[str, DataFrame]], DataFrame]
LOG = "_log"


class AuditError(ValueError):
    """The new tables break a check; the old ones are untouched."""


def audited(tables: Mapping[str, DataFrame], audit: Audit | None) -> None:
    if audit is None:
        return
    broken = audit(tables).filter("violations > 0").orderBy("check").limit(20).collect()
    if broken:
        raise AuditError("; ".join(f"{r['check']}: {r['violations']}" for r in broken))


def _hadoop(spark: SparkSession, folder: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path
    return path, path(folder).getFileSystem(context._jsc.hadoopConfiguration())


def discard(spark: SparkSession, folder: str) -> None:
    """Delete what was written for a load that is over."""
    path, fs = _hadoop(spark, folder)
    fs.delete(path(folder), True)


def swap_folders(spark: SparkSession, staged: str, target: str, names: Sequence[str]) -> None:
    """Move written folders into place, and the old ones back if a move fails."""
    path, fs = _hadoop(spark, target)
    aside, moved = f"{target}/_replaced-{uuid.uuid4().hex}", []
    fs.mkdirs(path(aside))
    try:
        for name in names:
            had = fs.exists(path(f"{target}/{name}"))
            if had and not fs.rename(path(f"{target}/{name}"), path(f"{aside}/{name}")):
                raise OSError(f"could not move the old {name}")
            moved.append((name, had))
            if not fs.rename(path(f"{staged}/{name}"), path(f"{target}/{name}")):
                raise OSError(f"could not move the new {name}")
    except Exception:
        for name, had in moved:
            if had:
                fs.delete(path(f"{target}/{name}"), True)
                fs.rename(path(f"{aside}/{name}"), path(f"{target}/{name}"))
        raise
    discard(spark, aside)


def _entries(spark: SparkSession, target: str) -> list[tuple[int, str]]:
    """(number, version) of the log, oldest first."""
    path, fs = _hadoop(spark, target)
    if not fs.exists(path(f"{target}/{LOG}")):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path(f"{target}/{LOG}"))]
    return sorted((int(n.split("-")[0]), n.split("-")[1]) for n in names if n.split("-")[0].isdigit())


def current_version(spark: SparkSession, target: str) -> str | None:
    """Folder name of the version that readers see, None before the first one."""
    log = _entries(spark, target)
    return log[-1][1] if log else None


def read_current(spark: SparkSession, target: str, name: str) -> DataFrame:
    version = current_version(spark, target)
    if version is None:
        raise ValueError(f"nothing has been published in {target}")
    return spark.read.parquet(f"{target}/{version}/{name}")


def replace_all(frames: Mapping[str, DataFrame], target: str, audit: Audit | None = None, keep: int = 2) -> DataFrame:
    """Replace all tables of ``target`` together; one row (table, n_rows) for each.

    Every table is written to a new version folder with its count, the written tables are audited, and one new file in
    the log makes the version current.  A failure before that leaves readers on the old version, all tables of it;
    a reader that has planned its query goes on with the files it planned.  The last ``keep`` versions stay.
    Two loads that end at once: the later file wins, each version being whole.
    """
    spark = next(iter(frames.values())).sparkSession
    path, fs = _hadoop(spark, target)
    version = uuid.uuid4().hex
    counts, written = [], {}
    try:
        for name, frame in frames.items():
            seen = Observation()
            frame.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{target}/{version}/{name}")
            counts.append((name, int(seen.get["n"])))
            written[name] = spark.read.parquet(f"{target}/{version}/{name}")
        audited(written, audit)
    except Exception:
        fs.delete(path(f"{target}/{version}"), True)
        raise
    log = _entries(spark, target)
    number = log[-1][0] + 1 if log else 1
    fs.mkdirs(path(f"{target}/{LOG}"))
    if not fs.createNewFile(path(f"{target}/{LOG}/{number:012d}-{version}")):
        raise OSError(f"could not make {version} current")
    for old_number, old in [*log, (number, version)][:-keep]:
        fs.delete(path(f"{target}/{LOG}/{old_number:012d}-{old}"), False)
        fs.delete(path(f"{target}/{old}"), True)
    return spark.createDataFrame(counts, "table string, n_rows bigint")


def publish_all(frames: Mapping[str, DataFrame], layer: str, target: str, audit: Audit | None = None) -> DataFrame:
    """``replace_all``, with each table registered as ``layer.name`` on the new version's files.

    The views change after the version has become current, by statements that touch the catalog only.
    """
    counts = replace_all(frames, target, audit)
    spark = counts.sparkSession
    version = current_version(spark, target)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    for name in frames:
        spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{name}` AS SELECT * FROM parquet.`{target}/{version}/{name}`")
    return counts
