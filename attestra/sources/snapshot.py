"""Snapshots of a base: a folder of Parquet tables for each load, and numbered manifests of which the highest is current."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from .schema import TABLES, VERSION, conform, empty_base

#: Fixed value: the first version that is brought up to date; bases before it have no meta table and are begun anew.
FIRST = 2


class SnapshotError(ValueError):
    pass


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, p = _fs(spark, f"{root}/manifest-*.json")
    return sorted(int(f.getPath().getName()[len("manifest-") : -len(".json")]) for f in fs.globStatus(p) or [])


def manifest(spark: SparkSession, root: str) -> dict | None:
    """The manifest with the highest number; each is complete from the moment it has its name, and none is ever replaced."""
    numbers = _numbers(spark, root)
    return json.loads("\n".join(r[0] for r in spark.read.text(f"{root}/manifest-{numbers[-1]:09d}.json").collect())) if numbers else None


def write(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> str:
    """Write all tables in a new folder, then a manifest with the next number; readers see the old or the new, never a mixture.

    A writer that fails leaves files that no manifest names; of two writers at once one fails and changes nothing.
    """
    name = uuid.uuid4().hex
    before, last = manifest(spark, root), (_numbers(spark, root) or [0])[-1]
    for table, df in tables.items():
        conform(df, table).write.parquet(f"{root}/{name}/{table}")
    text = json.dumps({"version": VERSION, "current": name, "previous": before and before["current"], "tables": sorted(tables)})
    fs, temp = _fs(spark, f"{root}/{name}/manifest")
    out = fs.create(temp, True)
    out.write(bytearray(text.encode()))
    out.close()
    _, final = _fs(spark, f"{root}/manifest-{last + 1:09d}.json")
    if fs.exists(final) or not fs.rename(temp, final):
        raise SnapshotError("another load has been stored meanwhile")
    return name


def read(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The current tables; those of an older version get the columns they lack, a newer version is refused."""
    m = manifest(spark, root)
    if m is None:
        raise SnapshotError(f"no snapshot in {root}")
    if m["version"] > VERSION:
        raise SnapshotError(f"the snapshot has version {m['version']}, this program knows {VERSION}")
    return {t: conform(spark.read.parquet(f"{root}/{m['current']}/{t}"), t) if t in m["tables"] else spark.createDataFrame([], TABLES[t]) for t in TABLES}


def open_base(spark: SparkSession, root: str, rebuild: bool = False) -> tuple[dict[str, DataFrame], str | None]:
    """The tables that a load begins with, and the folder that is kept as a backup if it begins anew.

    Nothing there: empty tables. A base from version FIRST on is read with the columns and tables it lacks; decisions stay.
    An older one, or any with rebuild, is kept as it is under its own manifest while the load begins with empty tables. A
    newer one is refused, unless it is to be rebuilt.
    """
    m = manifest(spark, root)
    if m is None:
        return empty_base(spark), None
    if rebuild or m["version"] < FIRST:
        return empty_base(spark), m["current"]
    return read(spark, root), None
