"""Shared plumbing of the corpus operators: table access, shipping code to workers, cutting lineage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_ROOT = str(Path(__file__).resolve().parents[2])
#: Bytes of a row group that saved() writes.
_GROUP = 2 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers that share this file system import the package; on other clusters ship it with --py-files."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *parts])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); a temporary one only where the setting is absent, as in tests."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="attestra-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh(names: tuple[str, ...], taken: list[str]) -> list[str]:
    """The names, each with as many underscores in front as it takes to clash with none that is taken."""
    lower, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in lower:
            name = "_" + name
        out.append(name)
        lower.add(name.lower())
    return out


def give_back() -> None:
    """Hand what this process has freed back to the system, as far as its allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """df.mapInArrow(run, schema); a worker, which later stages use again, keeps no free memory of a task that has ended."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    out = df.mapInArrow(lean, schema)
    out.__dict__["_mapped"] = df, run
    return out


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: later stages restart from files, not from lineage."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _plain_folder(spark: SparkSession, path: str) -> str | None:
    """The folder as Python's open() knows it; null if it lies in a store that only Spark reads."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    plain = found.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"
    return found.toUri().getPath() if plain else None


def _file(batches: Iterator[pa.RecordBatch], kind: pa.Schema, folder: str) -> Iterator[pa.RecordBatch]:
    """Write batches to one Parquet file whose name begins with an underscore, and give the rest of the name; no rows, no file."""
    name, writer, held = f"part-{uuid.uuid4().hex}.parquet", None, []

    def put() -> None:
        nonlocal writer
        writer = writer or pq.ParquetWriter(f"{folder}/_{name}", kind, use_dictionary=False)
        writer.write_table(pa.Table.from_batches(held).select(kind.names).cast(kind))
        held.clear()

    try:
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.nbytes for b in held) >= _GROUP:
                put()
        if held:
            put()
    finally:
        if writer:
            writer.close()
    if writer:
        yield pa.RecordBatch.from_pydict({"name": [name]})


def saved(df: DataFrame, tag: str) -> DataFrame:
    """cut(), but Python workers write the files where they can reach the shared folder; for longs, truth values, text, bytes and arrays of these.

    Hadoop's local file system starts a chmod for each file and folder it makes. Until such a process has become that
    program it shares its executor's memory, and who adds up the executor's processes counts a full heap twice. Workers
    start none. Readers pass over names with an underscore, so files of failed or repeated tasks, which the driver does
    not rename, are never read. The function of a mapped() frame runs in the worker that writes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    folder = _plain_folder(spark, path)
    if folder is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    os.makedirs(folder)
    kind = to_arrow_schema(df.schema._as_nullable())
    source, run = df.__dict__.get("_mapped", (df, iter))
    names = [r.name for r in mapped(source, lambda batches: _file(run(batches), kind, folder), "name string").collect()]
    for name in names:
        os.rename(f"{folder}/_{name}", f"{folder}/{name}")
    if not names:
        pq.write_table(kind.empty_table(), f"{folder}/part-none.parquet")
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files behind a frame made by cut() or saved(), once nothing reads it any more."""
    spark = df.sparkSession
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
