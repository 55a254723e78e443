"""Exact removal of long repeated byte strings, by suffix sorting of shards that cannot miss a pair.

Every window of `length` bytes has a least hash among the 32-byte strings in it, which follows from its bytes alone, so equal
windows have equal route values. A stretch of windows with one value is a run. Values that occur once in the whole table are
set aside; the bytes under the other runs go to the shard of their value, equal ones once with their count, and each shard
is sorted by suffixes (suffix.py): neighbours that share `length` bytes are repeats. Values with very many different runs
are first split by other hashes of the same windows and, if that does not help, by the windows themselves, so no shard has
an unbounded group. Spans go back to their texts by joins.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .suffix import repeated_starts

LENGTH, GRAM = 200, 32
#: Windows that are hashed at once, bytes that are sorted at once, different runs of one value above which it is split.
CHUNK, SHARD_BYTES, MANY = 1 << 17, 2 << 20, 4096
_BASE = 0x9E3779B97F4A7C15
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Multipliers of the hash families: the first for routing, the others for splitting.
_FAMILY = tuple(np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


@functools.lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = CHUNK + 4096
    up, down = (np.full(n, np.uint64(b)) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _gram_hashes(raw: np.ndarray, family: int) -> np.ndarray:
    """A 64-bit hash of each GRAM-byte string, from prefix sums of a polynomial modulo 2**64."""
    up, down = _powers()
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    x = (sums[GRAM:] - sums[:-GRAM]) * down[: len(raw) - GRAM + 1]
    x ^= x >> np.uint64(31)
    x *= _FAMILY[family]
    x ^= x >> np.uint64(29)
    return x


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row, from running minima within blocks in both directions."""
    n = len(x)
    block = np.full(-(-n // width) * width, _TOP)
    block[:n] = x
    block = block.reshape(-1, width)
    right = np.minimum.accumulate(block, axis=1).ravel()
    left = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(left[: n - width + 1], right[width - 1 : n])


def _chunks(raw: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    windows = len(raw) - length + 1
    for at in range(0, max(0, windows), CHUNK):
        yield at, raw[at : at + min(CHUNK, windows - at) + length - 1]


def route_values(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct route values of a text's windows, and at how many places (2: two or more) each is the least."""
    width = length - GRAM + 1
    found, times = [], []
    for _, part in _chunks(raw, length):
        x = _gram_hashes(part, 0)
        least = _least(x, width)
        pad = np.full(width - 1, _TOP)
        most = ~_least(np.concatenate([pad, ~least, pad]), width)
        values, counts = np.unique(x[x == most], return_counts=True)
        found.append(values)
        times.append(counts)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    values, at = np.unique(np.concatenate(found), return_inverse=True)
    return values, np.minimum(2, np.bincount(at, np.concatenate(times)).astype(np.int64))


def runs(raw: np.ndarray, length: int, family: int = 0) -> Iterator[tuple[int, int, int]]:
    """(value, first byte, end byte) of each stretch of windows with one value; a window by itself beyond the last family."""
    width = length - GRAM + 1
    for at, part in _chunks(raw, length):
        if family >= len(_FAMILY):
            for k in range(len(part) - length + 1):
                yield int.from_bytes(hashlib.blake2b(part[k : k + length].tobytes(), digest_size=8).digest(), "little"), at + k, at + k + length
            continue
        least = _least(_gram_hashes(part, family), width)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.concatenate([first[1:], [len(least)]]) - 1
        yield from zip(least[first].tolist(), (first + at).tolist(), (last + at + length).tolist(), strict=True)


def places(piece: np.ndarray, length: int, family: int) -> int:
    """At how many places a run has its least gram; a run that has it at one place cannot repeat a window of its own."""
    if len(piece) <= length:
        return 1
    x = _gram_hashes(piece, family)
    return int(np.count_nonzero(x == x.min()))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_RUNS = "route long, sid binary, bytes binary, key binary, start int"


class _RunRows:
    """Rows of runs; of equal bytes a task gives only the first. More columns of int64 may follow those of _RUNS."""

    def __init__(self, *more: str):
        self.rows, self.seen, self.more = [], set(), more

    def add(self, route: int, piece: bytes, key: bytes, start: int, *more: int) -> None:
        sid = hashlib.blake2b(piece, digest_size=16).digest()
        self.rows.append((route, sid, None if sid in self.seen else piece, key, start, *more))
        if len(self.seen) > 200_000:
            self.seen.clear()
        self.seen.add(sid)

    def batch(self) -> pa.RecordBatch:
        names = ["route", "sid", "bytes", "key", "start", *self.more]
        types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), *(pa.int64() for _ in self.more)]
        cols = list(zip(*self.rows, strict=True)) or [()] * len(names)
        self.rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)


def _runs_of(texts: DataFrame, length: int) -> DataFrame:
    """Runs of (key, text, values) whose value is among values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _RunRows()
        for batch in batches:
            for key, text, values in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                data, wanted = text.as_py().encode(), {x & (1 << 64) - 1 for x in values.as_py()}
                for value, first, end in runs(np.frombuffer(data, np.uint8), length):
                    if value in wanted:
                        out.add(_signed(value), data[first:end], key, first)
                if len(out.rows) > 5000:
                    yield out.batch()
            yield out.batch()

    return common.mapped(texts, run, _RUNS)


def _split_again(found: DataFrame, length: int, family: int) -> DataFrame:
    """The runs of found, split where another hash of their windows changes, and in `times` at how many places each has its least gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _RunRows("times")
        for batch in batches:
            for route, data, key, start in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                raw = np.frombuffer(data, np.uint8)
                for value, first, end in runs(raw, length, family):
                    mixed = ((route & (1 << 64) - 1) * _BASE ^ value) & (1 << 64) - 1
                    out.add(_signed(mixed), data[first:end], key, start + first, places(raw[first:end], length, family))
            yield out.batch()

    return common.mapped(found.select("route", "bytes", "key", "start"), run, _RUNS + ", times long")


def _sorted_shards(distinct: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """sid, spans (first and end byte, in turn) of distinct runs (route, sid, bytes, n)."""

    def flush(rows: list) -> pa.RecordBatch:
        spans = []
        for (_, _, data, n), starts in zip(rows, repeated_starts([r[2] for r in rows], length), strict=True):
            spans.append([0, len(data)] if n > 1 else cover(starts, length))
        return pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.binary()), pa.array(spans, pa.list_(pa.int32()))], ["sid", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= shard_bytes and row[0] != rows[-1][0]:
                    yield flush(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[2])
        if rows:
            yield flush(rows)

    return common.mapped(distinct.repartition("route").sortWithinPartitions("route").select("route", "sid", "bytes", "n"), run, "sid binary, spans array<int>")


def cover(starts: np.ndarray, length: int) -> list[int]:
    """First and end of each maximal stretch that windows from these places cover."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > length)
    first = np.concatenate([[starts[0]], starts[gap + 1]])
    end = np.concatenate([starts[gap], [starts[-1]]]) + length
    return np.stack([first, end], 1).ravel().tolist()


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((first, end))
    return out


def repeated_spans(docs: DataFrame, length: int = LENGTH, text_col: str = "text", id_col: str = "doc_id", shard_bytes: int = SHARD_BYTES, many: int = MANY) -> DataFrame:
    """key (SHA-256 of a text), copied, spans (first and end byte of maximal repeated stretches) of all texts that occur several
    times (copied) or have such stretches; a table in the shared folder with one row for each text.

    A text that occurs several times is repeated as a whole if it has `length` bytes.
    """
    if length <= GRAM:
        raise ValueError(f"length must be more than {GRAM}")
    common.ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, values, times = [], [], [], []
            for text in batch.column(1):
                data = text.as_py().encode()
                v, t = route_values(np.frombuffer(data, np.uint8), length)
                keys.append(hashlib.sha256(data).digest())
                sizes.append(len(data))
                values.append(v.view(np.int64))
                times.append(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(values, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))], ["doc_id", "key", "n_bytes", "vals", "times"])

    # Only what is read several times is written: each file of a task costs its executor a file's buffers and, in a local folder, processes.
    rows = common.mapped(docs, scan, "doc_id long, key binary, n_bytes long, vals array<long>, times array<long>")
    # One row of each text stands for all.
    texts = common.cut(rows.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"), F.first("vals").alias("vals"), F.first("times").alias("times")), "repeats-texts")
    values = texts.select("key", "doc_id", F.explode(F.arrays_zip("vals", "times")).alias("x")).select("key", "doc_id", F.col("x.vals").alias("v"), F.col("x.times").alias("t"))
    often = values.groupBy("v").agg(F.sum("t").alias("t")).where("t > 1").select("v")
    hits = values.join(often, "v").groupBy("key").agg(F.first("doc_id").alias("hit_id"), F.collect_list("v").alias("vals"))
    keyed = docs.withColumn("key", F.unhex(F.sha2("text", 256)))
    chosen = keyed.join(hits, "key").where(F.col("doc_id").eqNullSafe(F.col("hit_id"))).select("key", "text", "vals")
    found = common.cut(_runs_of(chosen, length), "repeats-runs")
    for family in range(1, len(_FAMILY) + 1):
        hot = common.cut(found.groupBy("route", "sid").count().groupBy("route").count().where(F.col("count") > many).select("route"), "repeats-hot")
        if hot.isEmpty():
            common.drop(hot)
            break
        whole = found.groupBy("sid").agg(F.max("bytes").alias("all_bytes"))
        far = found.join(hot, "route", "left_semi").drop("bytes").join(whole.withColumnRenamed("all_bytes", "bytes"), "sid")
        split = common.cut(_split_again(far, length, family), "repeats-split")
        # As with route values, a value counts by places: a single run that has its least gram twice may repeat itself.
        twice = split.groupBy("route").agg(F.sum("times").alias("times")).where("times > 1").select("route")
        old, found = found, common.cut(found.join(hot, "route", "left_anti").unionByName(split.drop("times").join(twice, "route", "left_semi")), "repeats-runs")
        for frame in (old, hot, split):
            common.drop(frame)
    distinct = found.groupBy("sid").agg(F.first("route").alias("route"), F.max("bytes").alias("bytes"), F.count("*").alias("n"))
    marked = _sorted_shards(distinct, length, shard_bytes).where(F.size("spans") > 0)
    once = texts.where("copies = 1").select("key")
    placed = found.select("sid", "key", "start").join(marked, "sid").select("key", F.transform("spans", lambda x: x + F.col("start")).alias("spans"))
    spans = placed.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans")).join(once, "key")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [[x for pair in merge(list(zip(s[::2], s[1::2], strict=True))) for x in pair] for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int32()))], ["key", "spans"])

    copied = texts.where("copies > 1").select("key", F.lit(True).alias("copied"), F.lit(None).cast("array<int>").alias("spans"))
    out = common.cut(copied.unionByName(common.mapped(spans, merged, "key binary, spans array<int>").select("key", F.lit(False).alias("copied"), "spans")), "repeats-fate")
    for frame in (texts, found):
        common.drop(frame)
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, text_col: str = "text", id_col: str = "doc_id", keep: bool = True, names: tuple[str, str, str] = ("n_bytes", "spans", "kept"), **options) -> DataFrame:
    """docs with the text's repeated bytes gone, and n_bytes, spans (removed stretches, first and end byte), kept (bytes).

    Every byte goes that a string of `length` bytes covers which also starts anywhere else in the table's texts, the same
    text included; strings are judged on the input and never cross texts. With keep all columns of docs stay, else only
    doc_id. A null text counts as empty; a null id is carried; repeated rows lose everything if they are long enough; an
    empty table gives no rows; the added columns have the given names, and are refused if docs has them already and all are
    kept; very long texts are hashed in chunks. What is left may begin or end within a character.
    """
    size_name, spans_name, kept_name = names
    if keep and (clash := set(names) & set(docs.columns)):
        raise ValueError(f"columns {sorted(clash)} exist already")
    fate = repeated_spans(docs, length, text_col, id_col, **options)
    text_name, key_name = common.fresh(("__text", "__key"), [*docs.columns, *names])
    text = F.coalesce(F.col(text_col), F.lit(""))
    full = docs.select(*([F.col(c) for c in docs.columns] if keep else [F.col(id_col).cast("long").alias("doc_id")]), text.alias(text_name), F.unhex(F.sha2(text, 256)).alias(key_name))
    # One join of two written tables: a text with very many copies is a skewed key that adaptive execution can split.
    told = fate.select(F.col("key").alias(key_name), F.struct("copied", "spans").alias(spans_name))
    joined = full.join(told, key_name, "left")
    size, found = F.octet_length(text_name), F.col(spans_name)
    gone = F.when(found["copied"] & (size >= length), F.array(F.lit(0), size)).otherwise(F.coalesce(found["spans"], F.array().cast("array<int>")))
    whole = F.encode(text_name, "UTF-8")
    # What is kept lies between the end of one stretch and the beginning of the next.
    first, end = F.filter(spans_name, lambda x, k: k % 2 == 0), F.filter(spans_name, lambda x, k: k % 2 == 1)
    pieces = F.zip_with(F.concat(F.array(F.lit(0)), end), F.concat(first, F.array(size)), lambda a, b: F.hex(F.substring(whole, a + 1, b - a)))
    out = joined.withColumn(size_name, size.cast("long")).withColumn(spans_name, gone)
    out = out.withColumn(kept_name, F.when(F.size(spans_name) == 0, whole).otherwise(F.unhex(F.array_join(pieces, ""))))
    return out.select(*(docs.columns if keep else ["doc_id"]), *names)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(common.table(spark, sf_dir, "documents"), keep=False)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.floor(F.size("spans") / 2).alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
