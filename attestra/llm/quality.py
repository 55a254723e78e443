"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

Features are single words and word pairs, both as they stand and as shapes (letters by case, digits and runs folded, marks
kept), hashed into a fixed number of weights. Within a family every n-gram of a text weighs the same and all add up to 1, so
a score is a sparse dot product that needs one look-up for each n-gram. Two more features tell, in tenths, how many word
pairs and how many lines of a text are repeats.

Training takes a bounded sample of labelled rows (TRAIN_ROWS, chosen by a hash of their ids), one task learns from it, and
the weights, whose size is fixed, go to all workers. Scoring covers every row and shuffles nothing.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

BITS, TRAIN_ROWS, EPOCHS = 20, 4096, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0005, 0.01
#: Words remembered by a worker during a task; ten thousand documents have half a million, most of them once.
WORDS = 100_000
_MASK = np.uint64((1 << BITS) - 1)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_FAMILIES = ("word", "pair", "shape", "shape pair", "repeats")
_RUN = re.compile(r"(.)\1+")


class _Signs(dict):
    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = sign = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        return sign


_SIGNS = _Signs()


def shape(word: str) -> str:
    """Letters become a or A, digits 0, and runs of one sign one sign: 'Thnd***' is 'Aa*'."""
    return _RUN.sub(r"\1", word.translate(_SIGNS))


class _Words(dict):
    """word -> its hash and its shape's hash in one integer."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS:
            self.clear()
        x = (zlib.crc32(word.encode()) >> 1) << 32 | zlib.crc32(shape(word).encode())
        self[word] = x
        return x


@functools.lru_cache(maxsize=1)
def _words() -> _Words:
    return _Words()


def _spread(x: np.ndarray, family: int) -> np.ndarray:
    x = (x + np.uint64(family)) * _A
    x ^= x >> np.uint64(29)
    return ((x * _B) >> np.uint64(40) & _MASK).astype(np.int64)


def features(text: str) -> list[np.ndarray]:
    """The weights' indexes of a text by family, one for each n-gram; none for a text without words."""
    words = text.split()
    if not words:
        return []
    both = np.fromiter(map(_words().__getitem__, words), np.int64, len(words)).view(np.uint64)
    word, form = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    out = [_spread(word, 1), _spread(form, 3)]
    share = 0
    if len(words) > 1:
        pairs = word[:-1] * _C + word[1:]
        out += [_spread(pairs, 2), _spread(form[:-1] * _C + form[1:], 4)]
        share = 10 - 10 * len(np.unique(pairs)) // len(pairs)
    lines = [x for x in text.split("\n") if x.strip()]
    repeated = 10 - 10 * len(set(lines)) // len(lines)
    out.append(_spread(np.array([share, 100 + repeated, 200 + min(20, int(math.log2(len(words))))], np.uint64), 5))
    return out


def raw_score(text: str, weights: np.ndarray, bias: float) -> float:
    total = bias
    for idx in features(text):
        total += float(weights[idx].mean(dtype=np.float64))
    return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, total))))


def train(examples: Iterable[tuple[str, int]], bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """FTRL-proximal weights and bias; all zero without examples."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rows = []
    for text, label in examples:
        idx = [np.array([size])]
        val = [np.ones(1)]
        for f in features(text):
            u, c = np.unique(f, return_counts=True)
            idx.append(u)
            val.append(c / len(f))
        i, v = np.concatenate(idx), np.concatenate(val)
        u, at = np.unique(i, return_inverse=True)
        rows.append((u.astype(np.int32), np.bincount(at, v).astype(np.float32), label))
    l1 = np.full(size + 1, L1)
    l1[size] = 0.0

    def weight(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= l1[i], 0.0, -(zi - np.sign(zi) * l1[i]) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(epochs):
        for i, v, y in rows:
            w = weight(i)
            p = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, float(w @ v)))))
            g = (p - y) * v
            grown = n[i] + g * g
            z[i] += g - (np.sqrt(grown) - np.sqrt(n[i])) / ALPHA * w
            n[i] = grown
    every = weight(np.arange(size + 1))
    return every[:size].astype(np.float32), float(every[size])


def fold(id_: Column) -> Column:
    """crc32 of the id as text, modulo 3; rows where it is 1 are held out of training."""
    return F.crc32(id_.cast("string").cast("binary")) % 3


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> tuple[bytes, float]:
    """Weights and bias learned from at most `rows` labelled rows outside the held-out third.

    Ids with a null or contradictory label are left out; an id that several rows have gives as many examples, but there are
    never more than `rows` in all; very long texts are taken whole; without any example the weights are zero and every score
    is 0.5.
    """
    common.ship(docs.sparkSession)
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)").where(fold(F.col("id")) != 1)
    known = known.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").select("id", "y")
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(rows)
    sample = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    keyed = sample.select("y", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("id", "text").alias("k"))
    # Ids are bounded, their rows are not: each partition keeps no more than `rows` before all go to one task.
    ordered = keyed.orderBy("k", "text", "y").limit(rows).repartition(1).sortWithinPartitions("k", "text", "y")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = train((text.as_py(), label.as_py()) for batch in batches for text, label in zip(batch.column(1), batch.column(0), strict=True))
        _words().clear()
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(weights.tobytes())], pa.binary()), pa.array([bias], pa.float64())], ["weights", "bias"])

    found = common.mapped(ordered, learn, "weights binary, bias double").collect()
    if not found:
        return zlib.compress(np.zeros(1 << BITS, np.float32).tobytes()), 0.0
    return bytes(found[0]["weights"]), found[0]["bias"]


def score(docs: DataFrame, model: tuple[bytes, float], id_col: str = "doc_id", text_col: str = "text", keep: bool = False, name: str = "score") -> DataFrame:
    """doc_id, score of every row; with keep, all columns of docs and then the score, under the given name.

    A null or empty text, or one without words, gets the score of the bias alone; a null id is carried, repeated rows get
    equal scores, very long texts are scored whole, an empty table gives no rows; a column that has the score's name already is refused where all are kept.
    """
    common.ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    if keep and name in docs.columns:
        raise ValueError(f"column {name} exists already")
    chosen = docs if keep else docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    at = chosen.columns.index(text_col if keep else "text")
    names = [*(chosen.columns if keep else chosen.columns[:1]), name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, bias = sent.value
        weights = np.frombuffer(zlib.decompress(packed), np.float32)
        for batch in batches:
            scores = pa.array([raw_score(x.as_py() or "", weights, bias) for x in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.columns if keep else batch.columns[:1]), scores], names)
        _words().clear()

    return common.mapped(chosen, run, T.StructType([*(list(chosen.schema.fields) if keep else [T.StructField("doc_id", T.LongType())]), T.StructField(name, T.DoubleType())]))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    scored = score(docs, fit(docs, labels))
    held = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
