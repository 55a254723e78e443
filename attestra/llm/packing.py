"""Vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens.

Each partition packs its own rows as a stream, so nothing is shuffled or collected and memory is one window of open items.
An item is what is left of an example once whole sequences are cut from it; its size is the vector (tokens, segments, loss
tokens). The open sequence takes the fitting item with the largest dot product between item and remaining capacity; if none
fits, the largest item is cut to fill it. What remains at a partition's end is split at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

MAX_TOKENS, MAX_SEGMENTS, WINDOW = 1024, 256, 256


class Packer:
    """Packs items (owner, ids, prompt length) into sequences; calls emit(owner, start, ids, sequence, offset) for each piece."""

    def __init__(self, emit: Callable, first_sequence: int, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None, window: int = WINDOW):
        if min(max_tokens, max_segments, max_loss or 1, window) < 1:
            raise ValueError("limits must be positive")
        self.emit, self.sequence, self.window = emit, first_sequence, window
        self.capacity = np.array([max_tokens, max_segments, max_loss or max_tokens], np.int64)
        self.weight = 1.0 / self.capacity.astype(float) ** 2
        self.sizes = np.zeros((window + 1, 3), np.int64)
        self.items: list[tuple] = []

    def _size(self, start: int, end: int, prompt: int) -> tuple[int, int, int]:
        return end - start, 1, max(0, end - max(start, prompt))

    def _most(self, start: int, end: int, prompt: int, room: np.ndarray) -> int:
        """How far from start a piece may reach with this room for tokens and loss tokens."""
        return min(end, start + int(room[0]), max(start, prompt) + int(room[2]))

    def add(self, owner, ids: np.ndarray, prompt: int = 0) -> None:
        start, n = 0, len(ids)
        while (reach := self._most(start, n, prompt, self.capacity)) < n:  # whole sequences at once
            self.emit(owner, start, ids[start:reach], self.sequence, 0)
            self.sequence += 1
            start = reach
        if n:
            self._keep(owner, ids, start, prompt)
            if len(self.items) >= self.window:
                self._fill()

    def _keep(self, owner, ids, start: int, prompt: int) -> None:
        self.sizes[len(self.items)] = self._size(start, len(ids), prompt)
        self.items.append((owner, ids, start, prompt))

    def _take(self, k: int) -> tuple:
        item, last = self.items[k], len(self.items) - 1
        self.items[k], self.sizes[k] = self.items[last], self.sizes[last]
        self.items.pop()
        return item

    def _fill(self) -> None:
        """Close one sequence."""
        room, offset = self.capacity.copy(), 0
        while self.items and room.min() > 0:
            sizes = self.sizes[: len(self.items)]
            score = np.where((sizes <= room).all(axis=1), sizes @ (room * self.weight), -1.0)
            k = int(score.argmax())
            if score[k] >= 0:
                owner, ids, start, prompt = self._take(k)
                end = len(ids)
            else:
                owner, ids, start, prompt = self._take(int(sizes[:, 0].argmax()))
                end = self._most(start, len(ids), prompt, room)
                if end == start:
                    self._keep(owner, ids, start, prompt)
                    break
                self._keep(owner, ids, end, prompt)
            self.emit(owner, start, ids[start:end], self.sequence, offset)
            offset += end - start
            room = room - self._size(start, end, prompt)
        self.sequence += 1

    def finish(self) -> None:
        while self.sizes[: len(self.items), 0].sum() >= self.capacity[0]:
            self._fill()
        while self.items:  # sequences whose lengths are powers of two
            full, left = self.capacity.copy(), int(self.sizes[: len(self.items), 0].sum())
            self.capacity[0] = min(full[0], 1 << (left.bit_length() - 1))
            self._fill()
            self.capacity = full


def _pieces(batches: Iterator[pa.RecordBatch], encode_path: str, end_id: int | None, limits: dict, keep_ids: bool, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    encode, out = tokens.fast_encoder(encode_path), []

    def emit(owner, start, ids, sequence, offset):
        doc, total = owner
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, offset, ids))

    def flush():
        cols = list(zip(*out, strict=True)) if out else [()] * 8
        arrays = [pa.array(cols[0], id_type), *(pa.array(np.array(c, np.int64)) for c in cols[1:7])]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if keep_ids:
            flat = np.concatenate(cols[7]).view(np.int32) if cols[7] else np.zeros(0, np.int32)
            arrays.append(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in cols[7]])]).astype(np.int32), pa.array(flat)))
            names.append("ids")
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, names)

    packer = Packer(emit, TaskContext.get().partitionId() << 40, **limits)
    tail = np.array([] if end_id is None else [end_id], "<u4")
    for batch in batches:
        prompts = batch.column(2).to_pylist() if batch.num_columns > 2 else [0] * batch.num_rows
        for doc, text, prompt in zip(batch.column(0).to_pylist(), batch.column(1), prompts, strict=True):
            ids = np.concatenate([encode(text.as_py() or ""), tail]).astype("<u4", copy=False)
            packer.add((doc, len(ids)), ids, prompt or 0)
            if len(out) >= 20_000:
                yield flush()
        yield flush()
    packer.finish()
    yield flush()


def pack(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None, end_id: int | None = 0, keep_ids: bool = True, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None) -> DataFrame:
    """Pack every row's tokens into sequences; one output row per piece.

    A null text counts as empty (only its end token is packed), a null id is carried along, repeated rows are packed once
    each, an empty table gives no rows, other columns are ignored. prompt_col counts an example's leading tokens that bear
    no loss; with max_loss they let instruction data be limited by loss-bearing tokens too. Very long texts are cut into
    whole sequences first, runs of white space of any length included. Of items with equal dot products the first in the
    window goes first. Sequence ids are unique, not consecutive.
    """
    common.ship(docs.sparkSession)
    path = vocabulary or tokens.default_vocabulary()
    limits = {"max_tokens": max_tokens, "max_segments": max_segments, "max_loss": max_loss}
    cols = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *([F.col(prompt_col).cast("int").alias("prompt")] if prompt_col else [])]
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * keep_ids
    return common.mapped(docs.select(*cols), lambda it: _pieces(it, path, end_id, limits, keep_ids, pa.int64()), schema)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"), keep_ids=False)


def pack_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of all conversations packed as instruction data: only the assistant's tokens bear loss, half a sequence at most.

    A turn is an example of its own, so a conversation of any length is never gathered. doc_id is the conversation's id
    times 2 ** 20 plus the turn.
    """
    turns = common.table(spark, sf_dir, "conversations")
    prompt = F.when(F.col("role") == "assistant", F.lit(0)).otherwise(F.lit((1 << 31) - 1))
    named = turns.select((F.col("conv_id") * (1 << 20) + F.col("turn")).alias("doc_id"), "text", prompt.alias("prompt"))
    return pack(named, prompt_col="prompt", keep_ids=False, max_loss=MAX_TOKENS // 2)
