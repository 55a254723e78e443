"""Byte-pair encoding by backtracking, and decoding through an offset table.

A word's tokens are found from left to right: an Aho-Corasick automaton over all token bytes gives the longest token at each
place; it is accepted if the pair with the token before it is compatible, that is if merging by rank would never join bytes
across their border. Otherwise the next shorter token is tried, and if none is left the last token is taken back. Places
found hopeless are marked, so each is visited once and the whole takes linear time.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

#: Words and token pairs remembered by a worker; when full, they are forgotten and gathered anew.
WORDS, PAIRS = 600_000, 1_000_000


class Encoder:
    def __init__(self, path: str):
        vocab = tokens.vocabulary(path)
        self.special = vocab.special
        self._split_special = regex.compile("|".join(map(regex.escape, sorted(vocab.special, key=len, reverse=True)))) if vocab.special else None
        self._words = regex.compile(tokens.PATTERN)
        self.size = 1 + max([*vocab.by_id, *vocab.special.values()])
        self._bytes = [vocab.by_id.get(i, b"") for i in range(self.size)]
        for text, i in vocab.special.items():
            self._bytes[i] = text.encode()
        self._length = [len(b) for b in self._bytes]
        self._by_bytes = {b.decode("latin-1"): i for b, i in vocab.ids.items()}
        self._trie = ahocorasick.Automaton()
        for b, i in self._by_bytes.items():
            self._trie.add_word(b, i)
        self._trie.make_automaton()
        self._pair = {(a, b): c for a, b, c in vocab.merges}
        self._parts = {}
        for a, b, c in vocab.merges:
            self._parts.setdefault(c, (a, b))
        # The longest token that is a proper prefix of each token.
        self._shorter = [-1] * self.size
        for b, i in self._by_bytes.items():
            for n in range(len(b) - 1, 0, -1):
                if (k := self._by_bytes.get(b[:n])) is not None:
                    self._shorter[i] = k
                    break
        self._compatible: dict[int, bool] = {}
        self._known: dict[str, bytes] = {}
        # Decoding: all tokens' bytes in a row, and where each begins.
        self._blob = np.frombuffer(b"".join(self._bytes), np.uint8)
        self._begin = np.concatenate([[0], np.cumsum(self._length)]).astype(np.int64)
        self._decimal = [str(i) for i in range(self.size)]

    def _can_follow(self, left: int, right: int) -> bool:
        """Whether the bytes of both, encoded together, stay these two tokens.

        Walks the border's merges from the latest back: at each step the two tokens that meet there might have been joined,
        which happens if that merge ranks before the one undone last. A later merge is undone first; on equal ranks the left
        one was made first, so the right one is undone.
        """
        parts, limit, a, b = self._parts, self.size, left, right
        while True:
            joined = self._pair.get((a, b))
            if joined is not None and joined < limit:
                return False
            in_a, in_b = parts.get(a), parts.get(b)
            if in_a and (a > b or not in_b):
                limit, a = a, in_a[1]
            elif in_b:
                limit, b = b + 1, in_b[0]
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        key = left * self.size + right
        found = self._compatible.get(key)
        if found is None:
            if len(self._compatible) >= PAIRS:
                self._compatible.clear()
            found = self._compatible[key] = self._can_follow(left, right)
        return found

    def encode_word(self, word: bytes) -> list[int]:
        text = word.decode("latin-1")
        whole = self._by_bytes.get(text)
        if whole is not None:
            return [whole]
        n, at, out = len(text), 0, []
        known, size, length, shorter = self._compatible, self.size, self._length, self._shorter
        # The longest tokens in a row, as far as they are compatible.
        for _, token in self._trie.iter_long(text):
            if out and not ((found := known.get(out[-1] * size + token)) or found is None and self.compatible(out[-1], token)):
                break
            out.append(token)
            at += length[token]
        else:
            return out
        hopeless = bytearray(n + 1)
        longest = lambda p: next(self._trie.iter_long(text, p))[1]
        while True:
            end = at + length[token]
            if not hopeless[end] and (not out or (found := known.get(out[-1] * size + token)) or found is None and self.compatible(out[-1], token)):
                out.append(token)
                at = end
                if at == n:
                    return out
                token = longest(at)
                continue
            token = shorter[token]
            while token < 0:
                hopeless[at] = 1
                last = out.pop()
                at -= length[last]
                token = shorter[last]

    def _missing(self, word: str) -> bytes:
        ids = array("I", self.encode_word(word.encode())).tobytes()
        if len(word) <= 64:
            if len(self._known) >= WORDS:
                self._known.clear()
            self._known[word] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        get, missing = self._known.get, self._missing
        return b"".join([get(w) or missing(w) for w in self._words.findall(text)])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; special tokens in it are recognised first, as the tokenizers library does."""
        parts, at = [], 0
        if self._split_special and any(s in text for s in self.special):
            for m in self._split_special.finditer(text):
                parts += [self._plain(text[at : m.start()]), np.array([self.special[m[0]]], "<u4").tobytes()]
                at = m.end()
        parts.append(self._plain(text[at:] if at else text))
        return np.frombuffer(b"".join(parts), "<u4")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids: each token's place in the table is repeated over its length and counted up."""
        if not len(ids):
            return b""
        ids = ids.astype(np.int64)
        begin = self._begin[ids]
        size = self._begin[ids + 1] - begin
        ends = np.cumsum(size)
        where = np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)
        return self._blob[where].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")

    def decimal(self, ids: np.ndarray) -> str:
        return ",".join(map(self._decimal.__getitem__, ids.tolist()))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int> of every row's whole text.

    A null text counts as empty and gives an empty array, a null id is carried, repeated rows give equal arrays, an empty
    table gives no rows, other columns are ignored.
    """
    return _run(docs, vocabulary, id_col, text_col, "doc_id long, ids array<int>", lambda e, ids: (ids,), (pa.list_(pa.int32()),))


def decode(coded: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of every row's ids; null ids give an empty text. An id outside the vocabulary raises."""
    common.ship(coded.sparkSession)
    path = vocabulary or tokens.default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            texts = [e.decode(np.array(x.as_py() or [], np.int64)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes and decodes in one pass, for texts whose ids need not be kept."""

    def row(e: Encoder, ids: np.ndarray) -> tuple:
        return len(ids), hashlib.sha256(e.decimal(ids).encode()).hexdigest(), hashlib.sha256(e.decode(ids).encode()).hexdigest()

    return _run(docs, vocabulary, id_col, text_col, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", row, (pa.int64(), pa.string(), pa.string()))


def _run(docs, vocabulary, id_col, text_col, schema, row, types) -> DataFrame:
    common.ship(docs.sparkSession)
    path = vocabulary or tokens.default_vocabulary()
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            rows = [row(e, e.encode(x.as_py() or "")) for x in batch.column(1)]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(common.table(spark, sf_dir, "documents"))
