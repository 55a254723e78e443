"""Byte-level BPE vocabulary access shared by the BPE and packing operators."""

from __future__ import annotations

import functools
import json

#: The split pattern of byte-level BPE tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_vocabulary() -> str:
    """Path of the public 50k byte-level BPE vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache
def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        symbols[chr(256 + n)] = b
    return symbols


class Vocabulary:
    """Token bytes, merge ranks and special tokens of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        raw = lambda piece: bytes(symbols[c] for c in piece)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.by_id = {i: raw(p) for p, i in spec["model"]["vocab"].items() if p not in self.special}
        self.ids = {b: i for i, b in self.by_id.items()}
        self.merges = []
        for m in spec["model"]["merges"]:
            left, right = m.split(" ") if isinstance(m, str) else m
            self.merges.append((self.ids[raw(left)], self.ids[raw(right)], self.ids[raw(left + right)]))


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


#: Texts from this length on are searched for runs of white space of at least the second number of characters.
LONG_TEXT, LONG_RUN = 100_000, 1_000


def cut_at_runs(text: str, special: list[str]) -> list[tuple[bool, str]]:
    """Parts of a text that are encoded apart, and whether a part is one word: long runs of white space are.

    The pattern's look-ahead goes back over a run a character at a time, more than its stack holds for very long ones. By its
    own rule such a run is one word, at the end of a text or before a special token whole, else without its last character.
    """
    import regex

    names = "|".join(map(regex.escape, sorted(special, key=len, reverse=True)))
    parts, at = [], 0
    for m in regex.finditer(rf"\s{{{LONG_RUN},}}", text):
        ends = m.end() == len(text) or bool(names and regex.match(names, text[m.end() : m.end() + 256]))
        stop = m.end() if ends else m.end() - 1
        parts += [(False, text[at : m.start()]), (True, text[m.start() : stop])]
        at = stop
    return [(whole, part) for whole, part in [*parts, (False, text[at:])] if part]


@functools.lru_cache(maxsize=4)
def fast_encoder(path: str):
    """text -> numpy ids, equal to the tokenizers library's encode(text, add_special_tokens=False) for this file."""
    import numpy as np
    import tiktoken

    vocab = vocabulary(path)
    enc = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=vocab.ids, special_tokens=vocab.special)

    def plain(text: str) -> np.ndarray:
        return np.asarray(enc.encode_to_numpy(text, allowed_special="all"), np.uint32)

    def encode(text: str) -> np.ndarray:
        if len(text) < LONG_TEXT:
            return plain(text)
        parts = [np.asarray(enc._encode_single_piece(part), np.uint32) if whole else plain(part) for whole, part in cut_at_runs(text, list(vocab.special))]
        return np.concatenate(parts) if parts else plain("")

    return encode
