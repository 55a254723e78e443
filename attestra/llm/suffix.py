"""Suffix sorting of one shard by induced sorting, with common-prefix lengths carried along.

The text is a row of byte strings, each closed by a separator that is less than any byte. Left-most S suffixes are sorted by
naming the substrings between them and doubling the names; all others are induced from these: one pass upwards places the L
suffixes, one pass downwards the S suffixes. Both passes work bucket by bucket: a queue, which moves to disk when it grows,
holds for each first byte the suffixes induced so far and the prefix each shares with the one before it, which is one more
than the least such length between their sources. Only prefixes up to CAP bytes are told apart.
"""

from __future__ import annotations

import tempfile

import numpy as np

CAP = 255
#: Bytes that a queue keeps in memory.
QUEUE_BYTES = 64 << 20


class BucketQueue:
    """A priority queue over bytes: takes batches for many bytes at once, gives all entries of one byte in the order they came."""

    def __init__(self, limit: int = QUEUE_BYTES):
        self._kept: dict[int, list[np.ndarray]] = {}
        self._stored: dict[int, list[tuple[int, int]]] = {}
        self._limit, self._size, self._file = limit, 0, None

    def push(self, chars: np.ndarray, pos: np.ndarray, lcp: np.ndarray) -> None:
        """Entries sorted by char; entries of one char stay in order."""
        both = np.empty(len(pos), [("pos", np.int32), ("lcp", np.uint8)])
        both["pos"], both["lcp"] = pos, lcp
        cuts = np.flatnonzero(np.diff(chars)) + 1
        for part, c in zip(np.split(both, cuts), chars[np.concatenate([[0], cuts])].tolist(), strict=True):
            self._kept.setdefault(c, []).append(part)
        self._size += both.nbytes
        if self._size > self._limit:
            self._spill()

    def _spill(self) -> None:
        self._file = self._file or tempfile.TemporaryFile()
        self._file.seek(0, 2)
        for c, parts in self._kept.items():
            run = np.concatenate(parts)
            self._stored.setdefault(c, []).append((self._file.tell(), len(run)))
            self._file.write(run.tobytes())
        self._kept.clear()
        self._size = 0

    def pop(self, char: int) -> tuple[np.ndarray, np.ndarray]:
        dtype = np.dtype([("pos", np.int32), ("lcp", np.uint8)])
        parts = []
        for at, n in self._stored.pop(char, ()):
            self._file.seek(at)
            parts.append(np.frombuffer(self._file.read(n * dtype.itemsize), dtype))
        for p in self._kept.pop(char, ()):
            self._size -= p.nbytes
            parts.append(p)
        run = np.concatenate(parts) if parts else np.empty(0, dtype)
        return run["pos"].astype(np.int64), run["lcp"].copy()

    def close(self) -> None:
        if self._file:
            self._file.close()


class _Pass:
    """One inducing pass over sorted sources: who comes before them, in which bucket, sharing how much with the one before."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray):
        self.text, self.wanted, self.queue = text, wanted, BucketQueue()
        self.since = np.full(257, CAP, np.uint8)  # the least prefix between sources since the last that went to a bucket
        self.begun = np.zeros(257, bool)

    def feed(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        """lcp[0] refers to the source fed last before these."""
        if not len(pos):
            return
        at = np.flatnonzero((pos > 0) & self.wanted[pos - 1])
        least = lcp.min()
        if not len(at):
            np.minimum(self.since, least, out=self.since)
            return
        char = self.text[pos[at] - 1]
        order = np.argsort(char, kind="stable")
        at, char = at[order], char[order]
        first = np.concatenate([[True], char[1:] != char[:-1]])
        low = np.where(first, 0, np.concatenate([[0], at[:-1] + 1]))
        padded = np.append(lcp, np.uint8(CAP))
        mins = np.minimum.reduceat(padded, np.stack([low, at + 1], 1).ravel())[::2]
        heads = char[first]
        mins[first] = np.minimum(mins[first], self.since[heads])
        shared = np.minimum(mins, CAP - 1) + np.uint8(1)
        shared[np.flatnonzero(first)[~self.begun[heads]]] = 0
        self.begun[heads] = True
        np.minimum(self.since, least, out=self.since)
        last = at[np.concatenate([first[1:], [True]])] + 1
        rest = np.minimum.reduceat(padded, np.stack([last, np.full(len(last), len(lcp))], 1).ravel())[::2]
        self.since[heads] = np.where(last < len(lcp), rest, CAP)
        self.queue.push(char, pos[at] - 1, shared)

    def bucket(self, char: int) -> tuple[np.ndarray, np.ndarray]:
        """All of a bucket's induced suffixes, those that they induce in their own bucket included."""
        found = []
        while len((x := self.queue.pop(char))[0]):
            found.append(x)
            self.feed(*x)
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.uint8)
        return np.concatenate([p for p, _ in found]), np.concatenate([v for _, v in found])


def _words(buffer: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes from each place on, as one number each, without a copy."""
    return np.ndarray((n,), "<u8", buffer, strides=(1,))


def shared_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Common prefix lengths, up to CAP, of suffixes at a and b; ends: the places of the separators."""
    room = np.minimum(ends[np.searchsorted(ends, a)] - a, ends[np.searchsorted(ends, b)] - b)
    word = _words(np.concatenate([text, np.zeros(CAP + 16, np.uint8)]), len(text) + CAP + 8)
    out = np.full(len(a), CAP, np.int64)
    open_ = np.arange(len(a))
    for at in range(0, CAP, 8):
        x = word[a[open_] + at] ^ word[b[open_] + at]
        differ = x != 0
        y = x[differ]
        y &= ~y + np.uint64(1)
        out[open_[differ]] = at + (np.frexp(y.astype(np.float64))[1] - 1) // 8
        open_ = open_[~differ & (at + 8 < room[open_])]
        if not len(open_):
            break
    return np.minimum(np.minimum(out, room), CAP).astype(np.uint8)


def _sort_seeds(text: np.ndarray, is_s: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The left-most S places in the order of their suffixes, told apart by at least CAP bytes."""
    m = len(seeds)
    size = np.append(np.diff(seeds), 0) + 1
    ends = text[seeds] == 0
    rank = np.zeros(m, np.int64)
    code = (text.astype(np.uint16) << 1 | is_s) + 1
    for word in range(-(-int(size.max()) // 7)):
        sub = np.flatnonzero(size > 7 * word)
        key = np.zeros(len(sub), np.uint64)
        for k in range(7):
            inside = size[sub] > 7 * word + k
            value = np.where(inside, code[np.minimum(seeds[sub] + 7 * word + k, len(text) - 1)], 0)
            key = key << np.uint64(9) | value.astype(np.uint64)
        _, dense = np.unique(key, return_inverse=True)
        fine = np.zeros(m, np.int64)
        fine[sub] = dense
        _, rank = np.unique(rank * (len(sub) + 1) + fine, return_inverse=True)
    # From here on a rank is the first place of its group in the order; separators differ by place.
    order = np.lexsort((np.where(ends, seeds, 0), rank))
    differs = np.concatenate([[True], (rank[order][1:] != rank[order][:-1]) | ends[order][1:]])
    place = np.maximum.accumulate(np.where(differs, np.arange(m), 0))
    rank[order] = place
    step = 1
    while step <= CAP // 2 + 1:
        group = np.bincount(rank, minlength=m)
        sub = np.flatnonzero(group[rank] > 1)
        if not len(sub):
            break
        then = np.where(sub + step < m, rank[np.minimum(sub + step, m - 1)] + 1, 0)
        key = rank[sub] * (m + 1) + then
        order = np.argsort(key, kind="stable")
        sub, key = sub[order], key[order]
        head = rank[sub]
        new_head = np.concatenate([[True], head[1:] != head[:-1]])
        index = np.arange(len(sub)) - np.maximum.accumulate(np.where(new_head, np.arange(len(sub)), 0))
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        lead = np.maximum.accumulate(np.where(new_key, np.arange(len(sub)), 0))
        rank[sub] = head + index[lead]
        step *= 2
    return seeds[np.argsort(rank, kind="stable")]


def _s_types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are less than the next one, and the separators; what this takes is free again when the sort begins."""
    n = len(text)
    is_s = text == 0
    if n > 1:
        there = np.arange(n - 1, dtype=np.int32)  # as in the queues, places are below 2**31
        there[text[1:] == text[:-1]] = n - 2
        back = there[::-1]
        np.minimum.accumulate(back, out=back)
        is_s[:-1] |= (text[1:] > text[:-1])[there]
    return is_s


def sorted_suffixes(text: np.ndarray):
    """Yields (places, prefixes) by bucket: suffixes in order, and what each shares with the one before it; the buckets' order is not fixed.

    text: uint8, strings of bytes 1 to 255, each followed by one byte 0. Two yields may follow for one byte, the S suffixes
    in descending order; what is shared across the border between them is in the first prefix of the second.
    """
    n = len(text)
    ends = np.flatnonzero(text == 0)
    is_s = _s_types(text)
    seeds = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    ordered = _sort_seeds(text, is_s, seeds)
    lcp = np.zeros(len(ordered), np.uint8)
    lcp[1:] = shared_prefix(text, ordered[:-1], ordered[1:], ends)
    cuts = np.searchsorted(text[ordered], np.arange(258))
    up = _Pass(text, ~is_s)
    low: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for c in range(256):
        pos, shared = up.bucket(c)
        if len(pos):
            low[c] = pos, shared
        own, own_lcp = ordered[cuts[c] : cuts[c + 1]], lcp[cuts[c] : cuts[c + 1]].copy()
        if len(own):
            own_lcp[0] = shared_prefix(text, pos[-1:], own[:1], ends)[0] if len(pos) else 0
            up.feed(own, own_lcp)
    up.queue.close()
    down = _Pass(text, is_s & (text > 0))
    for c in range(255, 0, -1):
        pos, shared = down.bucket(c)
        l_pos, l_shared = low.pop(c, (np.empty(0, np.int64), np.empty(0, np.uint8)))
        if len(l_pos):
            yield l_pos, l_shared
            back = np.concatenate([[0], l_shared[:0:-1]]).astype(np.uint8)
            if len(pos):
                back[0] = shared_prefix(text, pos[-1:], l_pos[-1:], ends)[0]
            down.feed(l_pos[::-1], back)
        if len(pos):
            if len(l_pos):  # the border: least S suffix after greatest L suffix
                yield np.array([l_pos[-1], pos[-1]]), np.array([0, back[0]], np.uint8)
            yield pos, shared
    down.queue.close()


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string the places from which `length` bytes also start anywhere else in these strings."""
    if not 1 <= length <= CAP:
        raise ValueError(f"length must be from 1 to {CAP}")
    if not any(strings):
        return [np.zeros(0, np.int64) for _ in strings]
    raw = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    sizes = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    text = raw + np.uint8(1)  # the separator becomes 0
    if np.count_nonzero(text == 0) != len(strings):
        raise ValueError("byte 255 is kept for separators")
    marked = np.zeros(len(text), bool)
    for pos, shared in sorted_suffixes(text):
        same = np.flatnonzero(shared >= length)
        marked[pos[same]] = True
        marked[pos[same - 1]] = True
    return [np.flatnonzero(marked[e - n : e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
