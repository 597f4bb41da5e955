"""Pre-tokenizer pieces of many texts at once, and a per-worker memory of their ids.

``split`` finds the matches of the byte-level BPE pattern (contractions; letters,
numbers or other signs with one optional space before; white space) for a batch of texts
with array operations over code points.  ``PieceCoder`` numbers a batch's distinct
pieces, asks its encoder only for those it has not met, and lays the ids out per text.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
import regex

from civic_mart.llm.common import worker_cache

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
_POWER = 0x9E3779B97F4A7C15 | 1
# after an apostrophe that starts a piece: contraction endings of the public pattern (fixed values)
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def char_classes() -> np.ndarray:
    """Class of every code point."""
    cache = worker_cache("classes")
    if "table" not in cache:
        every = "".join(map(chr, range(0x110000)))
        table = np.zeros(0x110000, np.uint8)
        for name, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
            for m in regex.finditer(name, every):
                table[m.start():m.end()] = kind
        cache["table"] = table
    return cache["table"]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts in a row, offsets of the texts in them)."""
    cps = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return cps, np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])


def split(cps: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start of every piece.  Pieces cover the texts without gaps and never cross one's end."""
    n = len(cps)
    if not n:
        return np.empty(0, np.int64)
    cls = char_classes()[cps]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # text starts, and n
    run = edge[:n].copy()
    run[1:] |= cls[1:] != cls[:-1]
    s = np.flatnonzero(run)
    e = np.append(s[1:], n)
    kind, last_of_text = cls[s], edge[e]
    space = kind == SPACE
    blank_end = cps[e - 1] == 0x20
    mark = np.zeros(n, bool)
    # white space before something else gives up its last character: a blank joins what
    # follows, any other stands alone; the rest of the run is a piece
    inner = space & ~last_of_text
    mark[s[space & (last_of_text | (e - s > 1) | ~blank_end)]] = True
    mark[e[inner & ~blank_end] - 1] = True
    takes = np.zeros(len(s), bool)
    takes[1:] = inner[:-1] & blank_end[:-1] & ~space[1:]
    mark[s[~space] - takes[~space]] = True
    # a lone apostrophe that starts a piece takes a contraction's letters from the next run
    lone = np.flatnonzero((kind == OTHER) & (e - s == 1) & ~last_of_text & ~takes & (cps[s] == 0x27))
    lone = lone[kind[lone + 1] == LETTER] if len(lone) else lone
    for i in lone:
        at, end = int(s[i + 1]), int(e[i + 1])
        after = "".join(map(chr, cps[at:min(at + 2, end)]))
        size = next((len(x) for x in _ENDINGS if after.startswith(x)), 0)
        if size:
            mark[at] = False
            if at + size < end:
                mark[at + size] = True
    return np.flatnonzero(mark)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    cache = worker_cache("powers")
    if len(cache.get("up", ())) < n:
        size = max(n, 1 << 16)
        inverse = pow(_POWER, -1, 1 << 64)
        for name, base in (("up", _POWER), ("down", inverse)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            cache[name] = np.cumprod(p)  # wraps modulo 2^64
    return cache["up"][:n], cache["down"][:n]


def piece_keys(cps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit key of each piece (polynomial over mixed code points, with its length)."""
    n = len(cps)
    x = (cps.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    up, down = _powers(n)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up)])
    ends = np.append(starts[1:], n)
    key = (total[ends] - total[starts]) * down[starts]
    return key ^ ((ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the runs [start, start + size), one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def _position_keys(n: int) -> np.ndarray:
    """A random 64-bit key for each of the first ``n`` positions, drawn once a worker."""
    cache = worker_cache("position_keys")
    if "table" not in cache:
        cache["table"] = np.frombuffer(os.urandom(8 << 16), np.uint64) | np.uint64(1)
    if n <= 1 << 16:
        return cache["table"]
    blocks = -(-n >> 16)  # a piece this long is rare: each further block turns the keys by its number
    turns = (np.arange(blocks, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)
    return (cache["table"][None, :] * turns[:, None]).ravel()


def piece_checks(cps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A second 64-bit key of each piece, with random keys by position: no text is made to collide."""
    n = len(cps)
    sizes = np.diff(starts, append=n)
    at = np.arange(n) - np.repeat(starts, sizes)
    x = (cps.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * _position_keys(int(sizes.max()))[at])])
    return total[starts + sizes] - total[starts]


class Rows:
    """Variable-length rows in one growing flat array."""

    def __init__(self, dtype) -> None:
        self.flat, self.used = np.empty(1 << 12, dtype), 0
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        need = self.used + len(flat)
        if need > len(self.flat):
            grown = np.empty(max(need, 2 * len(self.flat)), self.flat.dtype)
            grown[:self.used] = self.flat[:self.used]
            self.flat = grown
        self.flat[self.used:need] = flat
        self.start = np.concatenate([self.start, self.used + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.used = need

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.size[rows]
        return self.flat[spread(self.start[rows], sizes)], sizes


#: encoder(pieces) -> ((ids, sizes), (decoded bytes, sizes))
Encoder = Callable[[list[str]], tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]]


class PieceCoder:
    """Remembers the ids (and decoded bytes) of up to ``most`` pieces, then starts anew."""

    def __init__(self, encoder: Encoder, most: int = 800_000) -> None:
        self.encoder, self.most = encoder, most
        self.forget()

    def forget(self) -> None:
        self.keys, self.row = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.checks = np.empty(0, np.uint64)  # by row
        self.ids, self.raw = Rows(np.uint32), Rows(np.uint8)

    def rows(self, joined: str, cps: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Row of each piece in ``ids`` and ``raw``."""
        checks = piece_checks(cps, starts)
        keys, first, inverse = np.unique(piece_keys(cps, starts), return_index=True, return_inverse=True)
        if (checks[first][inverse] != checks).any():
            return self._apart(joined, len(cps), starts)
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        if (self.checks[self.row[at[known]]] != checks[first[known]]).any():
            return self._apart(joined, len(cps), starts)
        fresh = np.flatnonzero(~known)
        if len(fresh):
            if len(self.keys) and len(self.keys) + len(fresh) > self.most:
                self.forget()
                return self.rows(joined, cps, starts)
            ends = np.append(starts[1:], len(cps))
            spans = zip(starts[first[fresh]].tolist(), ends[first[fresh]].tolist())
            row = self._add([joined[a:b] for a, b in spans], checks[first[fresh]])
            all_keys = np.concatenate([self.keys, keys[fresh]])
            order = np.argsort(all_keys, kind="stable")
            self.keys, self.row = all_keys[order], np.concatenate([self.row, row])[order]
            at = np.searchsorted(self.keys, keys)
        return self.row[at][inverse]

    def _add(self, pieces: list[str], checks: np.ndarray) -> np.ndarray:
        """New rows of the encoded pieces."""
        ids, raw = self.encoder(pieces)
        row = len(self.ids.size) + np.arange(len(pieces))
        self.ids.add(*ids)
        self.raw.add(*raw)
        self.checks = np.concatenate([self.checks, checks])
        return row

    def _apart(self, joined: str, n: int, starts: np.ndarray) -> np.ndarray:
        """Rows of a batch in which different pieces share a key: told apart by their text."""
        pieces = [joined[a:b] for a, b in zip(starts.tolist(), [*starts[1:].tolist(), n])]
        distinct = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
        row = self._add(list(distinct), np.zeros(len(distinct), np.uint64))  # under no key
        return row[[distinct[p] for p in pieces]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, id offsets of the texts, decoded bytes, byte offsets of the texts)."""
        joined = "".join(texts)
        cps, offsets = code_points(texts)
        starts = split(cps, offsets)
        text_piece = np.searchsorted(starts, offsets)  # first piece of each text
        rows = self.rows(joined, cps, starts) if len(starts) else np.empty(0, np.int64)
        out = []
        for store in (self.ids, self.raw):
            flat, sizes = store.take(rows)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            out += [flat, ends[text_piece]]
        return tuple(out)


def batches_of(texts: list[str], most_chars: int = 1_000_000):
    """Consecutive slices of about ``most_chars`` characters (a longer text stands alone)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most_chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)
