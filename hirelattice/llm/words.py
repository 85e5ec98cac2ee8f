"""Words of many texts at once: 64-bit hashes in whole arrays, and compact tables of what is known of each word.

Unless other separators are named, words are strings of bytes other than the blank and the five control characters from tab
to carriage return.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

from hirelattice.llm.exchange import mixed

SPAN = 1 << 18  # bytes hashed at once
BLANKS = b"\t\n\x0b\x0c\r "
LETTER = mixed(np.arange(256, dtype=np.uint64))
BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


@dataclass
class Words:
    """The words of texts in a row: hashes, where they start and end in ``body``, and each text's first word (one more at the end)."""

    body: bytes
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def strings(self, at: np.ndarray) -> list[bytes]:
        return [self.body[s:e] for s, e in zip(self.starts[at].tolist(), self.ends[at].tolist(), strict=True)]


class WordHashes:
    """Hashes the words of texts: sums of a number per byte times powers of an odd base, then spread."""

    def __init__(self, separators: bytes = BLANKS) -> None:
        self.separators = separators
        self.separator = re.compile(b"[" + re.escape(separators) + b"]")
        self.inside = ~np.isin(np.arange(256), list(separators))
        self.up, self.down = _powers(BASE, SPAN + 4096), _powers(INVERSE, SPAN + 4096)

    def _span(self, span: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        letters = np.frombuffer(span, np.uint8)
        n = len(letters)
        fits = n <= len(self.up)
        up, down = (self.up[:n], self.down[:n]) if fits else (_powers(BASE, n), _powers(INVERSE, n))
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = self.inside[letters]
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = turns[::2], turns[1::2]
        before = np.zeros(n + 1, np.uint64)
        np.cumsum(LETTER[letters] * up, out=before[1:])
        return mixed((before[ends] - before[starts]) * down[starts]), starts, ends

    def of(self, body: bytes, sizes: np.ndarray) -> Words:
        """The words of texts of these sizes, which stand in ``body`` with one separator after each."""
        found, at = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
        while at < len(body):
            blank = self.separator.search(body, at + SPAN)
            end = blank.end() if blank else len(body)
            hashes, starts, ends = self._span(body[at:end])
            found.append((hashes, starts + at, ends + at))
            at = end
        hashes, starts, ends = (np.concatenate(x) for x in zip(*found, strict=True))
        offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
        return Words(body, hashes, starts, ends, np.searchsorted(starts, offsets))

    def of_texts(self, texts: list[bytes]) -> Words:
        return self.of(self.separators[-1:].join([*texts, b""]), np.array([len(t) for t in texts], np.int64))


class Known:
    """Row numbers of 64-bit keys: 16 bytes a key."""

    def __init__(self) -> None:
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The rows of keys, -1 for unknown ones."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rows[at], -1)

    def add(self, keys: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """Rows for new, ascending keys: the next ones, if none are given."""
        if rows is None:
            rows = np.arange(len(self.keys), len(self.keys) + len(keys))
        at = np.searchsorted(self.keys, keys)
        self.keys, self.rows = np.insert(self.keys, at, keys), np.insert(self.rows, at, rows)
        return rows


class Grown:
    """An array that grows at its end."""

    def __init__(self, shape: tuple[int, ...], kind) -> None:
        self.held, self.size = np.zeros((1024, *shape), kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.held):
            grown = np.zeros((max(need, 2 * len(self.held)), *self.held.shape[1:]), self.held.dtype)
            grown[:self.size] = self.held[:self.size]
            self.held = grown
        self.held[self.size:need] = values
        self.size = need

    @property
    def values(self) -> np.ndarray:
        return self.held[:self.size]
