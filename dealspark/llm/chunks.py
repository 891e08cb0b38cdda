"""Tokens of whole texts from tokens of their chunks.

A chunk is a run of whitespace and the run of other characters that follows it.
The split pattern of the byte-level vocabularies never matches across the end
of a chunk: every match starts with at most one space and no match holds
whitespace after other characters.  So a text's tokens are those of its chunks
in turn, and a task tokenises each different chunk once.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

_RUNS = re.compile(r"\s\s")
_STARTS = re.compile(r"(?<=\S)(?=\s)")

#: Chunks a task remembers; beyond it the store starts anew.
STORE_CHUNKS = 400_000


class _Numbers(dict):
    """Key -> number; unseen keys are numbered and listed."""

    def __init__(self, store: ChunkStore, spaced: bool) -> None:
        self.store, self.spaced = store, spaced

    def __missing__(self, item: str) -> int:
        self[item] = n = self.store.count
        self.store.count = n + 1
        self.store.fresh.append(" " + item if self.spaced and item[:1] != "\n" else item)
        return n


class ChunkStore:
    """``tokenise`` maps a list of chunks to one int32 array and the chunks' lengths in it."""

    def __init__(self, tokenise: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
                 limit: int = STORE_CHUNKS, starts: re.Pattern = _STARTS, runs: re.Pattern = _RUNS) -> None:
        #: Where chunks start; in a text in which ``runs`` finds nothing, before every space and line feed.
        self.tokenise, self.limit, self.starts, self.runs = tokenise, limit, starts, runs
        self._clear()

    def _clear(self) -> None:
        self.count, self.fresh = 0, []
        self.whole, self.spaced = _Numbers(self, False), _Numbers(self, True)
        self.start, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool, self.used = np.zeros(4096, np.int32), 0

    def _numbers(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int64)
        if self.runs.search(text):
            parts = self.starts.split(text)
            return np.fromiter(map(self.whole.__getitem__, parts), np.int64, len(parts))
        # Single separators only: the separator is left out of the key.
        parts = text.replace("\n", " \n").split(" ")
        out = np.fromiter(map(self.spaced.__getitem__, parts), np.int64, len(parts))
        if parts[0]:
            out[0] = self.whole[parts[0]]
            return out
        return out[1:]

    def _learn(self) -> None:
        if not self.fresh:
            return
        flat, lens = self.tokenise(self.fresh)
        at, top = self.count - len(self.fresh), self.count
        self.start, self.length = grown(self.start, top), grown(self.length, top)
        self.pool = grown(self.pool, self.used + len(flat))
        self.length[at:top] = lens
        self.start[at:top] = self.used + np.cumsum(lens) - lens
        self.pool[self.used:self.used + len(flat)] = flat
        self.used += len(flat)
        self.fresh.clear()

    def tokens(self, texts: list[str]) -> list[np.ndarray]:
        if self.count > self.limit:
            self._clear()
        numbered = [self._numbers(t) for t in texts]
        self._learn()
        return [self._gather(n) for n in numbered]

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        lens = self.length[numbers]
        n = int(lens.sum())
        ends = np.cumsum(lens)
        return self.pool[np.arange(n) + np.repeat(self.start[numbers] - (ends - lens), lens)]


def grown(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    return np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])
