"""Arrays of unequal length, laid end to end, and a bounded memory of encoded words."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain

import numpy as np


_KEPT: list[tuple[str, str, object]] = []


def kept(kind: str, key: str, make: Callable[[], object]) -> object:
    """What ``make`` made for this ``kind`` and ``key``: a worker process keeps the last one from task to task, and no other."""
    if not _KEPT or _KEPT[0][:2] != (kind, key):
        _KEPT.clear()
        _KEPT.append((kind, key, make()))
    return _KEPT[0][2]


def gather(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values[offsets[r]:offsets[r + 1]]`` for each r of ``rows``, end to end, and their lengths."""
    starts = offsets[rows]
    lens = offsets[rows + 1] - starts
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts - (ends - lens), lens)
    at += np.arange(total, dtype=at.dtype)
    return values[at], lens


def table(rows: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings end to end with their offsets, for ``gather``."""
    return np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])


class _Rows(dict):
    """Word -> row; a word not met before gets the next row and is noted in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list = []

    def __missing__(self, word) -> int:
        self[word] = row = len(self)
        self.new.append(word)
        return row


class WordMemory:
    """Ids of words. ``encode`` is called once for each word that isn't remembered.

    At most ``limit`` words are remembered, those met first; others are encoded again
    for each call of ``ids``. Results don't depend on what is remembered.
    """

    def __init__(self, encode: Callable[[list], Iterable[Sequence[int]]], limit: int) -> None:
        self.encode, self.limit = encode, limit
        self.rows = _Rows()
        self.values, self.offsets = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)

    def ids(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``words``, end to end, and how many each has."""
        held = len(self.rows)
        rows = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        if new := self.rows.new:
            self.rows.new = []
            found = list(self.encode(new))
            ends = np.cumsum(list(map(len, found))) + self.offsets[held]
            self._grow(held + len(new), int(ends[-1]))
            self.values[self.offsets[held] : ends[-1]] = list(chain.from_iterable(found))
            self.offsets[held + 1 : held + 1 + len(new)] = ends
        out = gather(self.values, self.offsets, rows)
        for word in new[max(0, self.limit - held) :]:
            del self.rows[word]
        return out

    def _grow(self, words: int, ids: int) -> None:
        while words + 1 >= len(self.offsets):
            self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
        while ids >= len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])


def portions(texts: Iterable[bytes | str], size: int = 1 << 20) -> Iterator[list]:
    """Runs of whole texts of about ``size`` characters; a longer text is alone or the last of a run."""
    run: list = []
    total = 0
    for text in texts:
        run.append(text)
        total += len(text)
        if total >= size:
            yield run
            run, total = [], 0
    if run:
        yield run
