"""Token ids of spans of bytes, each distinct span encoded once and remembered."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from textmill.llm._text import member, mix, ranges, spans

#: Spans a worker remembers at most; beyond that it starts anew, with the same results.
MOST = 1_500_000


class Lexicon:
    """encode: ids of each of a list of byte strings. `special` are the ids of entry 0, for ends of texts. Spans are found by a hash
    and confirmed on their bytes; one whose hash another span has is encoded anew."""

    def __init__(self, encode: Callable[[list[bytes]], list], special: list[int], most: int = MOST):
        self.encode, self.special, self.most = encode, special, most
        self.forget()

    def forget(self) -> None:
        self.keys = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]  # many, and those of late, each sorted
        self.at = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.start, self.size, self.flat = np.zeros(1, np.int64), np.array([len(self.special)]), np.array(self.special, np.int32)
        self.bytes, self.from_, self.length = np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _keep(self, found: list, raw: np.ndarray, length: np.ndarray) -> np.ndarray:
        """New entries, of these ids and bytes."""
        size = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((x for y in found for x in y), np.int32, int(size.sum()))
        at = np.arange(len(self.start), len(self.start) + len(found))
        self.start = np.r_[self.start, len(self.flat) + np.cumsum(size) - size]
        self.size, self.flat = np.r_[self.size, size], np.r_[self.flat, ids]
        self.from_ = np.r_[self.from_, len(self.bytes) + np.cumsum(length) - length]
        self.length, self.bytes = np.r_[self.length, length], np.r_[self.bytes, raw]
        return at

    def _add(self, keys: np.ndarray, at: np.ndarray) -> None:
        self._merge(1, keys, at)
        if len(self.keys[1]) > 100_000:
            self._merge(0, self.keys[1], self.at[1])
            self.keys[1], self.at[1] = self.keys[1][:0], self.at[1][:0]

    def _merge(self, k: int, keys: np.ndarray, at: np.ndarray) -> None:
        i = np.searchsorted(self.keys[k], keys)
        self.keys[k], self.at[k] = np.insert(self.keys[k], i, keys), np.insert(self.at[k], i, at)

    def entries(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of each data[start:end]."""
        keys, first, inverse = np.unique(mix(spans(data, start, end), 5), return_index=True, return_inverse=True)
        if len(self.start) + len(keys) > self.most:
            self.forget()
        new = ~(member(self.keys[0], keys) | member(self.keys[1], keys))
        if new.any():
            self._add(keys[new], self._encoded(data, start[first[new]], end[first[new]]))
        out = np.empty(len(keys), np.int64)
        for k, at in zip(self.keys, self.at):
            if len(k):
                i = np.searchsorted(k, keys)
                i[i == len(k)] = 0
                hit = k[i] == keys
                out[hit] = at[i[hit]]
        out = out[inverse]
        other = self._others(data, start, end - start, out)
        if len(other):
            out[other] = self._encoded(data, start[other], end[other])
        return out

    def _encoded(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw, a, b = data.tobytes(), start.tolist(), end.tolist()
        return self._keep(self.encode([raw[x:y] for x, y in zip(a, b)]), data[ranges(start, end - start)], end - start)

    def _others(self, data: np.ndarray, start: np.ndarray, n: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Numbers of the spans whose bytes are not those of their entry."""
        other = n != self.length[entry]
        go = np.flatnonzero(~other & (n > 0))
        if len(go):
            m = n[go]
            differ = data[ranges(start[go], m)] != self.bytes[ranges(self.from_[entry[go]], m)]
            other[go] = np.logical_or.reduceat(differ, np.cumsum(m) - m)
        return np.flatnonzero(other)

    def tokens(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a row of entries, and the number of ids of each entry."""
        size = self.size[entries]
        return self.flat[ranges(self.start[entries], size)], size
