"""A cuckoo filter that keeps its keys beside the fingerprints."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MAX_KICKS = 256
MAX_LOAD = 0.9
_MIX = np.uint64(0xC6A4A7935BD1E995)


class CuckooIndex:
    """Live 256-bit digests, each with a value.

    A digest has two possible buckets of four slots. A slot shows a 16-bit
    fingerprint; only where that matches is the stored digest compared. When no
    slot can be freed by moving entries, the table doubles and is filled again
    from the stored digests, so nothing is ever lost. Deleting a digest frees
    its slot.
    """

    def __init__(self, expected: int = 16):
        size = 1
        while size * SLOTS * MAX_LOAD < expected:
            size *= 2
        self._allot(size)

    def _allot(self, size: int) -> None:
        self.size = size
        self.prints = np.zeros((size, SLOTS), np.uint16)
        self.digests = np.zeros((size, SLOTS, 4), np.uint64)
        self.values = np.zeros((size, SLOTS), np.int64)
        self.live = 0
        self._turn = 0

    @staticmethod
    def words(digests: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 4)

    @staticmethod
    def _print_of(words: np.ndarray) -> np.ndarray:
        return (words[..., 1] % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def _other(self, bucket, prints):
        with np.errstate(over="ignore"):
            step = (np.asarray(prints, np.uint64) * _MIX) >> np.uint64(20)
        return (np.asarray(bucket, np.uint64) ^ step) & np.uint64(self.size - 1)

    def find(self, words: np.ndarray) -> np.ndarray:
        """The place (bucket * 4 + slot) of each digest, or -1."""
        found = np.full(len(words), -1, np.int64)
        prints = self._print_of(words)
        first = words[:, 0] & np.uint64(self.size - 1)
        for bucket in (first, self._other(first, prints)):
            row, slot = np.nonzero(self.prints[bucket] == prints[:, None])
            real = (self.digests[bucket[row], slot] == words[row]).all(axis=1)
            found[row[real]] = bucket[row[real]].astype(np.int64) * SLOTS + slot[real]
        return found

    def add(self, words: np.ndarray, value: int) -> int:
        """Insert one digest unless it is live; its place."""
        at = int(self.find(words[None, :])[0])
        if at >= 0:
            return at
        if (self.live + 1) > self.size * SLOTS * MAX_LOAD or not self._place(words, value):
            self._grow()
            return self.add(words, value)
        return int(self.find(words[None, :])[0])

    def _place(self, words: np.ndarray, value: int) -> bool:
        prints = self._print_of(words)
        bucket = int(words[0] & np.uint64(self.size - 1))
        trail = []
        for kick in range(MAX_KICKS):
            for b in (bucket, int(self._other(bucket, prints))):
                free = np.flatnonzero(self.prints[b] == 0)
                if len(free):
                    self._store(b, int(free[0]), prints, words, value)
                    self.live += 1
                    return True
            bucket = int(self._other(bucket, prints)) if kick % 2 else bucket
            slot = self._turn = (self._turn + 1) % SLOTS
            trail.append((bucket, slot))
            moved = self.prints[bucket, slot].copy(), self.digests[bucket, slot].copy(), int(self.values[bucket, slot])
            self._store(bucket, slot, prints, words, value)
            prints, words, value = moved
            bucket = int(self._other(bucket, prints))
        for bucket, slot in reversed(trail):  # undo, so that growing starts from a whole table
            moved = self.prints[bucket, slot].copy(), self.digests[bucket, slot].copy(), int(self.values[bucket, slot])
            self._store(bucket, slot, prints, words, value)
            prints, words, value = moved
        return False

    def _store(self, bucket, slot, prints, words, value) -> None:
        self.prints[bucket, slot], self.digests[bucket, slot], self.values[bucket, slot] = prints, words, value

    def _grow(self) -> None:
        """Double the table and insert every stored digest again."""
        used = self.prints != 0
        digests, values, size = self.digests[used], self.values[used], self.size
        while True:
            size *= 2
            self._allot(size)
            if all(self._place(w, int(v)) for w, v in zip(digests, values, strict=True)):
                return

    def value(self, at: int) -> int:
        return int(self.values[at // SLOTS, at % SLOTS])

    def set_value(self, at: int, value: int) -> None:
        self.values[at // SLOTS, at % SLOTS] = value

    def delete(self, words: np.ndarray) -> int:
        """Remove live digests; how many there were."""
        at = np.unique(self.find(words))
        at = at[at >= 0]
        self.prints[at // SLOTS, at % SLOTS] = 0
        self.live -= len(at)
        return len(at)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        used = self.prints != 0
        return self.digests[used], self.values[used]

    def to_bytes(self) -> bytes:
        head = np.array([self.size, self.live], np.int64).tobytes()
        return head + self.prints.tobytes() + self.digests.tobytes() + self.values.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> "CuckooIndex":
        index = cls()
        size, live = (int(x) for x in np.frombuffer(raw, np.int64, 2))
        at, index.size, index.live = 16, size, live
        for name, kind, shape in (("prints", np.uint16, (size, SLOTS)), ("digests", np.uint64, (size, SLOTS, 4)), ("values", np.int64, (size, SLOTS))):
            count = int(np.prod(shape))
            setattr(index, name, np.frombuffer(raw, kind, count, at).reshape(shape).copy())
            at += count * np.dtype(kind).itemsize
        return index
