"""Cuckoo filters of 64-bit keys, in numpy.

A filter is a chain of segments of the same size; a key's 16-bit fingerprint
lies in one of two buckets of four slots, in any segment.  The two buckets
follow from each other and the fingerprint, and are the same in every
segment: fingerprints that look alike can stand in for one another, so
removing one that was added never takes another key's away.  What a segment
can't place after ``KICKS`` rounds of moving others goes to a new one.

All operations work on arrays of distinct keys; a round of an insertion
moves at most one fingerprint per bucket.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class CuckooFilter:
    """``buckets`` per segment, a power of two."""

    def __init__(self, buckets: int, stored: bytes = b""):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.buckets = buckets
        self.segments = list(np.frombuffer(stored, np.uint16).reshape(-1, buckets, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return b"".join(s.tobytes() for s in self.segments)

    def __len__(self) -> int:
        return sum(int(np.count_nonzero(s)) for s in self.segments)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed = _mix(np.asarray(keys).view(np.uint64))
        mark = (mixed >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1  # 0 is an empty slot
        return mark, (mixed & np.uint64(self.buckets - 1)).astype(np.int64)

    def _other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (_mix(mark.astype(np.uint64)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """False only for keys that are not in it."""
        mark, bucket = self._places(keys)
        other = self._other(mark, bucket)
        found = np.zeros(len(mark), bool)
        for s in self.segments:
            found |= (s[bucket] == mark[:, None]).any(axis=1) | (s[other] == mark[:, None]).any(axis=1)
        return found

    def add(self, keys: np.ndarray) -> None:
        mark, bucket = self._places(keys)
        for s in self.segments:
            mark, bucket = self._into(s, mark, bucket)
        while len(mark):
            self.segments.append(np.zeros((self.buckets, SLOTS), np.uint16))
            mark, bucket = self._into(self.segments[-1], mark, bucket)

    def _free(self, s, mark, bucket):
        """Puts what it can into free slots; returns the rest."""
        order = np.argsort(bucket, kind="stable")
        mark, bucket = mark[order], bucket[order]
        first = np.searchsorted(bucket, bucket, "left")
        slot = np.count_nonzero(s[bucket], axis=1) + np.arange(len(bucket)) - first  # used slots come first
        fits = slot < SLOTS
        s[bucket[fits], slot[fits]] = mark[fits]
        return mark[~fits], bucket[~fits]

    def _into(self, s, mark, bucket):
        for kick in range(KICKS):
            mark, bucket = self._free(s, mark, bucket)
            if len(mark):
                mark, bucket = self._free(s, mark, self._other(mark, bucket))
            if not len(mark):
                break
            _, one = np.unique(bucket, return_index=True)  # one fingerprint per full bucket moves another
            out = s[bucket[one], kick % SLOTS].copy()
            s[bucket[one], kick % SLOTS] = mark[one]
            mark[one], bucket[one] = out, self._other(out, bucket[one])
        return mark, bucket

    def remove(self, keys: np.ndarray) -> None:
        """Takes out keys that were added, each as often as it is given."""
        mark, bucket = self._places(keys)
        other = self._other(mark, bucket)
        for s in self.segments:
            for second in (False, True):
                at = other if second else bucket
                left = np.ones(len(mark), bool)
                todo = np.arange(len(mark))
                while len(todo):
                    _, one = np.unique(at[todo], return_index=True)
                    now = todo[one]
                    hit = s[at[now]] == mark[now, None]
                    gone = now[hit.any(axis=1)]
                    row = s[at[gone]]
                    row[np.arange(len(gone)), hit[hit.any(axis=1)].argmax(axis=1)] = 0
                    s[at[gone]] = np.take_along_axis(row, np.argsort(row == 0, axis=1, kind="stable"), axis=1)
                    left[gone] = False
                    todo = np.delete(todo, one)
                mark, bucket, other = mark[left], bucket[left], other[left]
        if len(mark):
            raise KeyError("a key to be removed was never added")
