"""Hashes of words and of word sequences, for whole batches of text at once."""

from collections.abc import Iterator

import numpy as np

BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Odd factors of the hash; any do.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
MIXES = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(h: np.ndarray, factor: np.uint64) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * factor
    h = (h ^ (h >> np.uint64(29))) * FACTOR
    return h ^ (h >> np.uint64(32))


#: Bytes hashed at once; this bounds the memory.
_SEGMENT = 1 << 20


def _segments(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """``raw`` in parts of about _SEGMENT bytes that end at a line end, a blank or at its end."""
    at = 0
    while at < len(raw):
        end = at + _SEGMENT
        if end < len(raw):
            cuts = [x for x in (raw.find(b"\n", end), raw.find(b" ", end)) if x >= 0]
            end = min(cuts, default=len(raw))
        yield at, raw[at:end]
        at = end


def words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word: runs of bytes that are not ASCII white space."""
    starts, hashes = [], []
    for at, part in _segments(raw):
        letters = np.frombuffer(part, dtype=np.uint8)
        blank = BLANK[letters]
        edges = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
        first, end = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        if not len(first):
            continue
        lengths = end - first
        before = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum(), dtype=np.uint64) - np.repeat(before, lengths).astype(np.uint64)
        each = mixed((letters[~blank].astype(np.uint64) + np.uint64(1)) * FACTOR + place * MIXES[0], MIXES[1])
        starts.append(first + at)
        hashes.append(np.add.reduceat(each, before))
    if not starts:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)
