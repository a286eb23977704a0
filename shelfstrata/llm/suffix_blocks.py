"""Equal windows of a block of text by a blockwise suffix sort with a difference cover.

The positions whose remainder by `PERIOD` is in `COVER` are the sample: for any two positions there is a shift
below `PERIOD` that brings both into it. The samples of a block are ranked first, by doubling. Suffixes are then
sorted a bucket at a time by their first bytes; suffixes that agree there, a long tie, are told apart by the
ranks of the samples that their shift leads to. Memory is that of one block's samples and one bucket.
"""

from __future__ import annotations

import numpy as np

#: A perfect difference set, every remainder by 21 is a difference of two of its members.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
#: Bytes of a suffix that are compared directly, at its start and at its end, and the lengths that doubling goes
#: through: each is the one before plus a multiple of the period that it covers.
HEAD, TAIL = 23, 24
STEPS = ((23, 21), (44, 42), (86, 84), (170, 168), (338, 42))
RANKED = 380
#: Suffixes that are sorted at once.
BUCKET = 1 << 18


def _words(text: np.ndarray, at: np.ndarray, length: int) -> list[np.ndarray]:
    """Bytes of `text` at positions, as big-endian numbers of up to eight bytes."""
    out = []
    for k in range(0, length, 8):
        number = np.zeros(len(at), dtype=np.uint64)
        for i in range(k, min(k + 8, length)):
            number = (number << np.uint64(8)) | text[at + i]
        out.append(number)
    return out


def _ranks(keys: list[np.ndarray]) -> np.ndarray:
    """The rank of each row among rows of keys, the first key leading; equal rows share a rank."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=np.int64)
    for key in keys:
        sorted_key = key[order]
        new[1:] |= sorted_key[1:] != sorted_key[:-1]
    ranks = np.empty(len(order), dtype=np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def cover_ranks(text: np.ndarray) -> np.ndarray:
    """Per position of `text` that is in the sample, the rank of its next `RANKED` bytes; elsewhere -1.

    `text` is followed by padding, so that positions near its end have ranks, which nothing asks for.
    """
    in_cover = np.zeros(PERIOD, dtype=bool)
    in_cover[list(COVER)] = True
    at = np.flatnonzero(in_cover[np.arange(len(text)) % PERIOD])
    padded = np.append(text, np.zeros(HEAD, dtype=np.uint8))
    rank = np.full(len(text) + RANKED, -1, dtype=np.int64)
    rank[at] = _ranks(_words(padded, at, HEAD))
    for _, shift in STEPS:
        later = rank[at + shift]
        _, rank[at] = np.unique((rank[at] << np.int64(32)) | (later + 1), return_inverse=True)
    return rank


def _repeats(group: np.ndarray) -> np.ndarray:
    """Whether a row's group has another row."""
    return np.bincount(group)[group] > 1


def equal_windows(text: np.ndarray, starts: np.ndarray, bucket: np.ndarray, width: int) -> np.ndarray:
    """Whether the `width` bytes at a start equal those at another start of the same `bucket`.

    `width` is between `RANKED` + `PERIOD` - 1 and `RANKED` + `TAIL`; buckets are numbers in ascending order.
    """
    assert RANKED + PERIOD - 1 <= width <= RANKED + TAIL
    found = np.zeros(len(starts), dtype=bool)
    if not len(starts):
        return found
    rank = cover_ranks(text)
    # Stretches of about BUCKET suffixes that end where a bucket does.
    ends = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket))
    begin = 0
    while begin < len(starts):
        end = int(ends[min(np.searchsorted(ends, begin + BUCKET), len(ends) - 1)])
        rows = np.arange(begin, end)
        group = _ranks([bucket[rows].astype(np.uint64), *_words(text, starts[rows], HEAD)])
        tie = _repeats(group)
        rows, group = rows[tie], group[tie]
        if len(rows):
            group = _ranks([group.astype(np.uint64), *_words(text, starts[rows] + width - TAIL, TAIL)])
            tie = _repeats(group)
            rows, group = rows[tie], group[tie]
        for shift in range(PERIOD if len(rows) else 0):
            sampled = np.isin((starts[rows] + shift) % PERIOD, COVER)
            if sampled.any():
                key = (group[sampled] << np.int64(32)) | rank[starts[rows[sampled]] + shift]
                _, same, count = np.unique(key, return_inverse=True, return_counts=True)
                found[rows[sampled]] |= count[same] > 1
        begin = end
    return found
