"""Suffix order and common prefixes of a byte string, in numpy."""

from __future__ import annotations

import numpy as np

LANE = 64


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the place of each.

    Larsson-Sadakane: sort by the first eight bytes, then refine only the groups
    that are still equal, each time by the ranks half-way on, so the sorted depth
    doubles. A suffix's rank is the last place of its group. The end of the text
    sorts first.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    keys = np.zeros(n, np.uint64)
    for k in range(8):
        keys = (keys << np.uint64(8)) | padded[k:k + n]
    order = np.argsort(keys, kind="stable")
    # A zero byte and the end look alike in the keys: the shorter suffix first.
    tail = np.flatnonzero(np.arange(n) > n - 8)
    lengths = np.full(n, 8, np.int8)
    lengths[tail] = n - tail
    sorted_keys, sorted_lengths = keys[order], lengths[order]
    if len(tail) and (sorted_keys[1:] == sorted_keys[:-1]).any():
        order = np.lexsort((lengths, keys))
        sorted_keys, sorted_lengths = keys[order], lengths[order]
    last = np.concatenate([(sorted_keys[1:] != sorted_keys[:-1]) | (sorted_lengths[1:] != sorted_lengths[:-1]), [True]])
    rank = np.empty(n, np.int64)
    rank[order] = _last_place(last)
    sorted_to = 8
    open_places = _open(last)
    while len(open_places):
        suffixes = order[open_places]
        group = rank[suffixes]
        ahead = suffixes + sorted_to
        half = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        inner = np.argsort(group * (n + 1) + half + 1, kind="stable")
        suffixes, group, half = suffixes[inner], group[inner], half[inner]
        order[open_places] = suffixes
        last = np.concatenate([(group[1:] != group[:-1]) | (half[1:] != half[:-1]), [True]])
        # Places of one group are contiguous, and so are those of its parts.
        ends = open_places[np.flatnonzero(last)]
        rank[suffixes] = np.repeat(ends, np.diff(np.concatenate([[0], np.flatnonzero(last) + 1])))
        first = np.concatenate([[True], last[:-1]])
        open_places = open_places[~(first & last)]
        sorted_to *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def _last_place(last: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(last)
    return np.repeat(ends, np.diff(np.concatenate([[-1], ends])))


def _open(last: np.ndarray) -> np.ndarray:
    first = np.concatenate([[True], last[:-1]])
    return np.flatnonzero(~(first & last))


def common_prefixes(text: np.ndarray, order: np.ndarray, place: np.ndarray, most: int) -> np.ndarray:
    """For each place the bytes shared with the suffix before it, ``most`` at most.

    Kasai's walk: going one byte on in the text loses one common byte at most. The
    text is cut into lanes of ``LANE`` bytes that walk side by side.
    """
    n = len(text)
    shared = np.zeros(n, np.int64)
    if n < 2:
        return shared
    at = np.arange(0, n, LANE)
    stop = np.minimum(at + LANE, n)
    have = np.zeros(len(at), np.int64)
    padded = np.concatenate([text, np.zeros(most + 1, np.uint8)])
    prior = order[np.maximum(place[at] - 1, 0)]
    while len(at):
        inside = (np.maximum(at, prior) + have < n) & (have < most) & (place[at] > 0)
        same = inside & (padded[at + have] == padded[prior + have])
        have += same
        ended = ~same
        shared[place[at[ended]]] = have[ended]
        at[ended] += 1
        have[ended] = np.maximum(have[ended] - 1, 0)
        alive = at < stop
        if not alive.all():
            at, stop, have, prior, ended = at[alive], stop[alive], have[alive], prior[alive], ended[alive]
        moved = np.flatnonzero(ended)
        here = place[at[moved]]
        prior[moved] = order[np.maximum(here - 1, 0)]
        have[moved[here == 0]] = 0
    return shared
