"""Suffix arrays and common prefixes in numpy."""

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a byte array, by Larsson-Sadakane refinement.

    Suffixes are sorted by eight bytes at first. Then every group of suffixes that are still equal is
    sorted by the group numbers of what follows its known prefix, which doubles that prefix; groups of one
    are settled and never touched again.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    key = np.zeros(n + 8, np.uint64)
    # One more than the byte, so that the end of the text is smaller than any byte: seven bytes fit with it.
    key[:n] = text.astype(np.uint64) + np.uint64(1)
    pair = (key[:-1] * np.uint64(257)) + key[1:]
    four = pair[:-2] * np.uint64(257**2) + pair[2:]
    key = four[:n] * np.uint64(257**3) + (pair[4 : n + 4] * np.uint64(257) + key[6 : n + 6])
    order = np.argsort(key)
    found = key[order]
    new = np.concatenate([[True], found[1:] != found[:-1]])
    # The number of a group is the place of its first member.
    heads = np.flatnonzero(new)
    group = np.empty(n + 1, np.int64)
    group[order] = np.repeat(heads, np.diff(np.concatenate([heads, [n]])))
    group[n] = -1
    places = _unsettled(np.arange(n), new)
    known = 7
    while len(places):
        suffixes = order[places]
        head = group[suffixes]
        # One number for the group and what follows.
        by = head * (n + 1) + group[np.minimum(suffixes + known, n)]
        at = np.argsort(by)
        suffixes, by = suffixes[at], by[at]
        order[places] = suffixes
        new = np.concatenate([[True], by[1:] != by[:-1]])
        heads = np.flatnonzero(new)
        group[suffixes] = np.repeat(places[heads], np.diff(np.concatenate([heads, [len(new)]])))
        places = _unsettled(places, new)
        known *= 2
    return order


def _unsettled(places: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The places whose group has more than one member; `new` marks first members."""
    single = new & np.concatenate([new[1:], [True]])
    return places[~single]


def common_prefixes(
    text: np.ndarray, before: np.ndarray, begins: np.ndarray, counts: np.ndarray, most: int
) -> np.ndarray:
    """Length, up to `most`, of what each wanted suffix shares with the wanted one sorted before it.

    Wanted suffixes are the first `counts` of every stretch that begins at `begins`, `most` bytes and more
    before the end of its stretch; `before` has the place of the sorted predecessor, -1 for none. Kasai's
    method for all stretches side by side: moving on by one byte loses at most one byte of the common prefix,
    unless the predecessor was the last wanted suffix of its stretch.
    """
    shared = np.zeros(len(text), np.int64)
    last = np.zeros(len(text), bool)
    last[begins + counts - 1] = True
    lanes = np.argsort(-counts, kind="stable")
    begins, counts = begins[lanes], counts[lanes]
    known = np.zeros(len(begins), np.int64)
    for step in range(int(counts[0]) if len(counts) else 0):
        active = np.searchsorted(-counts, -step, "left")
        at = begins[:active] + step
        other = before[at]
        length = known[:active].copy()
        length[other < 0] = 0
        growing = np.flatnonzero((other >= 0) & (length < most))
        while len(growing):
            same = text[at[growing] + length[growing]] == text[other[growing] + length[growing]]
            growing = growing[same]
            length[growing] += 1
            growing = growing[length[growing] < most]
        shared[at] = length
        known[:active] = np.where((other < 0) | last[np.maximum(other, 0)], 0, np.maximum(length - 1, 0))
    return shared
