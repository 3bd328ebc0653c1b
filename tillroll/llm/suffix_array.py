"""Suffix arrays by induced sorting, and permuted common prefixes, of one shard of bytes.

``suffix_array`` classifies suffixes as smaller (S) or larger (L) than the next
one, sorts the substrings between leftmost S positions by inducing, names them, sorts the
string of names in turn, and induces the whole array from it.  The
induction goes bucket by bucket and, in a bucket, wave by wave, each a few
array operations on linear work.  The string of names is sorted by doubling ranks.
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one is larger than the empty one."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1]) if n > 1 else np.zeros(0, np.int64)
    small = np.zeros(n, bool)
    if len(change):
        rises = text[change + 1] > text[change]
        small[:change[-1] + 1] = np.repeat(rises, np.diff(np.concatenate([[0], change + 1])))
    return small


def _leftmost(small: np.ndarray) -> np.ndarray:
    out = small.copy()
    out[1:] &= ~small[:-1]
    out[:1] = False
    return np.flatnonzero(out)


def _deal(lists: dict[int, list[np.ndarray]], entries: np.ndarray, chars: np.ndarray) -> None:
    """Appends ``entries``, in order, to the lists of their characters."""
    if not len(entries):
        return
    order = np.argsort(chars, kind="stable")
    entries, chars = entries[order], chars[order]
    cut = np.flatnonzero(np.append(True, chars[1:] != chars[:-1]))
    for a, b in zip(cut.tolist(), np.append(cut[1:], len(entries)).tolist()):
        lists.setdefault(int(chars[a]), []).append(entries[a:b])


def _gather(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost S suffixes in order (or, for sorting substrings, by first character)."""
    n = len(text)
    ends: dict[int, list[np.ndarray]] = {}
    _deal(ends, lms, text[lms])
    large: dict[int, list[np.ndarray]] = {int(text[n - 1]): [np.array([n - 1])]}
    chars = np.unique(text).tolist()
    for c in chars:
        wave = _gather(large.get(c, []))
        seen = [wave]
        while len(wave):  # larger suffixes of the same bucket, found by those before them
            before = wave[wave > 0] - 1
            wave = before[~small[before] & (text[before] == c)]
            seen.append(wave)
        large[c] = [_gather(seen)]
        source = _gather(large[c] + ends.get(c, []))
        before = source[source > 0] - 1
        before = before[~small[before] & (text[before] > c)]
        _deal(large, before, text[before])
    smaller: dict[int, list[np.ndarray]] = {}
    for c in reversed(chars):  # from the largest suffix down
        wave = _gather(smaller.get(c, []))
        seen = [wave]
        source = large[c][0][::-1]
        while len(wave):
            before = wave[wave > 0] - 1
            wave = before[small[before] & (text[before] == c)]
            seen.append(wave)
        smaller[c] = [_gather(seen)]
        source = _gather([smaller[c][0], source])
        before = source[source > 0] - 1
        before = before[small[before] & (text[before] < c)]
        _deal(smaller, before, text[before])
    return _gather([x for c in chars for x in (large[c][0], smaller[c][0][::-1])])


def _rank_names(names: np.ndarray, most: int | None) -> np.ndarray:
    """Order of the suffixes of a string of names, or of their first ``most`` names at least, by doubling.

    Induction over so large an alphabet goes entry by entry, which costs several times more here.
    """
    n = len(names)
    rank, step = names.astype(np.int64), 1
    while True:
        key = rank * (n + 1)
        key[:-step or n] += rank[step:] + 1
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or step >= n or most is not None and step >= most:
            return order


def _names(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Name of each leftmost S substring in text order, equal ones alike, ascending; and how many there are."""
    place = np.zeros(len(text), np.int64)
    place[lms] = np.arange(len(lms))
    size = np.append(np.diff(lms), len(text) - lms[-1]) + 1  # the last one ends behind the text
    k = place[order]
    same = (size[k][1:] == size[k][:-1]) & (order[1:] + size[k][1:] <= len(text)) & (order[:-1] + size[k][:-1] <= len(text))
    at, step = np.flatnonzero(same), 0
    while len(at):
        at = at[step < size[k[at]]]
        differ = text[order[at] + step] != text[order[at + 1] + step]
        same[at[differ]] = False
        at, step = at[~differ], step + 1
    name = np.zeros(len(lms), np.int64)
    name[k] = np.concatenate([[0], np.cumsum(~same)])
    return name, int(name.max()) + 1


def suffix_array(text: np.ndarray, most: int | None = None) -> np.ndarray:
    """Start positions of the suffixes of ``text`` (bytes) in ascending order; with ``most``, suffixes that agree in
    so many bytes may stand in any order among themselves."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    small = _types(text)
    lms = _leftmost(small)
    if len(lms) > 1:
        order = _induce(text, small, lms)
        mark = np.zeros(n, bool)
        mark[lms] = True
        order = order[mark[order]]
        name, distinct = _names(text, lms, order)
        # two neighbouring leftmost S positions are two bytes apart at least
        lms = order if distinct == len(lms) else lms[_rank_names(name, None if most is None else most // 2 + 2)]
    return _induce(text, small, lms)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each position the one before it in the array (-1 for the first), and the length of their common prefix, up to
    ``most``: the permuted array, in text order."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    length = np.zeros(n, np.int64)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (n + 1,), (1,))
    at = np.flatnonzero(before >= 0)
    done = 0
    while len(at) and done + 8 <= most:  # eight bytes at a time
        at = at[(at + done + 8 <= n) & (before[at] + done + 8 <= n)]
        at = at[eight[at + done] == eight[before[at] + done]]
        done += 8
        length[at] = done
    at = np.flatnonzero((before >= 0) & (length < most))
    for _ in range(8):
        i, j = at + length[at], before[at] + length[at]
        inside = (i < n) & (j < n) & (length[at] < most)
        at, i, j = at[inside], i[inside], j[inside]
        at = at[text[i] == text[j]]
        length[at] += 1
    return before, length
