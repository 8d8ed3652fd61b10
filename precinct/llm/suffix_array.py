"""Suffix arrays by linear grouping: suffixes are grouped by their Lyndon prefixes, then put in order group by group."""

from __future__ import annotations

import numpy as np


def lyndon_groups(text: list[int]) -> tuple[list[int], list[int]]:
    """The group of each suffix, named by its first place in the suffix array, and its previous smaller suffix.

    Groups begin as the suffixes with one first symbol and are worked off in descending order. A suffix of the current
    group extends the prefix of the nearest suffix before it that is in a lower group. Suffixes that were extended
    move behind the rest of their group; those extended more often move further. A group that is being worked off
    holds the suffixes with one Lyndon prefix, and what was found as nearest lower suffix is the previous smaller one.
    """
    n = len(text)
    group = [0] * n
    members: dict[int, list[int]] = {}
    by_symbol: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        by_symbol.setdefault(symbol, []).append(i)
    size = [0] * n
    first_of_last = [0] * n  # by the last place of a group: its first place
    at = 0
    for symbol in sorted(by_symbol):
        own = by_symbol[symbol]
        members[at] = own
        size[at] = len(own)
        first_of_last[at + len(own) - 1] = at
        for i in own:
            group[i] = at
        at += len(own)
    before = [-1] * n
    last = n - 1
    while last >= 0:
        start = first_of_last[last]
        own = members.pop(start)
        if size[start] > 1 or len(own) > 1:
            own = sorted(i for i in own if group[i] == start)
        times: dict[int, int] = {}
        for i in own:
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        if len(times) == 1:
            (p,) = times
            g = group[p]
            rest = size[g] - 1
            if rest:
                end = g + rest
                size[g], size[end] = rest, 1
                first_of_last[end] = end
                first_of_last[end - 1] = g
                group[p] = end
                members[end] = [p]
        elif times:
            moves: dict[tuple[int, int], list[int]] = {}
            for p, k in times.items():
                moves.setdefault((-k, group[p]), []).append(p)
            # Those with the most extensions go to the very end, the next ones before them.
            for (_, g), moved in sorted(moves.items()):
                rest = size[g] - len(moved)
                if not rest:
                    continue
                end = g + rest
                size[g], size[end] = rest, len(moved)
                first_of_last[end + len(moved) - 1] = end
                first_of_last[end - 1] = g
                for p in moved:
                    group[p] = end
                members[end] = moved
        last = start - 1
    return group, before


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The suffixes of ``symbols`` (non-negative integers) in ascending order, in linear time.

    A closing symbol below all others is put behind the text. Each suffix, taken in ascending order, settles the suffixes
    whose next smaller suffix it is: the one before it and those on its chain of previous smaller suffixes; each
    of them takes the next place of its group. Nothing is renamed and there is no recursion.
    """
    text = (np.asarray(symbols, np.int64) + 1).tolist()
    text.append(0)
    n = len(text)
    place, before = lyndon_groups(text)
    free = list(range(n))  # by the first place of a group: its next free place
    out = [0] * n
    out[0] = n - 1
    done = bytearray(n)
    done[n - 1] = 1
    for k in range(n):
        i = out[k] - 1
        while i >= 0 and not done[i]:
            done[i] = 1
            g = place[i]
            out[free[g]] = i
            free[g] += 1
            i = before[i]
    return np.array(out[1:], np.int64)
