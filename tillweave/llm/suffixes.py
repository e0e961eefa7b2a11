"""Linear suffix sorting by grouping, for many strings side by side.

The construction has two phases and no recursion and no renaming of symbols.

Phase 1 sorts all suffixes into groups of equal Lyndon prefix. Groups start as the suffixes of one first symbol and are
processed from the highest to the lowest. For each suffix of a group, its previous-smaller pointer leads to the nearest suffix
before it in a lower group. The suffixes pointed to by the group have a longer prefix in common than was known: they leave
their old groups, those that are pointed to by more suffixes of the group last, into new groups right behind.

Phase 2 emits the order. The last suffix is the smallest. Going up the order, the suffix before each emitted one, and
then whatever its previous-smaller pointers lead to, takes the next free place of its group, until a suffix that has its place.

Every string is a lane; a step handles one group (phase 1) or one suffix (phase 2) of every lane at once, so the work is linear in the
symbols and Python's share of it is per step, not per symbol. All arrays are flat; a lane's strings, ranks and groups lie between its bounds.
"""

from __future__ import annotations

import numpy as np


def suffix_orders(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Suffix arrays of the strings ``symbols[bounds[i]:bounds[i + 1]]`` as places in ``symbols``, lane after lane.

    The last symbol of each string must be smaller than all its others.
    """
    group, pointer = grouped(symbols, bounds)
    return emitted(group, pointer, bounds)


def grouped(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1: for each suffix the rank at which its group starts, and its previous-smaller pointer (-1: none)."""
    total = len(symbols)
    lengths = np.diff(bounds)
    lane = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((symbols, lane))
    rank = np.empty(total, dtype=np.int64)
    rank[order] = np.arange(total)
    # A group is named by the rank at which it starts; ``size`` is kept at that rank.
    opens = np.ones(total, dtype=bool)
    opens[1:] = (symbols[order[1:]] != symbols[order[:-1]]) | (lane[order[1:]] != lane[order[:-1]])
    firsts = np.flatnonzero(opens)
    group = np.empty(total, dtype=np.int64)
    size = np.zeros(total, dtype=np.int64)
    size[firsts] = np.diff(firsts, append=total)
    group[order] = np.repeat(firsts, size[firsts])
    low = bounds[lane] if total else bounds[:0]
    # Where to look next when searching back: the place before, once known the previous-smaller pointer.
    pointer = np.where(np.arange(total) > low, np.arange(total) - 1, -1)
    count = np.zeros(total, dtype=np.int64)
    moved = np.zeros(total, dtype=bool)

    ends = bounds[1:].copy()  # rank behind the group that each lane has reached
    open_lanes = np.flatnonzero(ends > bounds[:-1])
    while len(open_lanes):
        tops = order[ends[open_lanes] - 1]
        starts = group[tops]
        sizes = size[starts]
        # All suffixes of the groups, and the nearest suffix before each that lies in a lower group. Most groups hold one
        # suffix; they come first and need no counting below.
        alone = sizes == 1
        members, own = tops[alone], starts[alone]
        singles = len(members)
        if singles < len(tops):
            heads, sizes = starts[~alone], sizes[~alone]
            members = np.concatenate((members, order[np.repeat(heads, sizes) + ramp(sizes)]))
            own = np.concatenate((own, np.repeat(heads, sizes)))
        found = pointer[members]
        search = np.flatnonzero(found >= 0)
        search = search[group[found[search]] >= own[search]]
        while len(search):
            step = pointer[found[search]]
            found[search] = step
            search = search[step >= 0]
            search = search[group[found[search]] >= own[search]]
        pointer[members] = found
        ends[open_lanes] = starts
        open_lanes = open_lanes[starts > bounds[open_lanes]]
        pointed = found[:singles]
        pointed = pointed[pointed >= 0]  # lanes share no groups, so each is moved on its own
        if len(pointed):
            regroup(pointed, group[pointed], None, order, rank, group, size, moved)
        pointed = found[singles:]
        pointed = pointed[pointed >= 0]
        if len(pointed):
            np.add.at(count, pointed, 1)
            pointed = np.unique(pointed)
            old, times = group[pointed], count[pointed]
            count[pointed] = 0
            by = np.lexsort((-times, old))
            regroup(pointed[by], old[by], times[by], order, rank, group, size, moved)
    return group, pointer


def ramp(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for every size, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def regroup(pointed, old, times, order, rank, group, size, moved) -> None:
    """Move ``pointed`` (sorted by group, most pointed-to first) to new groups at the end of their old ones."""
    if times is None:  # one suffix of each group changes places with the last of it
        target = old + size[old] - 1
        place = rank[pointed]
        standing = order[target]
        order[place], rank[standing] = standing, place
        order[target], rank[pointed] = pointed, target
        size[old] -= 1
        size[target] = 1
        group[pointed] = target
        return
    first = np.ones(len(old), dtype=bool)
    first[1:] = old[1:] != old[:-1]
    begins = np.flatnonzero(first)
    leaving = np.diff(begins, append=len(old))
    heads = old[begins]
    place = ramp(leaving)
    target = old + size[old] - 1 - place
    cut = first.copy()
    cut[1:] |= times[1:] != times[:-1]
    runs = np.flatnonzero(cut)
    new_sizes = np.diff(runs, append=len(old))
    new_heads = target[runs + new_sizes - 1]
    new_start = np.repeat(new_heads, new_sizes)
    # Whoever stands in a place at the end without moving swaps with a mover from further ahead; both lists are in
    # the order of the groups and equally long in each.
    moved[pointed] = True
    standing = order[target]
    stay = standing[~moved[standing]]
    tail = np.repeat(heads + size[heads] - leaving, leaving)
    vacated = rank[pointed][rank[pointed] < tail]
    order[vacated] = stay
    rank[stay] = vacated
    order[target] = pointed
    rank[pointed] = target
    moved[pointed] = False
    size[heads] -= leaving
    size[new_heads] = new_sizes  # a group that is left by all its members keeps its start and its size
    group[pointed] = new_start


def emitted(group: np.ndarray, pointer: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Phase 2: the suffix array of every lane."""
    result = np.full(len(group), -1, dtype=np.int64)
    free = np.arange(len(group))  # next free rank of the group that starts here
    placed = np.zeros(len(group), dtype=bool)
    lanes = np.flatnonzero(np.diff(bounds) > 0)
    at = bounds[lanes].copy()
    last = bounds[lanes + 1]
    low = bounds[lanes]
    result[at] = last - 1
    placed[last - 1] = True
    free[group[last - 1]] += 1
    current = last - 2
    while len(at):
        runs = (current >= low) & ~placed[np.maximum(current, 0)]
        go = current[runs]
        spot = free[group[go]]
        free[group[go]] = spot + 1
        result[spot] = go
        placed[go] = True
        current[runs] = pointer[go]
        stop = np.flatnonzero(~runs)
        at[stop] += 1
        live = at < last
        stop = stop[live[stop]]
        current[stop] = result[at[stop]] - 1
        if not live.all():
            at, last, low, current = at[live], last[live], low[live], current[live]
    return result
