"""Suffix arrays by linear grouping: Lyndon-prefix groups first, their inner order afterwards."""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in ascending order. The last symbol must be the smallest and occur once.

    Suffixes begin as groups by first symbol. The highest group not yet treated is taken: the nearest smaller
    suffix before each member (found by following earlier such pointers) has the group's common prefix as the
    next part of its own Lyndon prefix, so those suffixes leave their groups for new, higher ones, by how many
    members point at them. When every group has been treated, its members share their Lyndon prefix, and a walk
    through the array in ascending order puts each suffix into the next place of its group.
    """
    group, members, below, above = _by_symbol(text)
    earlier, treated, descending = [-1] * len(text), [False] * len(text), []
    top = len(members) - 1
    while top >= 0:
        descending.append(top)
        rows = sorted(members[top])
        pointed: dict[int, int] = {}
        for row in rows:
            before = row - 1
            while before >= 0 and treated[before]:
                before = earlier[before]
            if before >= 0 and group[before] == top:
                before = earlier[before]
            earlier[row] = before
            if before >= 0:
                pointed[before] = pointed.get(before, 0) + 1
        for row in rows:
            treated[row] = True
        _leave(pointed, group, members, below, above)
        top = below[top]
    return _ordered(len(text), group, members, earlier, descending)


def _by_symbol(text: Sequence[int]) -> tuple[list[int], list[set[int]], list[int], list[int]]:
    """Group of each suffix, members of each group, and the groups next below and above (-1: none)."""
    rank = {symbol: place for place, symbol in enumerate(sorted(set(text)))}
    group = [rank[symbol] for symbol in text]
    members: list[set[int]] = [set() for _ in rank]
    for row, place in enumerate(group):
        members[place].add(row)
    count = len(members)
    return group, members, list(range(-1, count - 1)), [*range(1, count), -1]


def _leave(pointed: dict[int, int], group: list[int], members: list[set[int]], below: list[int], above: list[int]) -> None:
    """Moves suffixes pointed at more often to higher new groups directly above their old one."""
    leaving: dict[int, dict[int, list[int]]] = {}
    for row, times in pointed.items():
        leaving.setdefault(group[row], {}).setdefault(times, []).append(row)
    for old, by_times in leaving.items():
        times = sorted(by_times)
        if sum(map(len, by_times.values())) == len(members[old]):
            times = times[1:]  # nobody stays behind, so the lowest keep the old group
        last = old
        for count in times:
            new, rows = len(members), by_times[count]
            members.append(set(rows))
            members[old].difference_update(rows)
            for row in rows:
                group[row] = new
            higher = above[last]
            below.append(last)
            above.append(higher)
            above[last] = new
            if higher >= 0:
                below[higher] = new
            last = new


def _ordered(size: int, group: list[int], members: list[set[int]], earlier: list[int], descending: list[int]) -> list[int]:
    free, start = [0] * len(members), 0
    for place in reversed(descending):
        free[place] = start
        start += len(members[place])
    order, placed = [-1] * size, [False] * size
    order[0] = size - 1
    placed[size - 1] = True
    for at in range(size):
        row = order[at] - 1
        while row >= 0 and not placed[row]:
            order[free[group[row]]] = row
            free[group[row]] += 1
            placed[row] = True
            row = earlier[row]
    return order
