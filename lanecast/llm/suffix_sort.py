"""Suffix sorting by linear grouping, after Lyndon prefixes."""

from __future__ import annotations

from collections import Counter


def suffix_order(text: list[int]) -> list[int]:
    """The starts of all suffixes of ``text`` (numbers from 0 on) in lexicographic order; a prefix comes before its extensions.

    First grouping: suffixes start out grouped by their first sign, and groups are taken from the highest to the lowest. The nearest
    position to the left that is in a lower group is a suffix's previous smaller one; its own prefix
    grows by that of the suffix, so it moves to a group right after its former one, the further the more
    suffixes of the taken group it precedes. At the end a group holds the suffixes that share their longest
    Lyndon prefix. Then emitting: a suffix follows its Lyndon prefix with the next smaller suffix, so taking suffixes
    in final order and giving out those that they end, in their groups, orders each group. Nothing is renamed or sorted again.
    """
    signs = [sign + 1 for sign in text] + [0]
    size = len(signs)
    order = sorted(range(size), key=signs.__getitem__)
    place, group, last = [0] * size, [0] * size, [0] * size
    start = 0
    for at, position in enumerate(order):
        if at and signs[position] != signs[order[at - 1]]:
            start = at
        place[position], group[position], last[start] = at, start, at
    smaller = [-1] * size

    end = size - 1
    while end >= 0:
        start = group[order[end]]
        if start == end:
            # a group of one
            suffix = order[end]
            left = suffix - 1
            while left >= 0 and group[left] >= start:
                left = smaller[left]
            smaller[suffix] = left
            if left >= 0:
                _move([left], order, place, group, last)
        else:
            before = []
            for suffix in sorted(order[start : end + 1]):
                left = suffix - 1
                while left >= 0 and group[left] >= start:
                    left = smaller[left]
                smaller[suffix] = left
                if left >= 0:
                    before.append(left)
            times = Counter(before)
            if len(times) == len(before):
                _move(before, order, place, group, last)
            else:
                by_count: dict[int, list[int]] = {}
                for position, count in times.items():
                    by_count.setdefault(count, []).append(position)
                for count in sorted(by_count, reverse=True):
                    _move(by_count[count], order, place, group, last)
        end = start - 1

    free = list(range(size))  # next place of a group, by its start
    placed = [False] * size
    result = [0] * size
    result[0] = size - 1
    placed[size - 1] = True
    for at in range(size):
        position = result[at] - 1
        while position >= 0 and not placed[position]:
            start = group[position]
            result[free[start]] = position
            free[start] += 1
            placed[position] = True
            position = smaller[position]
    return result[1:]


def _move(positions: list[int], order: list[int], place: list[int], group: list[int], last: list[int]) -> None:
    """Split ``positions`` off the upper end of their groups; those of one group stay together in a new one."""
    ends: dict[int, int] = {}
    for position in positions:
        start = group[position]
        end = last[start]
        if start not in ends:
            ends[start] = end
        other, spot = order[end], place[position]
        order[spot], place[other] = other, spot
        order[end], place[position] = position, end
        last[start] = end - 1
    for position in positions:
        start = group[position]
        fresh = last[start] + 1
        if fresh != start:
            group[position] = fresh
    for start, end in ends.items():
        fresh = last[start] + 1
        last[fresh] = end
