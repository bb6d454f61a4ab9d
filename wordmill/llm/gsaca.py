"""Suffix array by grouping suffixes on their Lyndon prefixes (linear grouping).

Phase 1 gathers suffixes with the same longest Lyndon prefix. At first a suffix is
grouped by its first symbol. Groups are taken from the greatest to the least. A
member's previous smaller suffix lies in a lower group; the member's prefix is the
next factor of that suffix's own Lyndon prefix. So the previous smaller suffixes
move up, out of their group, by how many members point at them: more copies of a
great factor sort higher.

Phase 2 emits the order inside the groups without recursion or renaming. All
suffixes whose Lyndon prefix ends where suffix t starts lie on the chain of
previous smaller pointers from t - 1 to the one of t; when t is emitted, each of
them takes the next place of its group.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of ``text``, whose last symbol must be its only least one."""
    n = len(text)
    members: list[list[int]] = []
    group = [0] * n
    number = {c: g for g, c in enumerate(sorted(set(text)))}
    members = [[] for _ in number]
    for i, c in enumerate(text):
        g = number[c]
        group[i] = g
        members[g].append(i)
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    first = len(members)  # groups from here on are filled out of text order

    done = bytearray(n)
    prev = [-1] * n
    taken: list[tuple[int, int]] = []
    g = len(members) - 1
    while g >= 0:
        own = [s for s in members[g] if group[s] == g]
        if g >= first:
            own.sort()
        copies: dict[int, int] = {}
        for s in own:
            p = s - 1
            while p >= 0 and (done[p] or group[p] == g):
                p = prev[p]
            prev[s] = p
            if p >= 0:
                copies[p] = copies.get(p, 0) + 1
        for s in own:
            done[s] = 1
        taken.append((g, len(own)))
        moves: dict[int, dict[int, list[int]]] = {}
        for p, k in copies.items():
            moves.setdefault(group[p], {}).setdefault(k, []).append(p)
        for h, by_copies in moves.items():
            for k in sorted(by_copies, reverse=True):  # each goes right above h, below those of more copies
                new = len(members)
                members.append(by_copies[k])
                up = above[h]
                below.append(h)
                above.append(up)
                above[h] = new
                below[up] = new  # h is below g, so something is above it
                for p in by_copies[k]:
                    group[p] = new
        g = below[g]

    place = {}
    at = 0
    for g, size in reversed(taken):
        place[g] = at
        at += size
    order = [0] * n
    order[0] = n - 1
    for i in range(n):
        t = order[i]
        s, end = t - 1, prev[t]
        while s != end:
            h = group[s]
            order[place[h]] = s
            place[h] += 1
            s = prev[s]
    return order
