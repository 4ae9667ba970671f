"""Plain versions of what the operators work out, for small tables."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate(LOWER)


def repeated_words(w, size=8):
    seen = defaultdict(list)
    for i in range(len(w) - size + 1):
        seen[tuple(w[i : i + size])].append(i)
    return len({j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + size)})


def shingles(text, width):
    w = words(lower(text))
    if not w:
        return frozenset()
    n = min(width, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def components(sets, percent):
    """Smallest id reachable, by id, over links of at least ``percent`` similarity; sets: list of (id, set)."""
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            common = len(s & t)
            if s and t and 100 * common >= percent * (len(s) + len(t) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: find(d) for d in parent}


def best_capacity(sizes, shards):
    """Least capacity for which a greedy walk needs no more than ``shards`` shards, and its cuts by group."""

    def walk(c):
        cuts, used, n = [], 0, 1
        for i, s in enumerate(sizes):
            if used + s > c:
                cuts.append(i)
                used, n = 0, n + 1
            used += s
        return n, cuts

    low, high = max(sizes) - 1, sum(sizes)
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if walk(mid)[0] <= shards else (mid, high)
    return high, walk(high)[1]


def water(totals, weights, share=1.5, most=2):
    """Targets by source: shares by weight, none above ``most`` times its size."""
    budget, full = share * sum(totals.values()), set()
    while True:
        left = budget - sum(most * totals[s] for s in full)
        open_weight = sum(weights[s] for s in totals if s not in full)
        level = left / open_weight if open_weight else 0
        more = {s for s in totals if s not in full and level * weights[s] > most * totals[s]}
        if not more:
            return {s: most * totals[s] if s in full else level * weights[s] for s in totals}
        full |= more


def counted(values):
    return Counter(values)
