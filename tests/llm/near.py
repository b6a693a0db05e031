"""Near copies in plain Python: Jaccard of five-word shingles, all pairs."""

from __future__ import annotations


def shingles(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def near(a: frozenset, b: frozenset) -> bool:
    both = len(a & b)
    return min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and \
        both >= 0.8 * (len(a) + len(b) - both)


def near_survivors(texts: dict) -> set:
    """Ids of which one, the smallest, stays of each group."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sorted(sets)}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = list(root)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if near(sets[i], sets[j]):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {top(i) for i in ids}
