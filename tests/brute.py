"""Plain-Python truths for small inputs."""

from itertools import combinations


def baskets_of(lines):
    out = {}
    for basket, item in lines:
        out.setdefault(basket, set()).add(item)
    return out


def supports(lines, max_k=None):
    """{sorted tuple: count} of every set that occurs at all."""
    counts = {}
    for items in baskets_of(lines).values():
        for k in range(1, (max_k or len(items)) + 1):
            for s in combinations(sorted(items), k):
                counts[s] = counts.get(s, 0) + 1
    return counts


def frequent(lines, min_count, max_k=None):
    return {s: c for s, c in supports(lines, max_k).items() if c >= min_count}


def rules(lines, min_count, levels=None):
    """{(antecedent, consequent): (support, confidence, lift)}"""
    n = len(baskets_of(lines))
    sets = frequent(lines, min_count)
    out = {}
    for whole, count in sets.items():
        if len(whole) < 2 or (levels and len(whole) not in levels):
            continue
        for r in range(1, len(whole)):
            for left in combinations(whole, r):
                right = tuple(i for i in whole if i not in left)
                support = count / n
                confidence = support / (sets[left] / n)
                out[left, right] = support, confidence, confidence / (sets[right] / n)
    return out
