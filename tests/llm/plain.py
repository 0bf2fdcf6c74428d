"""Plain Python versions of what the operators have to find, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def contamination(texts, items, window=13):
    """{key: (n_words, n_hit, n_items, sha256, contaminated)} for {key: text} and (item_id, text) pairs."""
    held = defaultdict(set)
    for item, text in items:
        w = BENCH_WORD.findall((text or "").translate(LOWER))
        for s in range(max(1, len(w) - window + 1) if w else 0):
            held[tuple(w[s:s + window])].add(None if item is None else str(item))
    out = {}
    for key, text in texts.items():
        w = BENCH_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(k) for k in held}:
            for s in range(len(w) - n + 1):
                if (at := tuple(w[s:s + n])) in held:
                    hit.update(range(s, s + n))
                    found |= held[at]
        found = sorted(found - {None})
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        out[key] = (len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def groups(nodes, edges):
    """{node: smallest node of its component}."""
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {n: find(n) for n in nodes}


def near_duplicates(texts, words=5, percent=80):
    """{key: (n_shingles, component)}."""
    sets, holders = {}, defaultdict(list)
    for key, text in texts.items():
        w = WORD.findall((text or "").translate(LOWER))
        sets[key] = {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
        for s in sets[key]:
            holders[s].append(key)
    edges = []
    for key, own in sets.items():
        for other, n in Counter(o for s in own for o in holders[s] if o > key).items():
            if 100 * n >= percent * (len(own) + len(sets[other]) - n):
                edges.append((key, other))
    component = groups(sets, edges)
    return {k: (len(sets[k]), component[k]) for k in sets}
