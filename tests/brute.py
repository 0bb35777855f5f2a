"""Plain Python definitions of the results, for small inputs."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

PRIME = 4294967311


def normalize(text):
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", text.lower())).strip()


def shingle_set(text, k):
    clean = normalize(text)
    return {zlib.crc32(clean[i : i + k].encode()) for i in range(len(clean) - k + 1)}


def jaccard(s, t):
    return len(s & t) / len(s | t) if s | t else 1.0


def similar(sets, threshold):
    pairs = itertools.combinations(sorted(sets), 2)
    return {(x, y) for x, y in pairs if jaccard(sets[x], sets[y]) >= threshold}


def signature(shingles, n):
    rng = random.Random(42)
    family = []
    for _ in range(n):
        a = rng.randint(1, PRIME - 1)
        family.append((a, rng.randint(0, PRIME - 1)))
    return [min(((a * x + b) % PRIME for x in shingles), default=float("inf")) for a, b in family]


def candidates(signatures, bands, rows, key):
    found = set()
    for band in range(bands):
        buckets = defaultdict(list)
        for doc, sig in signatures.items():
            buckets[key(tuple(sig[band * rows : (band + 1) * rows]))].append(doc)
        for docs in buckets.values():
            found.update(itertools.combinations(sorted(docs), 2))
    return found


def frequent(baskets, min_count):
    counts = Counter()
    for basket in baskets:
        items = sorted(set(basket))
        for k in range(1, len(items) + 1):
            counts.update(itertools.combinations(items, k))
    return {items: n for items, n in counts.items() if n >= min_count}


def rules(sets, n_baskets, min_confidence):
    found = {}
    for items, cnt in sets.items():
        for size in range(1, len(items)):
            for consequent in itertools.combinations(items, size):
                antecedent = tuple(i for i in items if i not in consequent)
                confidence = cnt / sets[antecedent]
                if confidence >= min_confidence:
                    found[antecedent, consequent] = (
                        cnt,
                        confidence,
                        confidence / (sets[consequent] / n_baskets),
                    )
    return found


def triangles(edges):
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    return sum(len(near[a] & near[b]) for a, b in edges) // 3


def estimate(edges, size, accept, slot):
    """Replay of the stream, one edge at a time, with given draws."""
    places, near, total, gains = {}, defaultdict(set), 0.0, []
    for t, (a, b) in enumerate(edges, 1):
        weight = 1.0 if t <= size else (t - 1) * (t - 2) / (size * (size - 1))
        total += weight * len(near[a] & near[b])
        gains.append(total)
        if t <= size:
            place = t - 1
        elif accept(t) < size / t:
            place = int(slot(t) * size)
            x, y = places[place]
            near[x].discard(y)
            near[y].discard(x)
        else:
            continue
        places[place] = (a, b)
        near[a].add(b)
        near[b].add(a)
    return total, places, gains
