"""Plain reference versions of the operators, for small tables."""

import collections
import itertools
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def shingles(s):
    w = WORD.findall(lower(s))
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def near_classes(docs, threshold=0.8):
    """First row number of the class of each ``(doc_id, text)``."""
    sets = [shingles(t) for _, t in docs]
    group = list(range(len(docs)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in itertools.combinations(range(len(docs)), 2):
        union = sum((sets[a] | sets[b]).values())
        same = (docs[a][1] or "") == (docs[b][1] or "")
        if same or union and sum((sets[a] & sets[b]).values()) / union >= threshold:
            x, y = sorted((find(a), find(b)))
            group[y] = x
    return [find(i) for i in range(len(docs))]


def removed_lines(docs):
    """Removed line numbers of each of the ``(doc_id, text)`` rows, in order of place."""
    seen, out = [], []
    for _, text in docs:
        gone = set()
        for k, line in enumerate((text or "").split("\n")):
            s = frozenset(line.lower().split())
            if not s:
                continue
            if any(5 * len(s & t) >= 4 * len(s | t) for t in seen):
                gone.add(k)
            seen.append(s)
        out.append(gone)
    return out


def contamination(docs, items, window=10):
    wins = collections.defaultdict(set)
    for item, text in items:
        w = WORD.findall(lower(text))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins[tuple(w[i:i + n])].add(item)
    out = []
    for doc, text in docs:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                for item in wins.get(tuple(w[i:i + n]), ()):
                    hit.update(range(i, i + n))
                    found.add(item)
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out
