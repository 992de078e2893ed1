"""Plain Python versions of the contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NONBLANK = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, width=13):
    """docs, items: (id, text).  Rows of the decontamination contract."""
    grams = defaultdict(set)
    for item, text in items:
        w = tuple(ALNUM.findall((text or "").translate(AZ)))
        n = min(width, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            grams[w[s:s + n]].add(item)
    out = []
    for doc, text in docs:
        w = tuple(ALNUM.findall((text or "").translate(AZ)))
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for s in range(len(w) - n + 1):
                own = grams.get(w[s:s + n])
                if own:
                    hit.update(range(s, s + n))
                    found |= own
        found = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(found), sha(",".join(found)),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def substrings(docs, width=50):
    first = {}
    words = [(d, NONBLANK.findall(t or "")) for d, t in docs]
    for d, w in words:
        for s in range(len(w) - width + 1):
            if d is not None:
                k = tuple(w[s:s + width])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for s in range(len(w) - width + 1):
            k = first.get(tuple(w[s:s + width]))
            if k is not None and (d is None or k < d):
                gone.update(range(s, s + width))
        out.append((d, len(w), len(gone), sha(" ".join(
            x for i, x in enumerate(w) if i not in gone))))
    return out


def shingle_set(text, width=5):
    w = NONBLANK.findall((text or "").translate(AZ))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def near_dups(docs, threshold=75):
    """docs: (id, text).  Candidates by a shared shingle, all of them compared."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in where[x]:
                if j < i:
                    common[j] += 1
        for j, c in common.items():
            if 100 * c >= threshold * (len(s) + len(sets[j]) - c):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = root(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    out = []
    for i, (d, _) in enumerate(docs):
        c = least.get(root(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return out
