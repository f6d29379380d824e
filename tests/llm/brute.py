"""Plain versions of the operators for small inputs."""

import hashlib
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def components(links, names):
    parent = {n: n for n in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in names}


def shingles(text, width=5):
    own = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not own:
        return set()
    return {tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1))}


def near(rows, percent=75):
    """{doc_id: (n_shingles, component_id)}"""
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    at = {}
    for i in ids:
        for s in sets[i]:
            at.setdefault(s, []).append(i)
    met = Counter()
    for group in at.values():
        for k, a in enumerate(group):
            for b in group[k + 1 :]:
                met[a, b] += 1
    links = [(a, b) for (a, b), n in met.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    comps = components(links, ids)
    return {i: (len(sets[i]), comps[i]) for i in ids}


def repeats(rows, window=35):
    """[(doc_id, n_words, n_removed, sha)]"""
    split = [(i, words(t)) for i, t in rows]
    seen = Counter(tuple(w[k : k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def line_sets(line, width=6):
    raw = line.encode()
    return {raw[i : i + width] for i in range(max(1, len(raw) - width + 1))}


def fuzzy_lines(rows, percent=75, min_bytes=32):
    """{(doc_id, line): (first_key, first_line)}"""
    lines = {}
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            if words(line):
                lines[i, k] = line
    items = sorted(set(lines.values()))
    sets = {x: line_sets(x) for x in items}
    links = []
    for k, a in enumerate(items):
        for b in items[k + 1 :]:
            if min(len(a.encode()), len(b.encode())) < min_bytes:
                continue
            if min(len(sets[a]), len(sets[b])) * 100 < percent * max(len(sets[a]), len(sets[b])):
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    group = components(links, items)
    first = {}
    for place in sorted(lines):
        first.setdefault(group[lines[place]], place)
    return {place: first[group[line]] for place, line in lines.items()}
