"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, width=3):
    own = words(text)
    if len(own) < width:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + width]) for i in range(len(own) - width + 1)}


def connected(nodes, links):
    """The smallest node each node is connected with."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def similar_pairs(rows, percent=90, width=3):
    """Pairs of row numbers of [(doc_id, text)] that reach the similarity."""
    sets = [shingles(t, width) if d is not None else set() for d, t in rows]
    return [
        (i, j)
        for i in range(len(rows))
        for j in range(i + 1, len(rows))
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]


def ngram_join(rows, percent=90, width=3):
    """Counter of (doc_id, n_shingles, component_id, n_links)."""
    pairs = similar_pairs(rows, percent, width)
    component = connected({d for d, _ in rows if d is not None}, [(rows[i][0], rows[j][0]) for i, j in pairs])
    links = Counter(k for pair in pairs for k in pair)
    return Counter((d, len(shingles(t, width)), component.get(d), links[k]) for k, (d, t) in enumerate(rows))


def shared_lines(texts, min_docs=10):
    """For each text (n_lines, n_dropped, kept text)."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    split = [(t or "").split("\n") for t in texts]
    found = defaultdict(int)
    for own in split:
        for k in {key(line) for line in own} - {""}:
            found[k] += 1
    bad = {k for k, n in found.items() if n >= min_docs}
    kept = [[line for line in own if key(line) not in bad] for own in split]
    return [(len(a), len(a) - len(b), "\n".join(b)) for a, b in zip(split, kept)]
