"""Plain versions of the text operators over lists of rows, for small inputs."""

import re
from collections import defaultdict

import duckdb

DATA = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"


def rows(sql):
    return duckdb.connect().execute(sql).fetchall()


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def shingles(text):
    words = [w for w in re.split(f"[{BLANK}]+", lower(text)) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def components(docs, percent):
    """doc_id -> (shingles, component) by comparing all pairs."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    for i, s in sets.items():
        for j in set().union(*(holders[x] for x in s)) if s else ():
            if j < i and 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def leaks(text, items, window=10):
    """(number of words, hit word places, ids of items with a window in the text)."""
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    found, hit, held = words(text), set(), set()
    for item, t in items:
        w = words(t)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            for i in range(len(found) - size + 1):
                if found[i:i + size] == w[k:k + size]:
                    hit |= set(range(i, i + size))
                    held.add(str(item))
    return len(found), hit, sorted(held)
