"""Plain-Python results that the operators are compared with, and a table of awkward rows."""

import hashlib
import re
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 70} x{i}" for i in range(3000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
AWKWARD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, None), (4, "one", "en", "a"),
    (5, "One", "en", "b"), (6, "one two", "en", "b"), (7, "ONE two", None, "b"), (8, LONG, "fr", "a"),
    (9, LONG + " tail", "fr", "a"), (10, LONG, "fr", None), (10, LONG, "fr", None), (None, LONG, "en", "a"),
    (None, None, None, None), (11, "12345 !!! ---", "en", "a"), (12, "é " * 400, "fr", "b"),
    (13, "lead " + PASSAGE + " alpha", "en", "a"), (14, "other start " + PASSAGE, "en", "b"),
    (15, "same " * 300, "en", "a"), (-3, PASSAGE + "\n\n" + PASSAGE, "en", "b"), (16, "x" * 70000, "en", "a"),
    (17, "nul\x00 byte \x1c ctrl \x85 nel", "en", "a"), (18, "<|endoftext|> it's 'llama's", "en", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def words(text):
    return WORD.findall(text or "")


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, size):
    own = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(own) < size:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[i:i + size]) for i in range(len(own) - size + 1))


def near_duplicates(rows, size):
    sets = {d: shingles(t, size) for d, t in rows if d is not None}
    index = {}
    for d, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(d)
    links = []
    for d, s in sets.items():
        for other, common in Counter(o for x in s for o in index[x] if o < d).items():
            if 100 * common >= 80 * (len(s) + len(sets[other]) - common):
                links.append((d, other))
    found = components(sets, links)
    return {d: (len(sets[d]), found[d]) for d in sets}


def repeated_windows(rows, size=50):
    first = {}
    for d, t in rows:
        own = words(t)
        for i in range(len(own) - size + 1):
            key = tuple(own[i:i + size])
            if d is not None:
                first[key] = min(d, first.get(key, d))
    out = []
    for d, t in rows:
        own = words(t)
        gone = [False] * len(own)
        for i in range(len(own) - size + 1):
            if d is not None and first[tuple(own[i:i + size])] < d:
                gone[i:i + size] = [True] * size
        out.append((d, len(own), sum(gone), " ".join(w for w, g in zip(own, gone) if not g)))
    return out


def byte_repeats(rows, size=200):
    raws = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(hashlib.md5(b[i:i + size]).digest() for _, b in raws for i in range(len(b) - size + 1))
    out = []
    for d, b in raws:
        steps = np.zeros(len(b) + 1, int)
        for i in range(len(b) - size + 1):
            if seen[hashlib.md5(b[i:i + size]).digest()] > 1:
                steps[i] += 1
                steps[i + size] -= 1
        gone = np.cumsum(steps)[:-1] > 0
        out.append((d, len(b), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()),
                    bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out
