"""Plain versions of the operators, one document at a time."""

import hashlib
import re

BLANK = re.compile(rb"[^\x20\x09-\x0D]+")
PLAIN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(parts) -> str:
    return hashlib.sha256(parts).hexdigest()


def components(docs, size, percent):
    """doc_id -> (number of shingles, smallest reachable doc_id)."""
    sets = {}
    for doc_id, text in docs:
        w = BLANK.findall((text or "").encode().lower())
        runs = [tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
        sets[doc_id] = set(runs)
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def repeats(docs, window):
    """doc_id -> (words, indexes of words in windows that began earlier)."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda r: r[0]):
        w = BLANK.findall((text or "").encode())
        gone = set()
        for i in range(len(w) - window + 1):
            run = tuple(w[i : i + window])
            if run in seen:
                gone.update(range(i, i + window))
            seen.add(run)
        out[doc_id] = (w, gone)
    return out


def hits(docs, items, window=13):
    """doc_id -> (words, hit indexes, item names)."""
    runs = {}
    for item, text in items:
        w = PLAIN.findall((text or "").encode().lower())
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            runs.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = {}
    for doc_id, text in docs:
        w = PLAIN.findall((text or "").encode().lower())
        hit, names = set(), set()
        for n in {len(r) for r in runs}:
            for i in range(len(w) - n + 1):
                found = runs.get(tuple(w[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    names |= found
        out[doc_id] = (len(w), hit, names)
    return out
