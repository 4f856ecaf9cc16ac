"""Plain versions of the operators, for small tables."""

import hashlib
from collections import Counter

import numpy as np
import regex
import xxhash

WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VISIBLE = regex.compile(r"[^\x20\x09-\x0D]+")


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is not None, str(x)) for x in r])


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def quality(text):
    text = text or ""
    words = VISIBLE.findall(text)
    lines = [x for x in text.split("\n") if VISIBLE.search(x)]
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for v in places.values() if len(v) > 1 for i in v for k in range(5)}
    counts = (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )
    return (*counts, len(words) < 10 or 100 * len(covered) > 20 * len(words))


def contamination(docs, items):
    windows = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        size = min(10, len(words))
        for s in range(len(words) - size + 1) if size else ():
            windows.setdefault(tuple(words[s : s + size]), set()).add(item)
    out = []
    for doc, text in docs:
        words, hit, found = WORD.findall(lower(text)), set(), set()
        for size in {len(w) for w in windows}:
            for s in range(len(words) - size + 1):
                if (w := tuple(words[s : s + size])) in windows:
                    hit |= set(range(s, s + size))
                    found |= windows[w]
        # Items without an id count as one, which the digest leaves out.
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(words), len(hit), len(found), sha(",".join(ids)), bool(hit)))
    return ordered(out)


def repeats(docs, length=200):
    texts = [(text or "").encode() for _, text in docs]
    times = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(docs, texts):
        gone = np.zeros(len(t) + 2, np.int8)
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                gone[i + 1 : i + length + 1] = 1
        rest = bytes(b for b, g in zip(t, gone[1:]) if not g)
        out.append((doc, len(t), int(gone.sum()), int((np.diff(gone) == 1).sum()), sha(rest)))
    return ordered(out)


def fingerprint(text, shingle=4):
    words = VISIBLE.findall(lower(text))
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    parts = [" ".join(words[i : i + shingle]) for i in range(n)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, distance=4):
    """A number of the component of each row of (id, fingerprint), by comparing all pairs."""
    n = len(prints)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    return [find(i) for i in range(n)]


def components(prints, distance=4):
    """Smallest id per row."""
    roots, least = classes(prints, distance), {}
    for r, (doc, _) in zip(roots, prints):
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return [least.get(r) for r in roots]
