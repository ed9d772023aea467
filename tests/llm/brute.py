"""Plain versions of the operators, for tables small enough to look at every pair."""

import hashlib
import re
import unicodedata
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def unite(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def runs_of(gone):
    return sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))


def substrings(rows, span=50):
    """(id, bytes, removed, runs, kept hash) of each (id, text)."""
    first = {}
    for key, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - span + 1):
            s = raw[i : i + span]
            if key is not None:
                first[s] = min(first.get(s, key), key)
    out = []
    for key, text in rows:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - span + 1):
            if key is not None and first[raw[i : i + span]] < key:
                gone[i : i + span] = [True] * span
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((key, len(raw), sum(gone), runs_of(gone), sha(kept)))
    return out


def passages(rows, span=20):
    """(id, words, removed, kept hash) of each (id, text)."""
    first = {}
    for key, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - span + 1):
            s = tuple(words[i : i + span])
            if key is not None:
                first[s] = min(first.get(s, (key, i)), (key, i))
    out = []
    for key, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - span + 1):
            if key is not None and first[tuple(words[i : i + span])] < (key, i):
                gone[i : i + span] = [True] * span
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((key, len(words), sum(gone), sha(kept)))
    return out


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows, radius=4):
    """(id, fingerprint, component) of each (id, text)."""
    prints = [fingerprint(t) for _, t in rows]
    sets = Sets()
    for i, (key, _) in enumerate(rows):
        for j in range(i):
            other = rows[j][0]
            if None not in (key, other) and (prints[i] ^ prints[j]).bit_count() <= radius:
                sets.unite(key, other)
    return [(k, f"{p:016x}", None if k is None else sets.find(k)) for (k, _), p in zip(rows, prints, strict=True)]


def vectors(rows, threshold=0.93):
    """(id, links, component, kept) of each (id, vector, label)."""
    def usable(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [i for i, (_, v, label) in enumerate(rows) if usable(v, label)]
    links, sets = [0] * len(rows), Sets()
    for a, i in enumerate(good):
        for j in good[:a]:
            (x, u, m), (y, v, n) = rows[i], rows[j]
            if m != n or len(u) != len(v):
                continue
            u, v = np.array(u, np.float32).astype(float), np.array(v, np.float32).astype(float)
            if u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= threshold:
                links[i] += 1
                links[j] += 1
                if None not in (x, y):
                    sets.unite(x, y)
    out = []
    for (key, _, _), n in zip(rows, links, strict=True):
        root = None if key is None else sets.find(key)
        out.append((key, n, root, key is not None and root == key))
    return out


def quality(text):
    """words, word chars, symbols, lines, equal lines, words in repeated windows."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines),
        len(lines) - len(set(lines)), len(inside),
    )


def tokens(path, texts, end=1):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [[*t.encode(x or "", add_special_tokens=False).ids, end] for x in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def has_letter(text):
    return any(unicodedata.category(c).startswith("L") for c in text or "")
