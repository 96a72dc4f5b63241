"""What the operators must return, computed the plain way from lists of (id, text)."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def low(text):
    return (text or "").translate(_LOW)


def repeated_bytes(docs, length=50):
    """Per row: n_bytes, n_removed, n_spans, kept_sha256, kept bytes. Null ids come last."""
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            first[s] = min(first.get(s, math.inf), math.inf if i is None else i)
    out = []
    for i, t in docs:
        b = (t or "").encode()
        own = math.inf if i is None else i
        cover = [False] * len(b)
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < own:
                cover[k : k + length] = [True] * length
        kept = bytes(x for x, c in zip(b, cover) if not c)
        spans = sum(c and not (k and cover[k - 1]) for k, c in enumerate(cover))
        out.append((i, len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def shingles(text, k=5):
    w = WORD.findall(low(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near_components(docs):
    """Per row: id, n_shingles, component id."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for r, s in enumerate(sets):
        for x in s:
            holders[x].append(r)
    both = Counter((a, b) for rows in holders.values() for n, b in enumerate(rows) for a in rows[:n])
    for (a, b), n in both.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    least = {}
    for r, (i, _) in enumerate(docs):
        if i is not None:
            least[root(r)] = min(i, least.get(root(r), i))
    return [(i, len(s), least.get(root(r)) if s else i) for r, ((i, _), s) in enumerate(zip(docs, sets))]


def language_model(docs, prior):
    """Per row: id, held out, tokens, known tokens, N, base score, score."""
    start, end = ("start",), ("end",)
    tokens = [[*WORD.findall(low(t)), end] for _, t in docs]
    held = [i is None or zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    one, two = Counter(), Counter()
    for own, out in zip(tokens, held):
        if not out:
            one.update(own)
            one[start] += 1
            two.update(zip([start, *own], own))
    total = sum(one.values()) - one[start]
    size = total + len([w for w in one if w != start]) + 1
    p = lambda w: (one[w] + 1) / size
    rows = []
    for (i, _), own, out in zip(docs, tokens, held):
        base = sum(math.log10(p(w)) for w in own)
        score = sum(math.log10((two[v, w] + prior * p(w)) / (one[v] + prior)) for v, w in zip([start, *own], own))
        rows.append((i, out, len(own), sum(one[w] > 0 for w in own), total, base, score))
    return rows


def rule_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    places = defaultdict(list)
    for k in range(len(w) - 2):
        places[tuple(w[k : k + 3])].append(k)
    again = {k + j for v in places.values() if len(v) > 1 for k in v for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)


def licenses(text):
    """n_words, n_base, first, last, base labels."""
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(text))
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    places, labels = [], set()
    for phrase, label in phrases.items():
        own = phrase.split()
        for k in range(len(w) - len(own) + 1):
            if w[k : k + len(own)] == own:
                places.append(k)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def weighted_jaccard(a, b):
    a, b = Counter(WORD.findall(a or "")), Counter(WORD.findall(b or ""))
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 1.0
