"""Plain versions of the corpus operators, for small inputs."""

import hashlib
from collections import Counter

GAPS = " \t\n\x0b\x0c\r"


def words(text):
    return (text or "").encode().split()


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def components(rows, width, percent):
    """Component (a set of row numbers) of each row with a set."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    return sets, [find(i) for i in range(len(rows))]


def passages(texts, span):
    """(n_bytes, n_removed, n_spans, kept bytes) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + span] for b in raw for i in range(len(b) - span + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = [True] * span
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def base_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of the quality rules."""
    import re

    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            hit.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()
