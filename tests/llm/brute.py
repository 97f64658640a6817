"""Plain Python statements of the contracts, for comparison on small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(ASCII_LOWER) if lower else text)


def shingles(text, k=5):
    w = words(text, lower=True)
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def near_groups(rows, percent, k=5):
    """doc_id -> (n_shingles, component_id); rows are (doc_id, text)."""
    sets = {d: shingles(t, k) for d, t in rows}
    least = {d: d for d in sets}

    def root(d):
        while least[d] != d:
            d = least[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                least[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def without_repeats(rows, length):
    """Per row: (bytes, removed, spans, kept bytes); a byte goes if a ``length``-byte string over it starts in two places."""
    data = [(t or "").encode() for _, t in rows]
    seen = {}
    for d in data:
        for p in range(len(d) - length + 1):
            seen[d[p : p + length]] = seen.get(d[p : p + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, bytes(c for c, g in zip(d, gone) if not g)))
    return out


def without_earlier(rows, length):
    """Per row: (words, removed, kept words); a word goes if a window over it starts in a document of a smaller doc_id."""
    least = {}
    for d, t in rows:
        w = words(t)
        for p in range(len(w) - length + 1):
            x = tuple(w[p : p + length])
            least[x] = min(d, least.get(x, d))
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if least[tuple(w[p : p + length])] < d:
                gone[p : p + length] = [True] * length
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out
