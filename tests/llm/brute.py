"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import xxhash

LAST = 1 << 63


def equal_texts(docs):
    """doc_id, keep_id, group_size, kept, sha of every row."""
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for d, t in docs:
        groups[norm(t)].append(d)
    out = []
    for d, t in docs:
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = min(ids, default=None)
        out.append((d, keep, len(groups[norm(t)]), d == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return out


def repeats_removed(docs, window=13):
    first, out = {}, []
    split = [((t or "").encode().split(), LAST if d is None else d) for d, t in docs]
    for w, d in split:
        for i in range(len(w) - window + 1):
            x = tuple(w[i:i + window])
            first[x] = min(first.get(x, LAST), d)
    for (w, d), (doc_id, _) in zip(split, docs):
        gone = {i + k for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < d for k in range(window)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text, shingle=4):
    w = (text or "").encode().lower().split()
    parts = [b" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(docs, distance=4):
    """doc_id, fingerprint, component_id of every row."""
    prints = [simhash(t) for _, t in docs]
    group = list(range(len(docs)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                group[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            ids[find(i)].append(d)
    return [(d, f"{prints[i]:016x}", min(ids[find(i)], default=None)) for i, (d, _) in enumerate(docs)]


def cosines(vectors, query):
    m, q = np.array(vectors, np.float64), np.array(query, np.float64)
    return (m * q).sum(axis=1) / np.sqrt((m * m).sum(axis=1)) / np.sqrt((q * q).sum())


def alignments(docs, a, b):
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups of every row.  ``a`` and ``b``: text -> list of
    (id, bytes); a text is given to ``a`` with a space in front, ``b`` adds its own."""
    held, counts, best = [], defaultdict(int), defaultdict(int)
    for _, t in docs:
        x, y = (a(" " + t), b(t)) if t else ([], [])
        raw = (" " + (t or "")).encode()
        groups = []
        if t and b"".join(c for _, c in x) == raw == b"".join(c for _, c in y):
            ends = [{sum(len(c) for _, c in z[:k]) for k in range(1, len(z) + 1)} if len(z) < 200 else
                    set(np.cumsum([len(c) for _, c in z]).tolist()) for z in (x, y)]
            cuts = sorted(ends[0] & ends[1])
            groups = [([], []) for _ in cuts]
            for side, z in enumerate((x, y)):
                at, g = 0, 0
                for i, c in z:
                    at += len(c)
                    while at > cuts[g]:
                        g += 1
                    groups[g][side].append(i)
        links = [(i, j) for g in groups for i in g[0] for j in g[1]]
        held.append((len(x) if groups else 0, len(y) if groups else 0, groups, links))
        for p in set(links):
            counts[p] += 1
    for (i, _), c in counts.items():
        best[i] = max(best[i], c)
    text = lambda groups: ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
    return [(d, n, m, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
             text(groups)) for (d, _), (n, m, groups, links) in zip(docs, held)]
