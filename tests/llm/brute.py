"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def null_last(value):
    return (value is None, value if value is not None else 0)


def mixed(docs, weights=(5, 2, 1), share=1.5, epochs=2, names=None):
    """(doc_id, size, source_size, target, taken) of rows (doc_id, text, source).

    ``names`` are what the shuffle hashes beside the id: by default the text's digest and a number among equal rows.
    """
    sized = [(d, len(words(t)), s) for d, t, s in docs]
    if names is None:
        met, names = Counter(), []
        for d, t, s in docs:
            names.append(f"{hashlib.md5((t or '').encode()).hexdigest()}:{met[d, t or '', s]}")
            met[d, t or "", s] += 1
    ids = [":".join(["mix", *([str(d)] if d is not None else []), x]) for (d, *_), x in zip(docs, names, strict=True)]
    totals = Counter()
    for _, n, s in sized:
        totals[s] += n
    sources = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    budget, open_, target = share * sum(totals.values()), set(sources), {}
    while open_:  # fill up source by source
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > epochs * totals[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: float(epochs * totals[s]) for s in full}
        open_ -= full
    copies = []
    for i, s in enumerate(sources):
        mine = [(hashlib.md5(ids[k].encode()).hexdigest(), n, k) for k, (_, n, x) in enumerate(sized) if x == s]
        for epoch in range(epochs):
            done = epoch * totals[s]
            for key, n, k in sorted(mine):
                done += n
                copies.append((done / target[s] if target[s] else 0.0, i, epoch, key, n, k))
    taken, done = Counter(), 0
    for *_, n, k in sorted(copies):
        done += n
        if done <= budget:
            taken[k] += n
    return [(d, n, totals[s], target[s], taken[k]) for k, (d, n, s) in enumerate(sized)]


def simhash(text, shingle=3):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + shingle]).encode(), 42) for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits=2):
    """The least reachable print of each print."""
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    todo = sorted(parent)
    for i, a in enumerate(todo):
        for b in todo[:i]:
            if (a ^ b).bit_count() <= bits:
                one, two = sorted((find(a), find(b)))
                parent[two] = one
    return {p: find(p) for p in prints}


def simhash_groups(docs):
    """(doc_id, fingerprint, component_id) of rows (doc_id, text)."""
    prints = [simhash(t) for _, t in docs]
    root = components(set(prints))
    least = {}
    for (d, _), p in zip(docs, prints, strict=True):
        if d is not None:
            least[root[p]] = min(least.get(root[p], d), d)
    return [(d, format(p, "016x"), least.get(root[p])) for (d, _), p in zip(docs, prints, strict=True)]


def cut(docs, width=20):
    """Kept words and number of words per row (doc_id, text); rows equal in both are one document."""
    from_hash = {}
    for d, t in docs:
        h = xxhash.xxh64_intdigest((t or "").encode(), 42) & ((1 << 24) - 1)
        from_hash[d, t or ""] = (d is None, d or 0, h)
    seen, out = set(), {}
    for key in sorted(from_hash, key=from_hash.get):
        w = words(key[1])
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            window = tuple(w[s:s + width])
            if window in seen:
                gone[s:s + width] = [True] * width
            seen.add(window)
        out[key] = ([x for x, g in zip(w, gone, strict=True) if not g], len(w))
    return [out[d, t or ""] for d, t in docs]


def rules(docs, limit=0.5):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of (doc_id, text, source)."""
    out, hosts = [], defaultdict(list)
    for d, t, s in docs:
        t = t or ""
        w = words(t)
        lines = [x for x in t.split("\n") if words(x)]
        grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        covered = {i + k for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for k in range(8)}
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        hosts[s].append(failed)
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed, s))
    rates = [sum(v) / len(v) for v in hosts.values()]
    mean = sum(rates) / len(rates) if rates else 0
    spread = sum((r - mean) ** 2 for r in rates) / (len(rates) - 1) if len(rates) > 1 else 0
    strength = max(mean * (1 - mean) / spread - 1, 0) if spread > 1e-12 else None
    rejected = {s: (mean if strength is None else (sum(v) + mean * strength) / (len(v) + strength)) > limit for s, v in hosts.items()}
    return [(*r[:-1], not r[-2] and not rejected[r[-1]]) for r in out]


def best_fit(sizes, capacity):
    """The number of bins of best-fit decreasing."""
    gaps = []
    for size in sorted(sizes, reverse=True):
        fitting = [g for g in gaps if g >= size]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - size)
        else:
            gaps.append(capacity - size)
    return len(gaps)
