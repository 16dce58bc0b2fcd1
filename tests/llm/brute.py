"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(s: str) -> str:
    return s.translate({i: i + 32 for i in range(65, 91)})


def crc5(doc_id) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def contamination(docs, items, window=10):
    phrases: dict[tuple, set] = {}
    for item_id, text in items:
        x = ALNUM.findall(lower(text or ""))
        if x:
            for s in range(max(1, len(x) - window + 1)):
                phrases.setdefault(tuple(x[s : s + window]), set()).add(item_id)
    lengths = sorted({len(p) for p in phrases})
    out = []
    for doc_id, text in docs:
        x = ALNUM.findall(lower(text or ""))
        hit, found = [False] * len(x), set()
        for n in lengths:
            for i in range(len(x) - n + 1):
                if (p := tuple(x[i : i + n])) in phrases:
                    hit[i : i + n] = [True] * n
                    found |= phrases[p]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(x), sum(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), any(hit)))
    return out


def substring(docs, window):
    words = [WORD.findall(text or "") for _, text in docs]
    seen = collections.Counter(tuple(x[i : i + window]) for x in words for i in range(len(x) - window + 1))
    out = []
    for (doc_id, _), x in zip(docs, words):
        gone = [False] * len(x)
        for i in range(len(x) - window + 1):
            if seen[tuple(x[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((doc_id, len(x), sum(gone), " ".join(w for w, g in zip(x, gone) if not g)))
    return out


def shingles(text, k=5):
    x = WORD.findall(lower(text or ""))
    return frozenset(tuple(x[i : i + k]) for i in range(max(1, len(x) - k + 1))) if x else frozenset()


def components(docs, threshold=80):
    sets = [shingles(text) for _, text in docs]
    parent = list(range(len(docs)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= threshold * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(doc_id, len(s), least.get(find(i))) for i, ((doc_id, _), s) in enumerate(zip(docs, sets))]


def _discount(n, k=5):
    shared = (k + 1) * n.get(k + 1, 0) / n[1] if n.get(1) else 1.0
    d = {}
    for r in range(1, k + 1):
        turing = (r + 1) * n.get(r + 1, 0) / (r * n[r]) if n.get(r) else 0.0
        x = (turing - shared) / (1 - shared) if shared != 1 else 0.0
        d[r] = x if 0 < x < 1 else (r - 0.5) / r
    return lambda c: d.get(c, 1.0) * c


def katz(docs, order=2, min_count=2):
    """Rows of scores, the conditional probability, and the training words."""
    seqs = [[*WORD.findall(lower(t or "")), None] for _, t in docs]
    train = [crc5(d) != 1 for d, _ in docs]
    c1 = collections.Counter(w for s, f in zip(seqs, train) if f for w in s)
    total, distinct = sum(c1.values()), len(c1)
    dc = _discount(collections.Counter(c1.values()))
    left = 1 - sum(dc(c) for c in c1.values()) / total if total else 1.0
    unknown = max(left, 0.5 / (total + 0.5 * (distinct + 1)))
    probs = [None, lambda ctx, w: dc(c1[w]) * (1 - unknown) / (1 - left) / total if c1[w] else unknown]
    for k in range(2, order + 1):
        counts = collections.defaultdict(collections.Counter)
        for s, f in zip(seqs, train):
            p = ["<s>"] * (k - 1) + s
            for i in range(len(s) if f else 0):
                counts[tuple(p[i : i + k - 1])][s[i]] += 1
        d = _discount(collections.Counter(c for x in counts.values() for c in x.values()))
        low, info = probs[k - 1], {}
        for u, x in counts.items():
            n, big = sum(x.values()), {w: c for w, c in x.items() if c >= min_count}
            if not big:
                info[u] = (1.0, 1.0, n, big)
                continue
            share = sum(d(c) for c in big.values()) / n
            rest = max(1 - share, 0.5 / (n + 0.5))
            info[u] = (rest / (1 - sum(low(u[1:], w) for w in big)), (1 - rest) / share, n, big)

        def prob(ctx, w, info=info, low=low, d=d):
            alpha, factor, n, big = info.get(ctx, (1.0, 1.0, 0, {}))
            return d(big[w]) * factor / n if w in big else alpha * low(ctx[1:], w)

        probs.append(prob)
    rows = []
    for (doc_id, _), s, f in zip(docs, seqs, train):
        p = ["<s>"] * (order - 1) + s
        score = sum(math.log10(probs[order](tuple(p[i : i + order - 1]), s[i])) for i in range(len(s)))
        base = sum(math.log10((c1[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in s)
        rows.append((doc_id, not f, len(s), sum(c1[w] > 0 for w in s), total, base, score))
    return rows, probs[order], c1
