"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def components(nodes, links):
    """Smallest node that each node reaches."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


def fingerprint(text):
    w = words((text or "").translate(LOW))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def substrings(docs, window=35):
    """(key, text) pairs to {key: (n_words, n_removed, sha256)}."""
    split = [(k, words(t)) for k, t in docs]
    seen = Counter(tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1))
    out = {}
    for k, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[k] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def language_model(docs, priors):
    tokens = [(k, [*words((t or "").translate(LOW)), None]) for k, t in docs]
    held = {k: zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2 for k, _ in docs}
    one, two, three = Counter(), Counter(), Counter()
    for k, t in tokens:
        if not held[k]:
            one.update(t)
            two.update(zip(["<s>", *t[:-1]], t, strict=True))
            three.update(zip(["<s>", *t[:-1]], t, t[1:]))
    n, v = sum(one.values()), len(one)
    states = one | {"<s>": one[None]}
    out = {}
    for k, t in tokens:
        base = score = 0.0
        for i, w in enumerate(t):
            p = (one[w] + 1) / (n + v + 1)
            base += math.log10(p)
            h = t[i - 1] if i else "<s>"
            p = (two[h, w] + priors[0] * p) / (states.get(h, 0) + priors[0])
            if i:
                g = t[i - 2] if i > 1 else "<s>"
                p = (three[g, h, w] + priors[1] * p) / (two[g, h] + priors[1])
            score += math.log10(p)
        out[k] = (held[k], len(t), sum(one[w] > 0 for w in t), n, base, score)
    return out


def rules(docs, limit, least_words=10, least_share=0.5):
    """(id, source, text) rows to {id: row}."""
    norm = lambda line: " ".join(words(line)).lower()
    texts = defaultdict(set)
    for _, source, t in docs:
        for line in (t or "").split("\n"):
            if words(line):
                texts[source, norm(line)].add(t)
    out = {}
    for k, source, t in docs:
        t = t or ""
        w, lines = words(t), [x for x in t.split("\n") if words(x)]
        runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        count, again = Counter(runs), set()
        for i, r in enumerate(runs):
            if count[r] > 1:
                again.update(range(i, i + 5))
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        gone = sum(len(words(x)) for x in lines if len(texts[source, norm(x)]) > limit)
        left = len(w) - gone
        out[k] = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), failed, not failed and left >= least_words and left >= least_share * len(w), gone)
    return out
