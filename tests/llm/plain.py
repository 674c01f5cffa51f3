"""Plain single-process versions of the operators, from their definitions."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def by_id(docs):
    return sorted(docs, key=lambda d: (d[0] is not None, d[0]))


def substrings(docs, length=20):
    seen, out = set(), {}
    for doc_id, text in by_id(docs):
        words, gone = WORD.findall(text or ""), set()
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if window in seen:
                gone |= set(range(i, i + length))
            seen.add(window)
        out[doc_id] = (len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone))
    return out


def lines(docs, least=2, long=50):
    seen, out = set(), {}
    for doc_id, text in by_id(docs):
        every = (text or "").split("\n")
        filled = [i for i, x in enumerate(every) if x.strip(" \t\r\x0b\x0c")]
        gone = set()
        for k in range(len(filled)):
            keys = [("run", tuple(every[i] for i in filled[k : k + least]))] if k + least <= len(filled) else []
            if len(WORD.findall(every[filled[k]])) >= long:
                keys.append(("one", (every[filled[k]],)))
            for key in keys:
                if key in seen:
                    gone |= set(filled[k : k + len(key[1])])
                seen.add(key)
        out[doc_id] = (len(filled), len(gone), "\n".join(x for i, x in enumerate(every) if i not in gone))
    return out


def contamination(docs, bench, width=13):
    windows: dict[tuple, set] = {}
    for item, text in bench:
        words = PLAIN_WORD.findall(lower(text))
        for i in range(max(1, len(words) - width + 1)) if words else ():
            windows.setdefault(tuple(words[i : i + width]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for doc_id, text in docs:
        words, hit, items = PLAIN_WORD.findall(lower(text)), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if owners := windows.get(tuple(words[i : i + size])):
                    hit |= set(range(i, i + size))
                    items |= owners
        items.discard(None)
        out[doc_id] = (len(words), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(words))
    return out


def fingerprint(text):
    words = WORD.findall(lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def groups(prints: dict, radius=3):
    """Smallest id reachable, for id -> fingerprint."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    label = list(range(len(ids)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(ids)):
        for b in np.flatnonzero(np.bitwise_count(values ^ values[a]) <= radius):
            x, y = sorted((root(a), root(int(b))))
            label[y] = x
    return {i: ids[root(k)] for k, i in enumerate(ids)}


SECRETS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.I | re.A), lambda m: len(m[2]) >= 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
)


def base_secrets(text):
    found = [(m.start(), rank, m.end(), kind) for rank, (kind, pattern, holds) in enumerate(SECRETS)
             for m in pattern.finditer(text or "") if holds(m)]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def targets(sizes: dict, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > most * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / w for s in free}
        fixed |= {s: most * sizes[s] for s in over}
