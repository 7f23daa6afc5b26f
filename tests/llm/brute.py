"""Plain-Python versions of the contracts, for comparison on small data."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = {c: c + 32 for c in range(65, 91)}


def base_rules(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i:i + 5])] > 1:
            hit.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
            len(w) < 10 or 100 * len(hit) > 20 * len(w))


def fingerprint(text, k=3):
    w = WORD.findall((text or "").translate(AZ))
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(max(len(w) - k, 0) + 1)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows):
    """rows (doc_id, text) -> sorted (doc_id, fingerprint hex, least doc_id)."""
    fps = [(d, fingerprint(t)) for d, t in rows]
    distinct = sorted({f for _, f in fps})
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for d, f in fps:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [(d, f"{f:016x}", least.get(find(f))) for d, f in fps]


def contamination(docs, items, window=13):
    split = lambda t: ITEM_WORD.findall((t or "").translate(AZ))
    windows = defaultdict(set)
    for item, text in items:
        w = split(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            windows[tuple(w[i:i + window])].add(str(item) if item is not None else "null")
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i:i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """source -> size to source -> target by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in free}
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= full
    return out


# ------------------------------------------------------------------ operators without a contract


def norm_line(x):
    return re.sub(r"[\x20\x09-\x0D]+", " ", x.lower()).strip(" ")


def own_lines(text):
    return [x for x in (text or "").split("\n") if WORD.search(x)]


def quality_kept(rows, min_docs=20, min_left=0.2):
    """rows (doc_id, text, host) -> list of kept."""
    out = []
    for (_, t, _), (_, gone) in zip(rows, without_host_lines(rows, min_docs)):
        n = len(WORD.findall(t or ""))
        out.append(not base_rules(t)[5] and n - gone >= min_left * n)
    return out


def line_dedup(rows, min_sites=10):
    """rows (doc_id, text, site) -> list of texts."""
    sites = defaultdict(set)
    for _, t, s in rows:
        for x in own_lines(t):
            sites[norm_line(x)].add(s)
    bad = {x for x, s in sites.items() if len(s) >= min_sites}
    return [None if t is None else "\n".join(x for x in t.split("\n") if not (WORD.search(x) and norm_line(x) in bad)) for _, t, _ in rows]


def without_spans(docs, items):
    """(doc_id, text) of documents that are not contaminated, hit words cut out."""
    out = []
    for (d, t), judged in zip(docs, contamination(docs, items)):
        if judged[5]:
            continue
        if judged[2]:
            t = cut_hits(t, items)
        out.append((d, t))
    return out


def cut_hits(text, items, window=13):
    lower = text.translate(AZ)
    words = [(m.group(), m.span()) for m in ITEM_WORD.finditer(lower)]
    wins = set()
    for _, t in items:
        w = ITEM_WORD.findall((t or "").translate(AZ))
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            wins.add(tuple(w[i:i + window]))
    hit = set()
    for n in {len(w) for w in wins}:
        for i in range(len(words) - n + 1):
            if tuple(x for x, _ in words[i:i + n]) in wins:
                hit.update(range(i, i + n))
    out, last, i = [], 0, 0
    while i < len(words):
        if i in hit:
            j = i
            while j + 1 in hit:
                j += 1
            out.append(text[last:words[i][1][0]])
            last = words[j][1][1]
            i = j
        i += 1
    return "".join([*out, text[last:]])


def shared_passages(rows, words=51):
    """doc -> word numbers inside exact passages of ``words`` words that another document has too."""
    w = {i: (t or "").encode().lower().split() for i, (_, t) in enumerate(rows)}
    own = defaultdict(set)
    for i, x in w.items():
        for k in range(len(x) - words + 1):
            own[tuple(x[k:k + words])].add(i)
    out = defaultdict(set)
    for i, x in w.items():
        for k in range(len(x) - words + 1):
            if len(own[tuple(x[k:k + words])]) > 1:
                out[i].update(range(k, k + words))
    return out


def without_host_lines(rows, min_docs=20):
    """rows (doc_id, text, host) -> (text without the lines in more than ``min_docs`` distinct texts of the host, words taken out)."""
    docs = defaultdict(set)
    for _, t, h in rows:
        for x in own_lines(t):
            docs[h, norm_line(x)].add(t)
    bad = {k for k, d in docs.items() if len(d) > min_docs}
    out = []
    for _, t, h in rows:
        gone = [x for x in own_lines(t) if (h, norm_line(x)) in bad]
        left = None if t is None else "\n".join(x for x in t.split("\n") if not (WORD.search(x) and (h, norm_line(x)) in bad))
        out.append((left, sum(len(WORD.findall(x)) for x in gone)))
    return out
