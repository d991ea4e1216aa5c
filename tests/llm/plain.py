"""Brute-force versions of operators, in plain Python."""

import hashlib
import math
import re
from collections import Counter

from wayfold.llm import secrets, toxicity


def near_duplicate_rows(rows, n, each=False):
    """Every pair of texts, then the smallest doc_id reachable; `each`: a list in the order of the rows."""

    def grams(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()

    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    able = [k for k, (i, _) in enumerate(rows) if i is not None and sets[k]]
    for x in able:
        for y in able:
            if x < y and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    least = {}
    for k in able:
        least[find(k)] = min(least.get(find(k), rows[k][0]), rows[k][0])
    out = ((i, len(sets[k]), None if i is None else least.get(find(k), i), i is None or least.get(find(k), i) == i) for k, (i, _) in enumerate(rows))
    return list(out) if each else Counter(out)


def contamination_rows(rows, items, n=13):
    """Every window of every item against every place of every document."""
    rx = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    windows = {}
    for i, t in items:
        w = rx.findall((t or "").translate(fold))
        m = min(n, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[k : k + m]), set()).add(i)
    want = Counter()
    for i, t in rows:
        w = rx.findall((t or "").translate(fold))
        hit, found = [False] * len(w), set()
        for m in {len(k) for k in windows}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in windows:
                    found |= windows[tuple(w[k : k + m])]
                    hit[k : k + m] = [True] * m
        found.discard(None)
        n_hit = sum(hit)
        want[(i, len(w), n_hit, len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), n_hit > 0 and 20 * n_hit >= len(w))] += 1
    return want


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def toxic_features(text, words, heads):
    """The features of one text, hit by hit: every word against every term."""
    text = text.lower()
    spans = [m.span() for m in re.finditer(r"(?:[^\W_]|[\u00b2\u00b3\u00b9])+", text)]
    hits = []
    for at, (a, b) in enumerate(spans):
        w = text[a:b]
        near = [x for t, x in words.items() if abs(len(t) - len(w)) <= 2 and levenshtein(w, t) <= toxicity.errors_allowed(t)]
        begun = [x for h, x in heads.items() if w.startswith(h)]
        if w in words:
            hits.append((at, "exact", words[w]))
        elif begun:
            hits.append((at, "beginning", max(begun)))
        elif near:
            hits.append((at, "misspelled", max(near)))
    marks = []
    for k, c in enumerate(text):
        if c in toxicity._QUOTES:
            before, after = text[k - 1 : k] if k else "", text[k + 1 : k + 2]
            if c == '"':
                marks.append((k, after.isalnum() and not before.isalnum(), before > " " and not after.isalnum()))
            else:
                marks.append((k, c not in "”»›", c not in "„«‹"))
    count, weight, together = Counter(), 0.0, 0
    for n, (at, kind, x) in enumerate(hits):
        a, b = spans[at]
        low, high = max(0, at - toxicity.WINDOW), min(len(spans) - 1, at + toxicity.WINDOW)
        left, right = [m for m in marks if m[0] < a], [m for m in marks if m[0] >= b]
        quoted = bool(left and right and left[-1][1] and left[-1][0] >= spans[low][0] - 1 and right[0][2] and right[0][0] <= spans[high][1] + 1)
        quoted = quoted or any(w.strip(",.:;!?") in toxicity._REPORTING for w in text[spans[low][0] : b].split()) and high > low
        count["quotation" if quoted else kind] += 1
        weight += x
        together += sum(abs(other[0] - at) <= 3 * toxicity.WINDOW for other in hits[max(0, n - 1) : n] + hits[n + 1 : n + 2])
    logs = [math.log1p(count[k]) for k in ("exact", "misspelled", "beginning", "quotation")]
    return [*logs, math.log1p(weight), math.sqrt(len(hits) / max(1, len(spans))), math.log1p(together)]


def secret_spans(text):
    """Base and added spans, every part against every other."""
    base = secrets.base_spans(text)
    idents, values, ends = secrets.weak_parts(text)
    overlap = lambda x, y: x[0] < y[1] and y[0] < x[1]
    breaks = [m.start() for m in re.finditer(r"\n\s*\n", text)]

    def near(x, y):
        for (_, end), (start, _) in ((x, y), (y, x)):
            if end <= start and start - end <= secrets.REACH and not any(end <= p < start for p in breaks):
                return True
        return False

    strong = [(a, b) for a, _, b in base]
    weak = sorted({s for s in values if not any(overlap(s, t) for t in strong)})
    names = sorted({s for s in idents if not any(overlap(s, t) for t in strong + weak)})
    all_names, all_values = names + [(a, b) for a, k, b in base if k == 1], weak + [(a, b) for a, k, b in base if k != 1]
    added = [(a, 4, b) for a, b in weak if any(near((a, b), y) for y in all_names)]
    added += [(a, 3, b) for a, b in names if any(near((a, b), y) for y in all_values) and (any(c in text[a:b] for c in ":=") or any(near((a, b), y) for y in ends))]
    out = []
    for a, k, b in sorted(added, key=lambda x: (x[0], -x[2])):
        if not out or out[-1][2] <= a:
            out.append((a, k, b))
    return base, out


def best_fit(rows, capacity):
    """Whether packed rows (doc_id, piece, n_words, bin, source, cluster) are best fit in their order: largest first, then cluster, doc_id and source."""
    whole = [r for r in rows if r.n_words == capacity and "-f" in r.bin]
    rest = sorted((r for r in rows if r not in whole), key=lambda r: (-r.n_words, r.cluster, r.doc_id is None, r.doc_id or 0, r.source or ""))
    copies = Counter(r.cluster for r in rest if r.cluster != -1)
    for cluster, n in Counter(r.cluster for r in whole if r.piece == 0).items():
        copies[cluster] += 0 if any(r.cluster == cluster for r in rest) else n
    bins = {}
    for r in rest:
        shared = r.cluster if copies[r.cluster] > 1 else None
        fits = [room for room, sources, clusters in bins.values() if room >= r.n_words and not (r.source and r.source in sources) and not (shared and shared in clusters)]
        room, sources, clusters = bins.setdefault(r.bin, (capacity, set(), set()))
        if room != min(fits, default=capacity) or (r.source and r.source in sources) or (shared and shared in clusters):
            return False
        bins[r.bin] = (room - r.n_words, sources | {r.source} - {None}, clusters | {shared} - {None})
    return True
