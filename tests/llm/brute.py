"""Brute-force versions of the operators, in plain Python and independent of them."""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import Counter, defaultdict

import regex
import xxhash

BLANK = " \t\n\x0b\f\r"


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def statistics(text):
    w = words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    inside = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    spoken = [x for x in (text or "").split("\n") if x.strip(BLANK)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(spoken) - len(set(spoken)), len(inside)


def lm_scores(rows, backoff=0.4, order=3):
    docs = [words((t or "").lower()) for _, t in rows]
    equal = Counter(rows)

    def grams(d, k):
        return [tuple(d[i - k + 1 : i + 1]) for i in range(k - 1, len(d))]

    counts = Counter(g for d in docs for k in range(1, order + 1) for g in grams(d, k))
    n, out = sum(map(len, docs)), []
    for row, d in zip(rows, docs):
        own = Counter([g for k in range(2, order + 1) for g in grams(d, k)] * equal[row])
        total, seen = 0.0, Counter()

        def worth(gram):
            if len(gram) == 1:
                return counts[gram] / n
            others = counts[gram] - own[gram]
            return others / (counts[gram[:-1]] - own[gram[:-1]]) if others else backoff * worth(gram[1:])

        for i in range(len(d)):
            total += math.log(worth(tuple(d[max(0, i - order + 1) : i + 1])))
        for k in (2, order):
            seen[k] = sum(counts[g] > own[g] for g in grams(d, k)) if 1 < k else 0
        out.append((len(d), seen[2] if order > 1 else 0, seen[order], total / len(d) if d else None))
    return out


def repeats(rows, length=50):
    """Per row (n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text) rows."""
    first = {}
    big = 1 << 63
    for doc_id, text in rows:
        raw, i = (text or "").encode(), big if doc_id is None else doc_id
        for s in range(len(raw) - length + 1):
            x = raw[s : s + length]
            first[x] = min(first.get(x, big), i)
    out = []
    for doc_id, text in rows:
        raw, i = (text or "").encode(), big if doc_id is None else doc_id
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if first[raw[s : s + length]] < i:
                gone[s : s + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def pii(text):
    """Base spans (start, kind number, end) and their counts."""
    found = [(m.start(), n, m.end()) for n, (p, ok) in enumerate(PII.values()) for m in re.finditer(p, text or "") if ok(m[0])]
    return sorted(found), [sum(s[1] == n for s in found) for n in range(4)]


def described(spans):
    return ",".join(f"{[*PII, 'term'][k]}:{a}:{b}" for a, k, b in spans)


def fingerprint(text, width=4):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + width]), 42) for i in range(max(1, len(w) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, radius=4):
    """A class number for each fingerprint in the list, by comparing all pairs."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                label[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(prints))]


def boilerplate(rows, ratio=0.02, min_seen=5):
    """Texts of (host, text) rows without the lines on over ``ratio`` of the host's distinct texts."""
    pages = defaultdict(set)
    for host, text in rows:
        if host is not None and text is not None:
            pages[host].add(text)
    out = []
    seen = {h: Counter(x for t in p for x in {y.strip(BLANK) for y in t.split("\n")} if x) for h, p in pages.items()}
    for host, text in rows:
        if host is None or text is None:
            out.append(text)
            continue
        limit = len(pages[host]) * ratio
        out.append("\n".join(x for x in text.split("\n") if not x.strip(BLANK) or seen[host][x.strip(BLANK)] <= limit or seen[host][x.strip(BLANK)] < min_seen))
    return out


def leaks(texts, items, threshold=0.8):
    """(text number, item number) pairs by comparing every text with every item."""

    def shingles(t, n=5):
        w = words((t or "").lower())
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()

    sets = [shingles(t, max(1, min(5, len(words(t))))) for t in items]
    short = {len(next(iter(s))) for s in sets if s}
    out = set()
    for n, t in enumerate(texts):
        has = set().union(*[shingles(t, n) for n in short])
        out |= {(n, k) for k, s in enumerate(sets) if s and len(s & has) >= threshold * len(s) - 1e-9}
    return out


def _name(term):
    return len(term) > 1 and (unicodedata.category(term[0]) in ("Lu", "Lt", "Lo") or any(unicodedata.category(c)[0] == "N" for c in term))


def _cut(text):
    return list(regex.finditer(r"[\p{L}\p{N}]+", text or ""))


def revealing(texts, disclosure=0.5, certainty=0.4, shared=0.9, prior=0.5):
    """Lower-cased terms that give away an entity, from counts over documents."""
    texts = [t for t in texts if t is not None]
    c_t = Counter(t for x in texts for t in {m[0].lower() for m in _cut(x)})
    c_e, c_et, c_kt = Counter(), Counter(), Counter()
    for text in texts:
        lines, has, near = text.split("\n"), set(), set()
        for i, line in enumerate(lines):
            spans = pii(line)[0]
            entities = {(k, line[a:b].lower() if k == 0 else re.sub("[^0-9]", "", line[a:b])) for a, k, b in spans}
            has |= entities
            if entities:
                clean = "\n".join(lines[max(0, i - 1) : i + 2])
                for kind, (pattern, _) in PII.items():
                    keep = lambda m, kind=kind: m[0] if kind == "card" and len(re.sub("[^0-9]", "", m[0])) < 12 else " "
                    clean = re.sub(pattern, keep, clean)
                near |= {(e, m[0].lower()) for e in entities for m in _cut(clean) if _name(m[0])}
        c_e.update(has)
        c_et.update(near)
        c_kt.update({(e[0], t) for e, t in near})
    out = set()
    for (e, t), n in c_et.items():
        p_e = c_e[e] / len(texts)
        p = (n + prior * p_e) / (c_t[t] + prior)
        if p_e < 1 and n >= shared * c_kt[e[0], t] and p >= certainty and math.log(p / p_e) / math.log(1 / p_e) >= disclosure:
            out.add(t)
    return out


def term_spans(text, terms):
    taken = [(a, b) for a, _, b in pii(text)[0]]
    return [m.span() for m in _cut(text) if m[0].lower() in terms and not any(a < m.end() and m.start() < b for a, b in taken)]


def targets(sizes, cycle=(5, 2, 1), cap=3):
    """Water filling of {source: size} by repeatedly fixing what is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[k % len(cycle)] for k, s in enumerate(names)}
    fixed: dict = {}
    while True:
        left = sum(sizes.values()) - sum(fixed.values())
        free = [s for s in names if s not in fixed]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: cap * sizes[s] for s in free if share[s] > cap * sizes[s]}
        if not over:
            return share | fixed
        fixed |= over
