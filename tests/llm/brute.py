"""Plain Python versions of the corpus contracts, one text or pair at a time."""

import collections
import hashlib
import re

import xxhash

words = re.compile(r"[^\x20\x09-\x0D]+").findall
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text):
    w = words((text or "").translate(LOWER))
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    ones = collections.Counter()
    for g in grams:
        h = xxhash.xxh64(g.encode(), seed=42).intdigest()
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def components(rows):
    """Group number of each (id, fingerprint) row, and the smallest id of each group."""
    group = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if bin(a ^ rows[j][1]).count("1") <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc, _), g in zip(rows, group):
        least[g] = min((x for x in (least.get(g), doc) if x is not None), default=None)
    return [least[g] for g in group], group


def repeats(rows):
    """(n_words, n_removed, kept) of each (id, text) row: equal rows are one document, null ids come last."""
    def place(doc, text):
        mark = xxhash.xxh64(text.encode(), seed=42).intdigest()
        return doc is None, doc or 0, mark - (1 << 64) if mark >> 63 else mark

    texts = [(doc, text or "") for doc, text in rows]
    seen, done = set(), {}
    for doc, text in sorted(set(texts), key=lambda r: place(*r)):
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            key = tuple(w[s:s + 20])
            if key in seen:
                gone[s:s + 20] = [True] * 20
            seen.add(key)
        done[doc, text] = len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)
    return [done[r] for r in texts]


def measures(text):
    text = text or ""
    w = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    count = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    twice = [False] * len(w)
    for i in range(len(w) - 7):
        if count[tuple(w[i:i + 8])] > 1:
            twice[i:i + 8] = [True] * 8
    return len(w), sum(map(len, w)), sum(text.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), sum(twice)


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(re.sub("[ -]", "", v)) <= 19 and luhn(re.sub("[ -]", "", v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(re.sub("[^0-9]", "", v)) <= 15),
]


def personal(text):
    return [(k, m.start(), m.end()) for k, p, good in PATTERNS for m in re.finditer(p, text or "") if good(m[0])]
