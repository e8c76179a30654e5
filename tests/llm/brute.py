"""Plain versions of what the operators compute."""

import hashlib
import math
import re

UPPER = re.compile("[A-Z]+")
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = [("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license")]
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def normalised(text):
    return re.sub("[\x20\x09-\x0D]+", " ", text or "")


def licenses(text):
    words = WORD.findall(UPPER.sub(lambda m: m[0].lower(), text or ""))
    found = []
    for label, phrase in PHRASES:
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    if not found:
        return len(words), 0, None, None, ""
    return len(words), len(found), min(found)[0], max(found)[0], ",".join(sorted({x for _, x in found}))


def notices(text, known, width, least_share):
    """``(label, begin, share)`` of each template found: the best alignment of each window of diagonals, overlapping ones left out."""
    words = WORD.findall(UPPER.sub(lambda m: m[0].lower(), text or ""))
    out = []
    for label, template in known:
        t = template.split()
        pairs = len(t) - 1
        votes = [(p, o) for p in range(len(words) - 1) for o in range(pairs) if words[p : p + 2] == t[o : o + 2]]
        best = {}
        for d in {p - o for p, o in votes}:
            longest = {}
            for p, o in sorted(v for v in votes if d <= v[0] - v[1] <= d + width):
                longest[p, o] = 1 + max((n for (q, r), n in longest.items() if q < p and r < o), default=0)
            if max(longest.values()) >= least_share * pairs:
                best[d] = max(longest.values())
        for d, n in best.items():
            if all((n, d) >= (m, e) for e, m in best.items() if abs(d - e) <= width):
                out.append((label, d, n / pairs))
    return sorted(out)


def noisy_or(text, weights, constant, slots):
    """The score of a text and ``(start, end, score)`` of its sentences, by the formula."""
    clean, out = 1.0, []
    for m in re.finditer(r"[^.!?\n]+", text or ""):
        words = set(re.findall(r"[^\W\d_]+", m[0].lower()))
        if words:
            p = 1 / (1 + math.exp(-constant - sum(weights.get(s, 0.0) for w in words for s in slots(w))))
            clean *= 1 - p
            out.append((m.start(), m.end(), p))
    return 1 - clean, out


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def personal(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), k, m.end()))
    names = list(PATTERNS)
    told = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(found))
    return *(sum(f[1] == k for f in found) for k in range(4)), hashlib.sha256(told.encode()).hexdigest()


def components(texts, n_words, percent):
    """Smallest id reachable over links of every pair, and the size of each set."""
    sets = {}
    for i, text in texts.items():
        w = (text or "").encode().lower().split()
        k = min(n_words, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if k else set()
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                least[b] = a
    return {i: root(i) for i in ids}, {i: len(s) for i, s in sets.items()}
