"""Brute-force versions of the operators, for small fixtures."""

import hashlib
import random
import re
import string
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def substring_dedup(docs, length=13):
    first = {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        w = WORD.findall(t or "")
        for p in range(len(w) - length + 1):
            first.setdefault(tuple(w[p:p + length]), i)
    out = {}
    for i, t in docs:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p:p + length])] < i:
                gone[p:p + length] = [True] * length
        out[i] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def suffix_dedup(docs, length=100):
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p:p + length] in seen:
                gone[p:p + length] = b"x" * length
            seen.add(b[p:p + length])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), len(b) - len(kept), len(re.findall(b"x+", bytes(gone))), sha(kept))
    return out


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}


def near_duplicates(docs):
    sets = {i: shingles(t) for i, t in docs}
    label = {i: i for i in sets}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                label[b] = a
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


def near_rows(docs):
    """(doc_id, n_shingles, component_id, kept) of each row; ids may be null or repeated."""
    sets = [shingles(t) for _, t in docs]
    group = list(range(len(docs)))
    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= 75 * len(x | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(docs, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [(i, len(x), least.get(g) if x else i, i == (least.get(g) if x else i))
            for (i, _), x, g in zip(docs, sets, group)]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def personal_data(text):
    out, text = [], text or ""
    find = lambda p: re.finditer(p, text)
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out += [("email", *m.span()) for m in find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")]
    out += [("ip", *m.span()) for m in find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
            if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in find(r"[0-9]([\x20-]?[0-9])+") if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in find(r"\+[0-9][\x20().0-9-]+[0-9]") if 9 <= len(digits(m)) <= 15]
    return out


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            covered.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w))


def corpus(seed=3, n=150):
    """Texts of words in few bytes, passages shared whole, cut, edited or repeated, copies, blanks."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    text = lambda k: "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", " ", "\n", "  ", "\t"]) for _ in range(k))
    passages = [text(rnd.randint(8, 60)) for _ in range(8)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(passages)
            if rnd.random() < 0.4:
                a = rnd.randint(0, len(p))
                p = p[a:a + rnd.randint(50, 400)]
            if rnd.random() < 0.2:
                k = rnd.randint(0, len(p))
                p = p[:k] + "X" + p[k:]
            parts += [text(rnd.randint(0, 30)), p, p if rnd.random() < 0.3 else ""]
        docs.append((3 * i, "".join(parts)))
    return docs + [(1, None), (4, ""), (7, " \t\n"), (1000, docs[5][1]), (1001, docs[5][1]),
                   (1003, "a" * 500), (1006, "ab " * 300)]
