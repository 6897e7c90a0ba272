"""Brute-force versions of the corpus queries, in plain Python."""

import hashlib
import re

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def simhash(text, k=4):
    w = SPACE_WORD.findall((text or "").translate(ASCII_LOWER))
    if not w:
        return 0
    grams = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(nodes, linked):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {n: find(n) for n in nodes}


def decontaminate(text, items, size=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(ASCII_LOWER))
    w, hit, found = split(text), set(), set()
    for item, t in items:
        v = split(t)
        k = min(size, len(v))
        if not k:
            continue
        grams = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)}
        for i in range(len(w) - k + 1):
            if tuple(w[i : i + k]) in grams:
                hit.update(range(i, i + k))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


BASE_SECRETS = [
    ("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def secrets(text):
    """(start, kind number, end) of the base spans."""
    return sorted(
        (m.start(), k, m.end()) for k, (_, p, ok) in enumerate(BASE_SECRETS) for m in p.finditer(text or "") if ok(m)
    )


def quality(text):
    text = text or ""
    w = SPACE_WORD.findall(text)
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i : i + 3]), []).append(i)
    repeated = {p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 3)}
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    n, r = len(w), len(repeated)
    return (n, sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n)


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(ASCII_LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def repeats(rows, size=20):
    """Words, removed flags of every row of [(id, text)], ids ascending."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = SPACE_WORD.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            key = tuple(w[s : s + size])
            if key in seen:
                gone[s : s + size] = [True] * size
            seen.add(key)
        out[i] = (w, gone)
    return out


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]
