"""Plain-Python versions of what the operators return, for small tables."""

import hashlib
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0D]+")
TERM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EMPTY = hashlib.sha256(b"").hexdigest()

#: Texts that operators meet at the edges.
EDGES = [
    None,
    "",
    " \n\t ",
    "One",
    "one two three four",
    "One two three four five",
    "ONE two three four five",
    "é" * 50 + " ß\n\n\nß\nß",
    "word " * 30_000,
    "a\nb\na\nb\n\na",
    "\nlead\r\nlead\n lead",
    "x" * 5000,
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(texts):
    sets = {d: shingles(t) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def quality_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered)


def contamination(text, items):
    """items: (item_id, text) pairs."""
    w = TERM.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, question in items:
        q = TERM.findall((question or "").translate(LOWER))
        for k in range(max(0, len(q) - 10) + 1 if q else 0):
            window = q[k : k + 10]
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    found.add(str(item))
                    hit.update(range(i, i + len(window)))
    return len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and _luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, text) if ok(m[0])]


def url_parts(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def url_rule(host, path, rules):
    fits = []
    for rule in rules:
        site, _, prefix = rule.partition("/")
        if (host == site or host.endswith("." + site)) and path.startswith("/" + prefix):
            fits.append(rule)
    return max(fits, key=len, default=None)


def conversation(turns):
    """turns: sorted (role, text) pairs."""
    said = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), sha(said)
