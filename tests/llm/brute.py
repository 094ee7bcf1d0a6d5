"""Plain versions of what the corpus operators must return, for small inputs."""

import hashlib
import re
from itertools import combinations

BLANKS = re.compile("[^\x20\x09-\x0d]+")

DOCS = "doc_id long, text string, packed string, node long, label int"


def documents(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS)


def words(text):
    return BLANKS.findall(text or "")


def windows_removed(rows, width):
    """By doc_id: words, removed words, SHA-256 of the rest."""
    first = {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        own = words(text)
        for k in range(len(own) - width + 1):
            first.setdefault(tuple(own[k : k + width]), doc_id)
    out = []
    for doc_id, text in rows:
        own = words(text)
        gone = [False] * len(own)
        for k in range(len(own) - width + 1 if doc_id is not None else 0):
            if first[tuple(own[k : k + width])] < doc_id:
                gone[k : k + width] = [True] * width
        kept = [w for w, g in zip(own, gone) if not g]
        digest = hashlib.sha256(" ".join(kept).encode()).hexdigest()
        out.append((doc_id, len(own), len(own) - len(kept), digest))
    return out


def shingle_set(text):
    own = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not own:
        return frozenset()
    k = min(5, len(own))
    return frozenset(tuple(own[i : i + k]) for i in range(len(own) - k + 1))


def smallest_reachable(ids, links):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(low[a], low[b])
            changed |= low[a] != least or low[b] != least
            low[a] = low[b] = least
    return low


def near_copies(rows, percent):
    """By doc_id: set size, component, kept."""
    sets = {i: shingle_set(t) for i, t in rows}
    links = []
    for a, b in combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            links.append((a, b))
    low = smallest_reachable(sets, links)
    return sorted((i, len(s), low[i], low[i] == i) for i, s in sets.items())


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in twice) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text):
    found = [
        (m.start(), n, kind, m.end())
        for n, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if _passes(kind, m.group())
    ]
    return [(start, end, kind) for start, _, kind, end in sorted(found)]


def edit_distance(pattern, text):
    """Fewest edits between the pattern and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i] + [0] * len(text)
        for j, t in enumerate(text, 1):
            row[j] = min(last[j - 1] + (p != t), last[j] + 1, row[j - 1] + 1)
    return min(row)
