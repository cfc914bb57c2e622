"""Plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from itertools import combinations


def shingles(text: str | None, width: int) -> frozenset:
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def roots(nodes: list, links: list[tuple]) -> dict:
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def near_text(rows: list[tuple], width: int, num: int, den: int) -> Counter:
    """(id, set size, component, kept) of rows (id, text)."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    ids = [i for i, s in sets if i is not None]
    links = [
        (i, j)
        for (i, s), (j, t) in combinations(sets, 2)
        if None not in (i, j) and s and t and den * len(s & t) >= num * len(s | t)
    ]
    found = roots(ids, links)
    # rows of one id that are not linked share a node only by name
    out = Counter()
    for i, s in sets:
        c = i if i is None or not s else found[i]
        out[(i, len(s), c, i is None or c == i)] += 1
    return out


def repeats(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Removed spans of each text."""
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        marks = bytearray(len(t) + 1)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                marks[i : i + length] = b"\1" * length
        edges = [i for i in range(len(marks)) if marks[i] != (marks[i - 1] if i else 0)]
        out.append(list(zip(edges[::2], edges[1::2], strict=True)))
    return out


class Ppm:
    """Escape method C without exclusions, by dictionaries."""

    def __init__(self, texts: list[str], order: int, least: int) -> None:
        self.order, self.next = order, {}
        for text in texts:
            data = b"\n" * order + text.encode()
            for i in range(order, len(data)):
                for k in range(order + 1):
                    self.next.setdefault(data[i - k : i], Counter())[data[i]] += 1
        self.next = {c: n for c, n in self.next.items() if not c or sum(n.values()) >= least}

    def bits(self, text: str) -> float:
        data, total = b"\n" * self.order + text.encode(), 0.0
        for i in range(self.order, len(data)):
            for k in range(self.order, -1, -1):
                seen = self.next.get(data[i - k : i])
                if seen is None:
                    continue
                n, kinds = sum(seen.values()), len(seen)
                if seen[data[i]]:
                    total += math.log2((n + kinds) / seen[data[i]])
                    break
                total += math.log2((n + kinds) / kinds)
            else:
                total += 8
        return total


def without_shared_lines(rows: list[tuple], min_sites: int, spare_whole: bool = False) -> list[str | None]:
    """New texts of rows (text, site)."""
    sites: dict[str, set] = {}
    for text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(" \t\r") and site is not None:
                sites.setdefault(line.strip(" \t\r"), set()).add(site)
    shared = {x for x, s in sites.items() if len(s) >= min_sites}
    out = []
    for text, _ in rows:
        new = None if text is None else "\n".join(x for x in text.split("\n") if x.strip(" \t\r") not in shared)
        out.append(text if spare_whole and new is not None and not new.strip(" \t\r\n") else new)
    return out


def mixture(rows: list[tuple], weights: tuple, limit: int) -> tuple[dict, list[int]]:
    """Targets by source and copies of rows (id, size, source), by shares handed out again and again."""
    size = Counter()
    for _, n, source in rows:
        size[source] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full: set = set()
    while True:
        rest = sum(size.values()) - sum(limit * size[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        target = {s: float(limit * size[s]) if s in full else rest / free * weight[s] for s in order}
        over = {s for s in order if s not in full and target[s] >= limit * size[s]}
        if not over:
            break
        full |= over
    copies, at = [0] * len(rows), Counter()
    for i in sorted(range(len(rows)), key=lambda i: (hashed(rows[i][0]), rows[i][0] or 0, rows[i][1])):
        _, n, s = rows[i]
        if size[s]:
            copies[i] = max(0, math.ceil((2 * target[s] - 2 * at[s] - n) / (2 * size[s])))
        at[s] += n
    return target, copies


def hashed(doc_id: int | None) -> str:
    return "" if doc_id is None else hashlib.md5(str(doc_id).encode()).hexdigest()
