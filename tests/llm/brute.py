"""Plain versions of the operators, one document after the other."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return SPACE_WORD.findall(text or "")


def low_words(text: str | None) -> list[str]:
    return WORD.findall(low(text))


def removed(rows: list[tuple], window: int = 13) -> list[tuple]:
    first: dict[tuple, float] = {}
    order = lambda x: math.inf if x is None else x
    split = [(order(d), words(t)) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, math.inf), d)
    out = []
    for (d, _), (o, w) in zip(rows, split, strict=True):
        gone = {i + j for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < o for j in range(window)}
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def contaminated(rows: list[tuple], items: list[tuple], size: int = 10) -> list[tuple]:
    windows = defaultdict(set)
    for item, text in items:
        w = low_words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i : i + size])].add(item)
    out = []
    for d, t in rows:
        w, hit, found = low_words(t), set(), set()
        for k, owners in windows.items():
            for i in range(len(w) - len(k) + 1):
                if tuple(w[i : i + len(k)]) == k:
                    hit |= set(range(i, i + len(k)))
                    found |= owners
        out.append((d, len(w), len(hit), ",".join(sorted(str(x) for x in found if x is not None)), bool(hit)))
    return out


def fingerprint(text: str | None) -> int:
    w = words(low(text))
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    counts = [0] * 64
    for x in s:
        h = xxhash.xxh64_intdigest(x.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(s))


def groups(values: list[int], radius: int = 2) -> list[int]:
    """For each value, the place of the first value it is linked to over any number of links."""
    root = list(range(len(values)))

    def find(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(values)):
        for j in range(i + 1, len(values)):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(values))]


def counts(text: str | None) -> tuple[int, ...]:
    w = words(text)
    lines = [x for x in (text or "").split("\n") if SPACE_WORD.search(x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    repeat = {i + j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeat)


def places(text: str | None, phrases: tuple) -> tuple[int, int | None, int | None, str]:
    w, hits, labels = low_words(text), [], set()
    for phrase, label in phrases:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        hits += at
        labels |= {label} if at else set()
    return len(hits), min(hits, default=None), max(hits, default=None), ",".join(sorted(labels))


def blocks(text: str | None, templates, containment: float) -> tuple[str, float]:
    """Labels and the best containment of all blocks of twice a template's words, 16 at least."""
    words, labels, best = low_words(text), set(), 0.0
    for t, label in templates:
        want, size = set(t.split()), max(2 * len(t.split()), 16)
        most = max(len(want & set(words[i : i + size])) for i in range(max(len(words) - size, 0) + 1))
        if most >= max(1, math.ceil(containment * len(want) - 1e-9)):
            labels.add(label)
            best = max(best, most / len(want))
    return ",".join(sorted(labels)), best
