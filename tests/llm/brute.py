"""Plain Python versions of the operators' results, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict

import xxhash


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def simhash(text: str | None, shingle: int = 4) -> int:
    w = words(text)
    if not w:
        return 0
    grams = [b" ".join(w)] if len(w) < shingle else [b" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[int], ids: list, max_bits: int = 4) -> list:
    """Least id of each row's component over links of at most ``max_bits`` differing bits."""
    distinct = sorted(set(prints))
    parent = {p: p for p in distinct}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    least: dict[int, int] = {}
    for p, d in zip(prints, ids, strict=True):
        if d is not None:
            least[find(p)] = min(d, least.get(find(p), d))
    return [least.get(find(p)) for p in prints]


def shared_windows(texts: dict[int, str | None], n: int) -> dict[tuple, set[int]]:
    held = defaultdict(set)
    for d, t in texts.items():
        w = words(t)
        for i in range(len(w) - n + 1):
            held[tuple(w[i : i + n])].add(d)
    return held


def passages(texts: dict[int, str | None], n: int = 50) -> set[tuple[int, int, int]]:
    """(doc, first word, end word) of the runs of words that lie in windows which another document holds, overlaps joined."""
    held = shared_windows(texts, n)
    out = set()
    for d, t in texts.items():
        w = words(t)
        spans: list[list[int]] = []
        for i in range(len(w) - n + 1):
            if len(held[tuple(w[i : i + n])]) > 1:
                if spans and (i == spans[-1][2] + 1 or i < spans[-1][1]):
                    spans[-1][1:] = [i + n, i]
                else:
                    spans.append([i, i + n, i])
        out |= {(d, s, e) for s, e, _ in spans}
    return out


def cut(texts: dict[int, str | None], n: int = 50) -> dict[int, str]:
    """Texts without the words of windows that a document of less id holds; copies and emptied texts go."""
    held = shared_windows(texts, n)
    out = {}
    first: dict[str, int] = {}
    for d in sorted(texts):
        t = texts[d] or ""
        spots = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t.encode())]
        if len(spots) >= n and first.setdefault(t, d) != d:
            continue
        w = words(t)
        gone = set()
        for i in range(len(w) - n + 1):
            if min(held[tuple(w[i : i + n])]) < d:
                gone |= set(range(i, i + n))
        if not gone:
            out[d] = texts[d]
            continue
        raw, kept, at = t.encode(), [], 0
        for i in sorted(gone):
            if i - 1 not in gone:
                kept.append(raw[at : spots[i][0]])
            at = spots[i][1]
        text = (b"".join(kept) + raw[at:]).decode()
        if text.strip(" "):
            out[d] = text
    return out


def item_words(text: str | None) -> list[str]:
    folded = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def hits(text: str | None, items: dict[int, str | None], n: int = 10) -> tuple[set[int], set[int]]:
    """(hit word positions, ids of the items with occurring windows)."""
    w = item_words(text)
    inside, found = set(), set()
    for item, t in items.items():
        g = item_words(t)
        k = min(n, len(g))
        windows = {tuple(g[i : i + k]) for i in range(len(g) - k + 1)} if k else set()
        for i in range(len(w) - k + 1 if k else 0):
            if tuple(w[i : i + k]) in windows:
                inside |= set(range(i, i + k))
                found.add(item)
    return inside, found
