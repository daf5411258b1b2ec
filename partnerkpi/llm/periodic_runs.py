"""Periodic runs of words: stretches that repeat a short unit, found by uniting suffix classes by decreasing LCP.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), of at least ``min_words`` words and
``min_repeats`` periods, that no neighbouring word extends. In a run of length l the suffixes at its start s and at s + q
share l - q words, so only suffixes that share ``min_words * (min_repeats - 1) / min_repeats`` words or more matter:

1. Words that lie in no repeated window of so many words are cut away (the rest of a text is a string of kept stretches with
   a separator of its own after each, which keeps all longer common prefixes).
2. Prefix doubling sorts the suffixes of what is left; ranks of each doubling give the common prefix (LCP) of neighbours.
3. Neighbours in suffix order are united by decreasing LCP with union-find; every class is an ordered set of positions, the
   smaller set is put into the larger, and positions i < j that become adjacent there at LCP L with j - i <= L seed the run
   [i, j + L) of period j - i. Nothing between them shares L words, so the period is the smallest one; the word before i
   decides whether the seed is the start of its run, so each run comes out once.

A text is one row and is worked on in one task, with those of its block (0.5 MB); no shuffle. Memory is about 4 bytes times
log2 of the longest repeat for each word inside repeated windows. Words are compared by 64-bit hashes, verified byte by byte
for all words that take part.

Defined results: null, empty and blank texts have no words, no runs and an empty collapsed text; repeated rows count each;
other columns stay as they are (one of the result's name is replaced).
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .wordscan import Block, blocks, doc_of, gram_hashes, mixed, span_hashes

RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def same_spans(data: np.ndarray, s0: np.ndarray, e0: np.ndarray, s1: np.ndarray, e1: np.ndarray) -> np.ndarray:
    """Whether data[s0:e0] equals data[s1:e1], for many pairs of spans."""
    size = e0 - s0
    same = size == (e1 - s1)
    size = np.where(same, size, 0)
    pair = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
    same[pair[data[s0[pair] + at] != data[s1[pair] + at]]] = False
    return same


def _symbols(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Small numbers that are equal where the words are equal, given hashes of the words."""
    _, sample, symbol = np.unique(keys, return_index=True, return_inverse=True)
    if same_spans(data, starts, ends, starts[sample[symbol]], ends[sample[symbol]]).all():
        return symbol, len(sample)
    seen: dict[tuple[int, bytes], int] = {}  # two words with one hash: number the words themselves
    named = [seen.setdefault((int(k), data[s:e].tobytes()), len(seen)) for k, s, e in zip(keys, starts, ends, strict=True)]
    return np.array(named, np.int64), len(seen)


def suffix_neighbours(seq: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of a sequence of numbers below ``size``, and the common prefix of each suffix with the next one."""
    n = len(seq)
    kind = np.int32 if max(n, size) < (1 << 31) - 2 else np.int64
    levels = [np.unique(seq, return_inverse=True)[1].astype(kind)]
    step, order = 1, np.argsort(levels[0], kind="stable")
    while levels[-1].max(initial=0) < n - 1:
        rank = levels[-1]
        key = rank.astype(np.int64) * (n + 1)
        key[: n - step] += rank[step:] + np.int64(1)
        order = np.argsort(key, kind="stable")
        nxt = np.zeros(n, kind)
        nxt[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        levels.append(nxt)
        step *= 2
    a, b = order[:-1], order[1:]
    lcp = np.zeros(max(n - 1, 0), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        at = np.flatnonzero(np.maximum(a, b) + lcp < n)
        same = levels[k][a[at] + lcp[at]] == levels[k][b[at] + lcp[at]]
        lcp[at[same]] += 1 << k
    return order, lcp


def kruskal_seeds(place: np.ndarray, lcp: np.ndarray, least: int, min_words: int, min_repeats: int) -> np.ndarray:
    """(i, period, LCP) of positions that become adjacent in a class at a distance that makes a long enough run.

    ``place``: the position of each suffix, in suffix order (two suffixes that share ``least`` words are of one text).
    """
    strong = lcp >= least
    alone = strong.copy()  # classes of two suffixes need no sets
    alone[1:] &= ~strong[:-1]
    alone[:-1] &= ~strong[1:]
    two = np.flatnonzero(alone)
    near, far = np.minimum(place[two], place[two + 1]), np.maximum(place[two], place[two + 1])
    gap, shared = far - near, lcp[two]
    fits = (gap * (min_repeats - 1) <= shared) & (gap + shared >= min_words)
    seeds = [np.stack([near[fits], gap[fits], shared[fits]], axis=1)]

    rest = np.flatnonzero(strong & ~alone)
    rest = rest[np.argsort(-lcp[rest], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    found: list[tuple[int, int, int]] = []
    for x, shared in zip(rest.tolist(), lcp[rest].tolist(), strict=True):
        a, b = root(x), root(x + 1)
        large = members.pop(a, None) or [int(place[a])]
        small = members.pop(b, None) or [int(place[b])]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[b] = a
        before = -1
        reach = shared // (min_repeats - 1)
        for k, i in enumerate(small):
            at = bisect_left(large, i)
            large.insert(at, i)
            if at and large[at - 1] != before and (d := i - large[at - 1]) <= reach and d + shared >= min_words:
                found.append((i - d, d, shared))
            if at + 1 < len(large) and (d := large[at + 1] - i) <= reach and d + shared >= min_words:
                if k + 1 == len(small) or small[k + 1] > i + d:
                    found.append((i, d, shared))
            before = i
        members[a] = large
    seeds.append(np.array(found, np.int64).reshape(-1, 3))
    return np.concatenate(seeds)


def block_runs(b: Block, words: tuple, min_words: int, min_repeats: int) -> np.ndarray:
    """(first word, length, period) of every run of a block's texts, by first word, then period; words count through."""
    starts, ends, first = words
    least = -(-min_words * (min_repeats - 1) // min_repeats)
    none = np.empty((0, 3), np.int64)
    n = len(starts)
    if n <= least:
        return none
    doc = doc_of(first)
    keys = mixed(span_hashes(b.data, starts, ends) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    grams = gram_hashes(keys, least)
    at = np.flatnonzero(doc[: len(grams)] == doc[least - 1 :])
    order = at[np.argsort(grams[at], kind="stable")]
    same = grams[order[1:]] == grams[order[:-1]]
    again = np.zeros(n + 1, np.int64)
    for twice in (order[1:][same], order[:-1][same]):
        again[twice] = 1
    at = np.flatnonzero(again)
    if not len(at):
        return none
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + least, -1)
    held = np.flatnonzero(np.cumsum(cover)[:n])
    symbol, size = _symbols(b.data, starts[held], ends[held], keys[held])
    gap = np.flatnonzero((np.diff(held) > 1) | (doc[held[1:]] != doc[held[:-1]])) + 1
    cuts = np.append(gap, len(held))  # a separator after each stretch
    seq = np.insert(symbol, cuts, size + np.arange(len(cuts)))
    place = np.insert(held, cuts, -1)
    suffixes, lcp = suffix_neighbours(seq, size + len(cuts))
    seeds = kruskal_seeds(place[suffixes], lcp, least, min_words, min_repeats)
    i, period, shared = seeds[:, 0], seeds[:, 1], seeds[:, 2]
    inner = np.flatnonzero(i > first[doc[i]])
    left, right = i[inner] - 1, i[inner] + period[inner] - 1
    inner = inner[same_spans(b.data, starts[left], ends[left], starts[right], ends[right])]
    start = np.ones(len(seeds), bool)
    start[inner] = False  # the word before belongs to the run too
    runs = np.stack([i, period + shared, period], axis=1)[start]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(b: Block, words: tuple, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of each text, one space between them, and the size of each text's part."""
    starts, ends, first = words
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(cover)[:-1] == 0)
    doc = doc_of(first)[kept]
    edge = np.zeros(len(b.data) + 1, np.int8)
    edge[starts[kept]] += 1
    edge[ends[kept]] -= 1
    mask = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    inner = ends[kept[:-1][doc[1:] == doc[:-1]]]  # a word with a kept one after it ends at a space of its text
    mask[inner] = True
    data = b.data.copy()
    data[inner] = 32
    return data[mask], b.row_sums(mask)


def runs_column(text: str | Column = "text", min_words: int = 24, min_repeats: int = 3) -> Column:
    """Struct of the word count, the runs (by start, then period) and the text without the repeats of its runs."""
    if min_repeats < 2 or min_words < 2:
        raise ValueError("a run has two words and two repeats at least")

    @F.arrow_udf(RESULT)
    def scan(texts: pa.Array) -> pa.Array:
        n_words, n_runs, found, kept, sizes = [], [], [], [], []
        for b in blocks(texts):
            words = b.words()
            runs = block_runs(b, words, min_words, min_repeats)
            first = words[2]
            row = np.searchsorted(first, runs[:, 0], "right") - 1
            data, size = _collapsed(b, words, runs)
            runs[:, 0] -= first[row]
            n_words.append(np.diff(first))
            n_runs.append(np.bincount(row, minlength=b.rows))
            found.append(runs)
            kept.append(data)
            sizes.append(size)
        if not n_words:
            return pa.array([], pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))), ("collapsed", pa.string())]))
        runs, ends = np.concatenate(found), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        cells = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(runs[:, k])) for k in range(3)], ["start", "length", "period"])
        bounds = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(n_runs))]).astype(np.int32))
        wide = ends[-1] >= 1 << 31
        flat = pa.py_buffer(np.concatenate(kept))
        collapsed = (pa.LargeStringArray if wide else pa.StringArray).from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64 if wide else np.int32)), flat)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(n_words)), pa.ListArray.from_arrays(bounds, cells), collapsed], ["n_words", "runs", "collapsed"])

    return scan((F.col(text) if isinstance(text, str) else text).cast("string"))


def with_runs(docs: DataFrame, text: str = "text", result: str = "periodic", min_words: int = 24, min_repeats: int = 3) -> DataFrame:
    """``docs`` with a struct column of each text's word count, runs and collapsed text."""
    return docs.withColumn(result, runs_column(text, min_words, min_repeats))


def strongest(runs: Column) -> Column:
    """The run of greatest length / period (compared exactly; ties: smallest start, then period); null without runs."""
    first = F.get(runs, F.lit(0))
    return F.aggregate(
        runs, first, lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best)
    )


def runs_text(runs: Column) -> Column:
    """One line ``start,length,period`` for each run."""
    def line(r: Column) -> Column:
        return F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))

    return F.array_join(F.transform(runs, line), "")
