"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Kernel: strings are compared by the subsequences of three letters that they share, each occurrence weighted by
``DECAY`` to the power of the span it covers (spans up to ``MAX_SPAN``); an inserted or skipped letter thus costs weight,
not the match. It is normalised by a function of each string's length, which keeps it positive semidefinite. A text is
compared by overlapping strings of bounded length that cover all of it: its words, every run of two or three neighbouring
words read as one string across the spaces (longer phrases by their runs), and windows of words of over ``LONG`` letters,
as texts without spaces have them. Punctuation inside a word is dropped, and runs of single letters are read as one word,
so spaced-out or punctuated insults meet the kernel as one string.

Nyström: strings become vectors over landmark strings (likely insults and ordinary words of the training texts), and
a linear SVM with squared hinge loss is trained on them. Since subsequences of three letters over 64 letter classes can
be listed, the machine folds into one weight per subsequence, and scoring is a look-up per subsequence occurrence,
vectorised over all strings of a batch; overlapping strings share their sums.

Labels name documents, so the strings of a toxic document are labelled in rounds (multiple-instance learning): all
strings of clean documents are clean; of a toxic document those are toxic that the machine of the round before scores
beyond half the margin and that clean documents have at most a tenth as often (at first those that tell a document best
from clean ones, whatever the size of the sample), the others are left out; a toxic document without any, as a wrong
label gives, teaches nothing. A run counts only if it tells more than each of its words, and is in two toxic documents
or more. Each round also adds the clean words and runs that it scored highest. A document's score is its highest
string's, mapped to the chance of label 1.

Training uses a bounded sample: ``max_docs`` labelled rows of each class, least by hash, of up to ``max_chars``
characters. Scoring covers every string of every text.

Defined results: null and empty texts and texts without three letters get a clean text's score;
without training rows of both classes, or without a word of three letters in toxic ones, every score is 0; repeated rows score alike; null labels do not train; labels,
language, source and ids are never read for a score; extra columns are kept and ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .wordscan import BLOCK_BYTES, blocks, doc_of, span_hashes

DECAY = 0.6
MAX_SPAN = 6
#: (distance to the second letter, to the third).
_STEPS = [(a, b) for a in range(1, MAX_SPAN - 1) for b in range(a + 1, MAX_SPAN)]
LANDMARKS = 160
ROUNDS = 4
MAX_DOCS = 2000
MAX_CHARS = 20_000
#: A toxic word's share of the clean documents is at most this part of its share of the toxic ones (labels may be wrong).
CLEAN_PART = 0.1
#: Neighbouring words compared as one string, across the spaces.
RUN = 3
#: Words of more letters are also compared by windows of so many letters, every ``PART_STEP`` letters.
LONG, PARTS, PART_STEP = 24, (6, 9, 12), 3
#: Clean words a round trains on.
MAX_WORDS = 20_000

# Letter classes: a-z, 0-9, 26 classes for all bytes beyond ASCII, a word's begin and end; 255 is no letter.
_BEGIN, _END = 62, 63
_CLASS = np.full(256, 255, np.uint8)
_CLASS[97:123] = np.arange(26)
_CLASS[65:91] = np.arange(26)
_CLASS[48:58] = 26 + np.arange(10)
_CLASS[128:] = 36 + np.arange(128) % 26
CODES = 1 << 18


def _length_norms(top: int = 4096) -> np.ndarray:
    """Square root of the summed squared weights of all occurrences in a string of n letters; 1 where there are none."""
    n = np.arange(top)
    total = sum(np.maximum(n - b, 0) * DECAY ** (2 * (b + 1)) for _, b in _STEPS)
    return np.where(total > 0, np.sqrt(total), 1.0)


_NORMS = _length_norms()


def _norm(length: np.ndarray) -> np.ndarray:
    top = len(_NORMS) - 1
    each = sum(DECAY ** (2 * (b + 1)) for _, b in _STEPS)  # every further letter starts all occurrences once more
    return np.where(length <= top, _NORMS[np.minimum(length, top)], np.sqrt(_NORMS[top] ** 2 + np.maximum(length - top, 0) * each))


def letter_words(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letter classes of all words in a row, with a mark before and after each; where each word begins, and the end; row of each)."""
    starts, ends, first = block.words()
    letters = _CLASS[block.data]
    keep = letters != 255
    upto = np.zeros(len(letters) + 1, np.int64)
    np.cumsum(keep, out=upto[1:])
    lo, hi = upto[starts], upto[ends]
    doc = doc_of(first)
    single = hi - lo == 1
    joins = np.zeros(len(lo), bool)
    joins[1:] = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
    own = np.flatnonzero(~joins & (hi > lo))
    start = np.append(lo[own], upto[-1])
    length = np.diff(start)
    marked = np.empty(upto[-1] + 2 * len(own), np.uint8)  # each word between its marks
    bounds = start + 2 * np.arange(len(start))
    marked[np.arange(upto[-1]) + 2 * np.repeat(np.arange(len(own)), length) + 1] = letters[keep]
    marked[bounds[:-1]] = _BEGIN
    marked[bounds[1:] - 1] = _END
    return marked, bounds, doc[own]


def _occurrences(letters: np.ndarray, bounds: np.ndarray):
    """Yield (code, weight, usable) of the subsequence occurrences that start at each letter, one step pair at a time."""
    n = len(letters)
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)  # letters from here to the word's end
    left = np.minimum(left, MAX_SPAN).astype(np.uint8)
    wide = np.concatenate([letters, np.zeros(MAX_SPAN, np.uint8)]).astype(np.int32)
    head = wide[:n] << 12
    for a, b in _STEPS:
        yield head + (wide[a : a + n] << 6) + wide[b : b + n], DECAY ** (b + 1), left > b


def word_scores(letters: np.ndarray, bounds: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each word's subsequences, over its length norm."""
    at = np.zeros(len(letters), np.float32)
    for code, w, usable in _occurrences(letters, bounds):
        at += weights[code] * (usable * np.float32(w))
    c = np.zeros(len(letters) + 1)
    np.cumsum(at, out=c[1:])
    return (c[bounds[1:]] - c[bounds[:-1]]) / _norm(np.diff(bounds))


@dataclass
class Strings:
    """All strings of a block: words, runs of words, windows of long words, as ranges of ``body`` (the words' letters)."""

    body: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    word: np.ndarray  # first word
    size: np.ndarray  # number of words, 0 for a window
    at: np.ndarray  # where each word begins, and the end

    def marked(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _marked(self.body, self.start[i], self.end[i])


def _marked(body: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of letters in a row, each between its marks, and where each begins, and the end."""
    length = end - start
    bounds = np.concatenate([[0], np.cumsum(length + 2)])
    out = np.empty(bounds[-1], np.uint8)
    nth = np.arange(int(length.sum()))
    out[nth + np.repeat(2 * np.arange(len(length)) + 1, length)] = body[nth + np.repeat(start - np.cumsum(length) + length, length)]
    out[bounds[:-1]] = _BEGIN
    out[bounds[1:] - 1] = _END
    return out, bounds


def strings(block) -> Strings:
    letters, bounds, doc = letter_words(block)
    at = bounds - 2 * np.arange(len(bounds))
    start, end, row, word, size = ([] for _ in range(5))
    for k in range(1, RUN + 1):
        i = np.arange(max(len(doc) - k + 1, 0))
        if k > 1:
            i = i[(doc[i] == doc[i + k - 1]) & (at[i + k] - at[i] <= RUN * LONG)]
        for to, v in zip((start, end, row, word, size), (at[i], at[i + k], doc[i], i, np.full(len(i), k)), strict=True):
            to.append(v)
    big = np.flatnonzero(np.diff(at) > LONG)
    for width in PARTS if len(big) else ():
        n = -(-(at[big + 1] - at[big] - width) // PART_STEP) + 1  # the last window ends with the word
        i = np.repeat(big, n)
        nth = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        s = np.minimum(at[i] + nth * PART_STEP, at[i + 1] - width)
        for to, v in zip((start, end, row, word, size), (s, s + width, doc[i], i, np.zeros(len(i), np.int64)), strict=True):
            to.append(v)
    return Strings(letters[letters < _BEGIN], *(np.concatenate(x) for x in (start, end, row, word, size)), at)


def string_scores(x: Strings, weights: np.ndarray) -> np.ndarray:
    """``word_scores`` of all strings, from sums that overlapping strings share."""
    n, length = len(x.body), x.end - x.start
    out = np.zeros(len(length))
    wide = np.concatenate([x.body, np.zeros(MAX_SPAN, np.uint8)]).astype(np.int32)
    for b in range(2, MAX_SPAN):
        at = np.zeros(n, np.float32)
        for a in range(1, b):
            at += weights[(wide[:n] << 12) + (wide[a : a + n] << 6) + wide[b : b + n]]
        c = np.zeros(n + 1)
        np.cumsum(at * np.float32(DECAY ** (b + 1)), out=c[1:])
        out += c[np.maximum(x.end - b, x.start)] - c[x.start]
    for place, head in ((x.start, True), (x.end, False)):  # subsequences with a mark
        here = np.zeros(n + 1, bool)
        here[place] = True
        here = np.flatnonzero(here)
        v = np.zeros(n + 1)
        for a, b in _STEPS:
            if head:
                code = (_BEGIN << 12) + (wide[here + a - 1] << 6) + wide[here + b - 1]
            else:
                code = (wide[np.maximum(here - b, 0)] << 12) + (wide[np.maximum(here - b + a, 0)] << 6) + _END
            v[here] += weights[code] * DECAY ** (b + 1)
        out += v[place]
    out /= _norm(length + 2)
    short = np.flatnonzero(length < MAX_SPAN - 1)  # both marks may be in one span
    if len(short):
        out[short] = word_scores(*x.marked(short), weights)
    return out


def _features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse kernel features of cleaned words: (word, code, value), normalised by length."""
    letters = np.frombuffer(b"".join(words), np.uint8)
    length = np.fromiter(map(len, words), np.int64, len(words))
    bounds = np.concatenate([[0], np.cumsum(length)])
    owner = np.repeat(np.arange(len(words)), length)
    parts = [(owner[u], c[u], np.full(int(u.sum()), w)) for c, w, u in _occurrences(letters, bounds)]
    word, code, value = (np.concatenate(p) for p in zip(*parts, strict=True))
    return word, code, value / _norm(length)[word]


class Landmarks:
    """Landmark strings with their kernel features, over the subsequences that any of them has."""

    def __init__(self, words: list[bytes]):
        word, code, value = _features(words)
        self.words = words
        self.codes = np.unique(code)
        self.table = np.zeros((len(self.codes), len(words)), np.float32)
        np.add.at(self.table, (np.searchsorted(self.codes, code), word), value)

    def kernel(self, words: list[bytes], at_once: int = 500) -> np.ndarray:
        """Kernel values [words, landmarks]."""
        out = np.zeros((len(words), len(self.words)))
        for i in range(0, len(words), at_once):
            part = words[i : i + at_once]
            word, code, value = _features(part)
            place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[place] == code
            x = np.zeros((len(part), len(self.codes)), np.float32)
            np.add.at(x, (word[hit], place[hit]), value[hit])
            out[i : i + at_once] = x @ self.table
        return out

    def folded(self, w: np.ndarray) -> np.ndarray:
        """One weight per subsequence for a linear function of the kernel values."""
        out = np.zeros(CODES, np.float32)
        out[self.codes] = self.table @ w
        return out


@dataclass
class ToxicModel:
    """One weight per subsequence, the SVM's bias, and the logistic curve of a document's highest string."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def chance(self, top: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * top + self.shift, -500, 500)))


def _top_scores(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """Highest string score of each text."""
    out = np.full(len(texts), bias)
    for block in blocks(texts, BLOCK_BYTES):
        x = strings(block)
        if len(x.row):
            np.maximum.at(out, x.row + block.first_row, string_scores(x, weights) + bias)
    return out


def svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1.0, steps: int = 25) -> tuple[np.ndarray, float]:
    """Squared-hinge SVM in the primal by Newton steps; the bias is an unpenalised last feature."""
    x = np.concatenate([z, np.ones((len(z), 1))], axis=1)
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        slack = 1 - y * (x @ w)
        on = slack > 0
        xs, c = x[on], weight[on]
        g = ridge * w - xs.T @ (c * y[on] * slack[on])
        h = np.diag(ridge) + (xs * c[:, None]).T @ xs
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _told(toxic: int, clean: int, n1: int, n0: int) -> float:
    """How well a word tells toxic documents from clean ones: log-likelihood ratio of its counts, below 0 where clean ones have it more."""
    expected = (toxic + clean) * n1 / (n1 + n0)
    ratio = toxic * np.log(toxic / expected) + (clean * np.log(clean / (toxic + clean - expected)) if clean else 0.0)
    return float(np.copysign(ratio, toxic - expected))


def _best_words(bags: list[set[bytes]], count: list[Counter], n1: int, n0: int) -> tuple[set[bytes], dict[bytes, float], list[bytes]]:
    """(words rare in clean documents, how well each word tells, the best rare word of each bag that has one)."""
    rare = {w for w, k in count[1].items() if count[0][w] * n1 <= CLEAN_PART * k * n0}
    told = {w: _told(k, count[0][w], n1, n0) for w, k in count[1].items()}
    return rare, told, [max(bag & rare, key=lambda w: (told[w], w)) for bag in bags if not rare.isdisjoint(bag)]


def _run_hashes(texts: pa.Array, known: np.ndarray | None = None):
    """Yield (first row, strings, those that are no words, and their hash or its place in ``known``) of each block."""
    for block in blocks(texts):
        x = strings(block)
        i = np.flatnonzero((x.size != 1) & (x.end - x.start >= 3))
        h = span_hashes(x.body, x.start[i], x.end[i])
        if known is not None:
            place = np.minimum(np.searchsorted(known, h), len(known) - 1)
            i, h = i[known[place] == h], place[known[place] == h]
        yield block.first_row, x, i, h


def _once(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The values, each once a row."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    return value[np.concatenate([[True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])])] if len(value) else value


def _runs(toxic: pa.Array, clean: pa.Array) -> tuple[list[set[bytes]], list[Counter], dict[bytes, list[bytes]]]:
    """Runs and windows of two or more toxic texts that are rare in clean ones: (of each toxic text, counts, words of each)."""
    bags: list[set[bytes]] = [set() for _ in range(len(toxic))]
    count, parts = [Counter(), Counter()], {}
    found = [_once(x.row[i], h) for _, x, i, h in _run_hashes(toxic)]
    known, k = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64), np.empty(0, int))
    del found
    known, k = known[k > 1], k[k > 1]
    c = np.zeros(len(known), np.int64)
    for _, x, i, h in _run_hashes(clean, known) if len(known) else ():
        c += np.bincount(_once(x.row[i], h), minlength=len(known))
    rare = c * len(toxic) <= CLEAN_PART * k * len(clean)
    known, k, c = known[rare], k[rare], c[rare]
    name: dict[int, bytes] = {}
    for row, x, i, h in _run_hashes(toxic, known) if len(known) else ():
        letters, bounds = x.marked(i)
        raw = letters.tobytes()
        body = x.body.tobytes()
        for j, (s, p) in enumerate(zip(i.tolist(), h.tolist(), strict=True)):
            if p not in name:
                name[p] = run = raw[bounds[j] : bounds[j + 1]]
                count[1][run], count[0][run] = int(k[p]), int(c[p])
                w = int(x.word[s])
                cut = x.at[w : w + int(x.size[s]) + 1].tolist()
                parts[run] = [bytes([_BEGIN]) + body[a:b] + bytes([_END]) for a, b in zip(cut, cut[1:], strict=False)]
            bags[int(x.row[s]) + row].add(name[p])
    return bags, count, parts


def _instances(texts: pa.Array, bags: list[set[bytes]], is_toxic: np.ndarray) -> tuple[list[set[bytes]], list[Counter], int, int]:
    """(strings of each toxic text, counts in texts of both classes, sizes): words, and the runs that tell more than each of their words."""
    n1, n0 = int(is_toxic.sum()), int((~is_toxic).sum())
    count = [Counter(), Counter()]
    for bag, label in zip(bags, is_toxic, strict=True):
        count[int(label)].update(bag)
    runs, more, parts = _runs(texts.filter(pa.array(is_toxic)), texts.filter(pa.array(~is_toxic)))
    told = {w: _told(k, count[0][w], n1, n0) for w, k in count[1].items()}
    telling = {r for r, ws in parts.items() if r not in told and _told(more[1][r], more[0][r], n1, n0) > max((told.get(w, 0.0) for w in ws), default=0.0)}
    for r in telling:
        count[1][r], count[0][r] = more[1][r], more[0][r]
    own = [bags[i] for i in np.flatnonzero(is_toxic)]
    return [bag | (run & telling) for bag, run in zip(own, runs, strict=True)], count, n1, n0


def _hard_runs(texts: pa.Array, weights: np.ndarray, most: int) -> list[bytes]:
    """The highest runs of the texts, one of each text."""
    got: list[tuple[float, bytes]] = []
    for block in blocks(texts):
        x = strings(block)
        i = np.flatnonzero((x.size != 1) & (x.end - x.start >= 3))
        v = string_scores(x, weights)[i]
        order = np.lexsort((v, x.row[i]))
        last = order[np.flatnonzero(np.diff(np.append(x.row[i][order], -1)))]
        letters, bounds = x.marked(i[last])
        raw = letters.tobytes()
        got += [(-float(v[n]), raw[bounds[j] : bounds[j + 1]]) for j, n in enumerate(last)]
    return [w for _, w in sorted(got)[:most]]


def train(texts: list[str], labels: list[int], landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> ToxicModel:
    """Multiple-instance training on whole labelled documents (see the module text)."""
    seen: dict[str, int] = {}
    for t, y in zip(texts, labels, strict=True):
        seen[t] = max(y, seen.get(t, 0))  # copies of one text count once
    y = np.array(list(seen.values()))
    if not len(y) or y.min() == y.max():
        return ToxicModel(np.zeros(CODES, np.float32), 0.0, 0.0, -np.inf)
    arr = pa.array(list(seen), pa.string())
    bags: list[list[bytes]] = []
    for block in blocks(arr):
        letters, bounds, doc = letter_words(block)
        raw = letters.tobytes()
        rows: list[set[bytes]] = [set() for _ in range(block.rows)]
        for d, s, e in zip(doc.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if e - s >= 5:  # three letters and the marks
                rows[d].add(raw[s:e])
        bags.extend(sorted(r) for r in rows)
    sets = [set(bag) for bag in bags]
    bad, count, n1, n0 = _instances(arr, sets, y == 1)
    toxic = [sorted(bag) for bag in bad if bag]
    rare, told, best = _best_words(bad, count, n1, n0)
    part = round(n0 * n1 / (n1 + n0))  # what clean documents dealt as if so many were toxic would give by chance
    fine = arr.filter(pa.array(y == 0))
    nth = np.arange(n0)
    chosen, dealt, m1, m0 = _instances(fine, [b for b, label in zip(sets, y, strict=True) if not label], nth * part // n0 != (nth + 1) * part // n0)
    _, luck, lucky = _best_words(chosen, dealt, m1, m0)
    chance = np.quantile([luck[w] for w in lucky], 0.95) if lucky else 0.0
    seeds = {w for w in best if told[w] > chance} or set(best) or {w for w, t in told.items() if t > 0} or set(count[1])
    witness = [w for bag in toxic for w in bag if w in seeds]
    if not witness:  # no toxic document has a word of three letters
        return ToxicModel(np.zeros(CODES, np.float32), 0.0, 0.0, -np.inf)
    odds = {w: np.log((k + 0.5) / (n1 + 1)) - np.log((count[0][w] + 0.5) / (n0 + 1)) for w, k in count[1].items()}
    clean = sorted(count[0], key=lambda w: (-count[0][w], w))
    toxic_first = sorted(odds, key=lambda w: (w not in seeds, -odds[w], w))[: landmarks // 2]
    step = max(1, len(clean) // (landmarks - len(toxic_first)))
    marks = Landmarks(sorted(set(toxic_first) | set(clean[::step][: landmarks - len(toxic_first)])))
    base = marks.kernel(marks.words)
    val, vec = np.linalg.eigh(base)
    root = vec @ np.diag(1 / np.sqrt(np.maximum(val, 1e-3))) @ vec.T  # K^(-1/2), small eigenvalues held up
    common = clean[: MAX_WORDS // 4]
    negatives = sorted(set(common) | set(clean[:: max(1, len(clean) // (MAX_WORDS - len(common)))]))
    weights, bias = np.zeros(CODES, np.float32), 0.0
    all_clean = list(count[0])
    for _ in range(rounds):
        pos = Counter(witness)
        words = sorted(pos)
        force = np.sqrt([pos[w] for w in words])
        z = marks.kernel(words + negatives) @ root
        label = np.concatenate([np.ones(len(words)), -np.ones(len(negatives))])
        weight = np.concatenate([force, np.sqrt([max(count[0][w], 1) for w in negatives])])
        weight[: len(words)] *= weight[len(words) :].sum() / weight[: len(words)].sum()
        w, bias = svm(z, label, weight)
        weights = marks.folded(root @ w)
        scored = _word_values(all_clean, weights)
        hard = [all_clean[i] for i in np.argsort(-scored, kind="stable")[: MAX_WORDS // 20]]
        negatives = sorted(set(negatives) | set(hard) | (set(_hard_runs(fine, weights, MAX_WORDS // 20)) - rare))
        witness = []
        for bag in toxic:
            v = _word_values(bag, weights)
            witness += [bag[i] for i in np.flatnonzero(v + bias > 0.5) if bag[i] in rare]
        if not witness:
            break
    top = _top_scores(arr, weights, bias)
    slope, shift = _logistic(top, y.astype(float))
    return ToxicModel(weights, bias, slope, shift)


def _word_values(words: list[bytes], weights: np.ndarray) -> np.ndarray:
    letters = np.frombuffer(b"".join(words), np.uint8)
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
    return word_scores(letters, bounds, weights)


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    z = np.stack([x, np.ones(len(x))], axis=1)
    b = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        g = z.T @ (y - p) - 0.1 * b
        h = (z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(2)
        b = b + np.clip(np.linalg.solve(h, g), -5, 5)
    return float(b[0]), float(b[1])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> ToxicModel:
    """Train on at most ``max_docs`` labelled rows of each class (``labels``: doc_id and a 0/1 column)."""
    known = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).alias("__y"))
    each = [known.where(F.col("__y") == v).orderBy(F.xxhash64("__id"), "__id").limit(max_docs) for v in (0, 1)]
    sample = each[0].unionAll(each[1])
    got = (
        docs.join(F.broadcast(sample), F.col(doc_id) == F.col("__id"))
        .where(F.char_length(text_or_empty(text)) <= max_chars)
        .select(F.col("__id").cast("string").alias("id"), text_or_empty(text).alias("t"), F.col("__y").cast("int").alias("y"))
        .toArrow()
        .sort_by([("id", "ascending"), ("t", "ascending")])
    )
    return train(got.column("t").to_pylist(), got.column("y").to_pylist())


def score_column(model: ToxicModel, text: str = "text") -> Column:
    """Chance that a text is toxic, 0 to 1 (the model, 1 MB of weights, travels with the function)."""

    @F.arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        return pa.array(model.chance(_top_scores(texts, model.weights, model.bias)), pa.float64())

    return toxicity(F.col(text).cast("string"))
