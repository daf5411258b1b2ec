"""Language-model scores by online logistic context mixing, beside a unigram base score.

The scored stream of a text is its tokens: each word (A-Z lower-cased) with a space after it, then one end byte. Every
byte is coded as the binary decisions of its Huffman code, and each decision is predicted by several hashed contexts: the
last two bytes, the last four, and the current word's beginning. A predictor's stretched probability comes from the
counts of that context and decision in the training texts. A gate - which of the sparse contexts has been seen at all -
picks the weights that mix them in the logistic domain; the mixture is refined online: after every ``STRIDE`` bytes the
weights move along the coding error's gradient. Each text starts from the trained weights and carries its own through to
its end, so the score is a proper probability of the whole text, and its sum of bits over bytes gives bits per byte. Texts
of a block are coded side by side.

Training reads every training text three times: for (1) counts of every token and every stream byte, which make the
Huffman code, (2) for every hashed (context, decision) how often each bit came, (3) the mixing weights. The second are
fixed-size tables (``TABLE_BITS``): each task fills its own, and the tasks' tables are summed piece by piece, compressed,
before their stretched probabilities (13 MB) are gathered and broadcast. The weights minimise the coding cost of all
training decisions, each predicted by the tables without that one occurrence of it (26 MB of such predictions are
broadcast); tasks count how often each triple of predictions came, in steps of ``_COARSE``, and the driver fits the weights
to these counts, at most 2**18 of them. Equal bytes in equal contexts are counted first and looked up once. Token counts
grow with the corpus and stay distributed: the ``HEAD_WORDS`` most frequent are broadcast, every other token of every text
meets its count in a join.

Defined results: a null or empty text is its end token; repeated rows score alike, and all rows keep their number;
without any training text the counts are empty (base score from the add-one formula, model near one bit a decision);
a null doc_id counts as the empty id text; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, written
from .wordscan import _INV, FOLD, IS_SPACE, Block, blocks, doc_of, powers, running_hash, span_hashes

#: Bytes of a text between two moves of its weights.
STRIDE = 4
#: Bytes of texts scored together, and scanned together.
BLOCK, SCAN_BLOCK = 3 << 20, 64 << 10
#: Stream bytes whose equal contexts are counted together, and bytes (of those or of the scored) whose decisions are looked up together.
TALLY, LOOKUP = 2 << 20, 16 << 10
#: Slots (as a power of 2) of each predictor's table: last two bytes, last four, the word's beginning.
TABLE_BITS = (20, 22, 23)
#: Slots summed in one piece.
PIECE = 1 << 16
HEAD_WORDS = 500_000
#: Leading bits of a frequent word's key that are looked up at once.
HEAD_BITS = 19
RATE = 0.005
_UNSEEN = -128
#: The mixture's log odds stay within this (the sure and the unlikely bit both keep float32 precision).
_BOUND = np.float32(12)
#: Stretched probabilities are kept in eighths.
_STEP = np.float32(1 / 8)
#: Steps of the stretched probabilities that count as one where the weights are fitted.
_COARSE = 5
_END, _SPACE = 10, 32
_TOKEN_END = -1  # the end token's key; a word's hash never has it
_BYTE = -2  # stream byte b has the key _BYTE - b
_STREAMED = np.where(IS_SPACE, np.uint8(_SPACE), FOLD)


def _translated(data: np.ndarray, by: np.ndarray) -> np.ndarray:
    """by[data], for bytes."""
    return np.frombuffer(data.tobytes().translate(by.tobytes()), np.uint8)


# ---------------------------------------------------------------- streams and contexts


@dataclass
class Stream:
    """Streams of a block's texts one after another, where each begins, every byte in its contexts, and the words' hashes with
    their first per text.

    A byte's key has 24 bits of the hash of the current word's beginning, the four bytes before it (the last one in the
    highest place) and the byte itself: all that its slots are made of.
    """

    data: np.ndarray
    offsets: np.ndarray
    keys: np.ndarray
    words: np.ndarray
    first: np.ndarray


def stream(block: Block) -> Stream:
    """The block's streams; a large block is scanned in parts, whose working arrays stay in the processor's cache."""
    if len(block.data) > SCAN_BLOCK and block.rows > 1:
        cut = np.unique(np.searchsorted(block.offsets, np.arange(0, len(block.data), SCAN_BLOCK)))
        cut = np.unique(np.append(cut, [0, block.rows]))
        at, end = block.offsets, 0
        # a stream has no more than two bytes more than its text
        data, keys = (np.empty(len(block.data) + 2 * block.rows, t) for t in (np.uint8, np.uint64))
        offsets, words, first = [np.zeros(1, np.int64)], [], [np.zeros(1, np.int64)]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            p = _stream(Block(a, block.data[at[a] : at[b]], at[a : b + 1] - at[a]))
            data[end : end + len(p.data)], keys[end : end + len(p.data)] = p.data, p.keys
            offsets.append(p.offsets[1:] + end)
            first.append(p.first[1:] + first[-1][-1])
            words.append(p.words)
            end += len(p.data)
        return Stream(data[:end], np.concatenate(offsets), keys[:end], np.concatenate(words), np.concatenate(first))
    return _stream(block)


def _stream(block: Block, words: bool = True) -> Stream:
    rows = block.rows
    raw = np.empty(len(block.data) + 2 * rows, np.uint8)
    body = np.ones(len(raw), bool)
    end = block.offsets[1:] + 2 * np.arange(1, rows + 1) - 1
    body[end] = body[end - 1] = False
    raw[body] = _translated(block.data, _STREAMED)
    raw[end], raw[end - 1] = _END, _SPACE
    # a space after a space or at a text's begin is left out: one is left after each word
    space = raw == _SPACE
    keep = np.ones(len(raw), bool)
    keep[0] = not space[0]
    keep[1:] = ~(space[1:] & (space[:-1] | (raw[:-1] == _END)))
    out = raw[keep]
    offsets = np.append(0, np.flatnonzero(out == _END) + 1)
    begin = offsets[:-1]
    padded = np.full(len(out) + 4, _END, np.uint8)
    padded[4:] = out
    four = np.ndarray((len(out),), "<u4", padded, strides=(1,)).copy()
    for j in range(4):  # what lies before a text's begin counts as end bytes
        at = (begin + j)[begin + j < offsets[1:]]
        ends = np.uint32((_END * 0x01010101) >> 8 * j)
        four[at] = ends if j == 0 else four[at] & np.uint32(0xFFFFFFFF << (32 - 8 * j) & 0xFFFFFFFF) | ends
    # hash of the current word up to each byte: from where the last space or text begin was
    total = len(out)
    after = np.flatnonzero((out == _SPACE) | (out == _END)) + 1
    start = np.append(0, after[:-1])
    length = after - start
    c = running_hash(out)
    begun = np.repeat(start, length)
    prefix = c[:-1] - c.take(begun)
    prefix *= powers(_INV, total).take(begun)
    prefix *= np.uint64(0x9E3779B97F4A7C15)
    prefix &= np.uint64(0xFFFFFF << 40)
    prefix |= four.astype(np.uint64) << np.uint64(8)
    prefix |= out
    start, end = start[length > 1], after[length > 1] - 1
    hashes = span_hashes(out, start, end, running=c) & np.uint64((1 << 63) - 1) if words else np.empty(0, np.uint64)
    return Stream(out, offsets, prefix, hashes, np.searchsorted(start, offsets))


def contexts(keys: np.ndarray) -> list[np.ndarray]:
    """Hashed contexts of each byte, one slot number of its own for each table: last two bytes, last four, the word's beginning."""
    four = (keys >> np.uint64(8)).astype(np.uint32)
    two = (four >> np.uint32(16)) * np.uint32(0x9E3779B1)
    four *= np.uint32(0x9E3779B1)
    four ^= four >> np.uint32(15)
    four *= np.uint32(0x85EBCA77)
    prefix = (keys >> np.uint64(32)).astype(np.uint32)
    return [(h >> np.uint32(32 - bits)).astype(np.intp) for h, bits in zip((two, four, prefix), TABLE_BITS, strict=True)]


# ---------------------------------------------------------------- training counts


def _node_hashes(node: np.ndarray) -> np.ndarray:
    return node.astype(np.intp)


def slots(context: np.ndarray, owner: np.ndarray, node_hash: np.ndarray) -> np.ndarray:
    """Slot of each decision (byte that owns it, node): a context's decisions lie close together."""
    h = context.take(owner)
    h ^= node_hash
    return h


def _owners(n: np.ndarray) -> np.ndarray:
    """Byte that owns each decision, where byte i has n[i] of them."""
    return np.repeat(np.arange(len(n)), n)


def _owned(symbols: np.ndarray, code) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of decisions of each byte, the byte that owns each decision, and its code entry."""
    first, size, _, _ = code
    n = size.take(symbols)
    owner = _owners(n)
    entry = (first.take(symbols) - np.cumsum(n) + n).take(owner)
    entry += np.arange(len(entry))
    return n, owner, entry


def _entries(symbols: np.ndarray, code) -> tuple[np.ndarray, np.ndarray]:
    """Number of decisions of each byte, and the code entry of every decision."""
    n, _, entry = _owned(symbols, code)
    return n, entry


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key of a byte in its contexts, how often) of some MB of streams each; every occurrence is in one of them."""
    held, size = np.empty(TALLY, np.uint64), 0
    for batch in batches:
        for block in blocks(batch.column("text"), SCAN_BLOCK):
            keys = _stream(block, words=False).keys
            if size + len(keys) > TALLY:
                yield np.unique(held[:size], return_counts=True)
                size = 0
            if len(keys) > TALLY:
                yield np.unique(keys, return_counts=True)
            else:
                held[size : size + len(keys)] = keys
                size += len(keys)
    if size:
        yield np.unique(held[:size], return_counts=True)


def _decided(batches: Iterator[pa.RecordBatch], code) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Of all decisions in the texts: 2 * slot + bit in each table, and how often that came."""
    _, _, node, bit = code
    hashed, up = _node_hashes(node), bit.astype(np.intp)
    for keys, times in _tallied(batches):
        for b in range(0, len(keys), LOOKUP):
            part = keys[b : b + LOOKUP]
            _, owner, entry = _owned(part.astype(np.uint8), code)
            h, y = hashed.take(entry), up.take(entry)
            yield [slots(c, owner, h) << 1 | y for c in contexts(part)], times[b : b + LOOKUP].take(owner)


def _count_decisions(code):
    """Rows (kind, piece, blob): this task's counts of both bits in every slot of the piece, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(2 << bits, np.int32) for bits in TABLE_BITS]
        for at, times in _decided(batches, code):
            times = times.astype(np.int32)
            for table, i in zip(tables, at, strict=True):
                np.add.at(table, i, times)
        for kind, table in enumerate(tables):
            for piece in range(0, len(table), 2 * PIECE):
                part = table[piece : piece + 2 * PIECE]
                if part.any():
                    blob = pa.compress(part.tobytes(), codec="zstd", asbytes=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind], pa.int32()), pa.array([piece // (2 * PIECE)], pa.int32()), pa.array([blob], pa.binary())],
                        names=["kind", "piece", "blob"],
                    )

    return run


def _left_out(counts: np.ndarray) -> np.ndarray:
    """Of every (slot, bit) the coarse prediction for that bit without one occurrence of it; 0: then unseen."""
    out = np.zeros(counts.shape, np.uint8)
    for bit, sign in ((0, -1), (1, 1)):
        less = counts.copy()
        less[:, bit] = np.maximum(less[:, bit] - 1, 0)
        x = _stretch(less[:, 0], less[:, 1])
        out[:, bit] = np.where(x == _UNSEEN, 0, 32 + sign * np.rint(x / _COARSE))
    return out


def _in_own_memory(tables: list[np.ndarray]) -> list[np.ndarray]:
    """Copies of broadcast tables in numpy's own memory, which has large pages; lookups all over them then miss fewer."""
    return [t.copy() for t in tables]


def _count_predictions(shared):
    """Rows (cell, n): how often each triple of left-out predictions came in this task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, tables = shared.value
        tables = _in_own_memory(tables)
        total = np.zeros(1 << 18, np.int64)
        for at, times in _decided(batches, code):
            cell = np.zeros(len(times), np.intp)
            for table, i in zip(tables, at, strict=True):
                cell <<= 6
                cell |= table.take(i, mode="clip")  # a slot is always inside its table
            np.add.at(total, cell, times)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(total[cell])], names=["cell", "n"])

    return run


def _weights_of_cells(cell: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights by gate from the triples' counts; all predictions are signed for the bit that came."""
    codes = [cell >> shift & 63 for shift in (12, 6, 0)]
    x = [np.where(c > 0, (c - 32) * float(_COARSE * _STEP), 0.0) for c in codes]
    return fit_weights(x, (codes[1] > 0) + 2 * (codes[2] > 0), np.ones(len(cell)), n)


def _sum_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the counts of each (kind, piece) run and give its stretched probabilities (int8), also those without one occurrence."""
    key, total = None, None

    def done():
        counts = total.reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([key[0]], pa.int32()),
                pa.array([key[1]], pa.int32()),
                pa.array([_stretch(counts[:, 0], counts[:, 1]).tobytes()], pa.binary()),
                pa.array([_left_out(counts).tobytes()], pa.binary()),
            ],
            names=["kind", "piece", "blob", "left_out"],
        )

    for batch in batches:
        for kind, piece, blob in zip(*(batch.column(i) for i in range(3)), strict=True):
            here = (kind.as_py(), piece.as_py())
            if here != key:
                if key is not None:
                    yield done()
                key, total = here, np.zeros(2 * PIECE, np.int64)
            raw = pa.decompress(blob.as_py(), decompressed_size=8 * PIECE, codec="zstd", asbytes=True)
            total += np.frombuffer(raw, np.int32)
    if key is not None:
        yield done()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, n) of the tokens' counts, summed over a few million tokens each, and of the stream's bytes."""
    held: list[np.ndarray] = []
    data = np.zeros(256, np.int64)

    def rows(key: np.ndarray, n: np.ndarray):
        for i in range(0, len(key), 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(key[i : i + (1 << 18)]), pa.array(n[i : i + (1 << 18)])], names=["key", "n"])

    def flushed():
        yield from rows(*np.unique(np.concatenate(held), return_counts=True))
        held.clear()

    for batch in batches:
        for block in blocks(batch.column("text"), SCAN_BLOCK):
            starts, ends, _ = block.words()
            folded = _translated(block.data, FOLD)
            words = span_hashes(folded, starts, ends) & np.uint64((1 << 63) - 1)
            held += [words.view(np.int64), np.full(block.rows, _TOKEN_END)]
            own = np.bincount(folded, minlength=256)
            own[IS_SPACE] = 0
            own[[_SPACE, _END]] = len(words), block.rows
            data += own
            if sum(map(len, held)) > 3_000_000:
                yield from flushed()
    if held:
        yield from flushed()
    seen = np.flatnonzero(data)
    yield from rows(_BYTE - seen, data[seen])


# ---------------------------------------------------------------- the model


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first entry per byte, entries per byte, node of each entry, bit of each entry) of a Huffman code over 256 bytes."""
    heap = [(int(n), i, i) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    paths: dict[int, list[tuple[int, int]]] = {i: [] for i in range(256)}
    below = {i: [i] for i in range(256)}
    for node in range(255):
        n0, t0, a = heapq.heappop(heap)
        n1, t1, b = heapq.heappop(heap)
        for bit, side in ((0, a), (1, b)):
            for leaf in below[side]:
                paths[leaf].append((node, bit))
        below[256 + node] = below.pop(a) + below.pop(b)
        heapq.heappush(heap, (n0 + n1, min(t0, t1), 256 + node))
    size = np.array([len(paths[i]) for i in range(256)])
    flat = [step for i in range(256) for step in reversed(paths[i])]
    return np.concatenate([[0], np.cumsum(size)[:-1]]), size, np.array([s[0] for s in flat]), np.array([s[1] for s in flat])


@dataclass
class Mixer:
    """Code (first, size, node, bit), stretched probabilities per (context, node), weights per gate."""

    code: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    tables: list[np.ndarray]
    weights: np.ndarray


def _stretch(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    x = np.log((ones + 0.3) / (zeros + 0.3)).astype(np.float32)
    out = np.clip(np.rint(x / _STEP), -127, 127).astype(np.int8)
    out[(zeros + ones) <= 0] = _UNSEEN
    return out


def _events(s: Stream, code):
    """All bytes in the order (step of ``STRIDE`` bytes, text, byte).

    Returns the position of each byte and the first byte of each step; the number of decisions of each unit (step, text) and
    the first unit of each step; and the text of each lane, longest first. The steps' firsts have one more entry.
    """
    length = np.diff(s.offsets)
    text = np.argsort(-length, kind="stable")
    begin, span = s.offsets[:-1][text], length[text]
    steps = -(-int(span[0]) // STRIDE) if len(span) else 0
    alive = np.searchsorted(-span, -STRIDE * np.arange(steps), "left")  # texts longer than the step's begin
    at = np.concatenate([[0], np.cumsum(alive)])
    lane = np.arange(at[-1]) - np.repeat(at[:-1], alive)
    offset = np.repeat(STRIDE * np.arange(steps), alive)
    size = np.minimum(STRIDE, span[lane] - offset)
    first = np.cumsum(size) - size
    pos = np.repeat((begin[lane] + offset - first).astype(np.int32), size)
    pos += np.arange(len(pos), dtype=np.int32)
    n = _translated(s.data, code[1].astype(np.uint8)).take(pos)
    in_unit = np.add.reduceat(n, first, dtype=np.intp) if len(first) else n.astype(np.intp)
    return pos, np.append(first, len(pos))[at], in_unit, at, text


def _in_steps(keys: np.ndarray, owner: np.ndarray, node_hash: np.ndarray, tables: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Stretched probability in steps by each predictor (0 where unseen), and the gate: which of the two sparse contexts was seen."""
    out, gate = [], np.zeros(len(node_hash), np.uint8)
    for kind, (table, context) in enumerate(zip(tables, contexts(keys), strict=True)):
        raw = table.take(slots(context, owner, node_hash), mode="clip")  # a slot is always inside its table
        seen = raw != _UNSEEN
        raw *= seen
        out.append(raw)
        if kind:
            gate += seen * np.uint8(kind)
    return out, gate


def predictions(s: Stream, pos: np.ndarray, n: np.ndarray, node_hash: np.ndarray, tables: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Stretched probability by each predictor (0 where unseen), and the gate."""
    steps, gate = _in_steps(s.keys[pos], _owners(n), node_hash, tables)
    return [v * _STEP for v in steps], gate


def _mixed(s: Stream, pos: np.ndarray, model: Mixer) -> tuple[np.ndarray, np.ndarray]:
    """Of each decision the predictors' stretched probabilities in steps (predictor, decision) and their mixture by the
    trained weights, both signed so that positive speaks for the coded bit. Many are made piece by piece, which bounds the
    working arrays."""
    _, _, node, bit = model.code
    hashed, sign = _node_hashes(node), np.where(bit, 1, -1).astype(np.int8)
    weights = np.ascontiguousarray(model.weights.T, np.float32) * _STEP
    parts = []
    for b in range(0, len(pos), LOOKUP):
        keys = s.keys.take(pos[b : b + LOOKUP])
        _, owner, entry = _owned(keys.astype(np.uint8), model.code)
        st, gate = _in_steps(keys, owner, hashed.take(entry), model.tables)
        coded = sign.take(entry)
        gate = gate.astype(np.intp)
        f, x = np.empty((len(st), len(entry)), np.float32), np.zeros(len(entry), np.float32)
        for kept, w, v in zip(f, weights, st, strict=True):
            np.multiply(v, coded, out=v)
            kept[:] = v
            gain = w.take(gate, mode="clip")
            gain *= kept
            x += gain
        parts.append((f, x))
    return parts[0] if len(parts) == 1 else (np.concatenate([f for f, _ in parts], axis=1), np.concatenate([x for _, x in parts]))


def log10_probabilities(s: Stream, model: Mixer, rate: float = RATE) -> np.ndarray:
    """log10 of the model's probability of each text's stream."""
    pos, first, in_unit, at, text = _events(s, model.code)
    begin = np.cumsum(in_unit) - in_unit
    k = len(model.tables)
    moved, coded = np.zeros((k, len(text)), np.float32), np.zeros(len(text))
    one, rate = np.float32(1), np.float32(rate)
    rate *= _STEP * _STEP  # the weights' moves are kept per step of the predictors
    bounds = np.append(begin, in_unit.sum())[at].tolist()
    at = at.tolist()
    ready = 0  # steps whose predictions are looked up: as many at once as have about LOOKUP bytes
    for t in range(len(at) - 1):
        if t == ready:
            ready = max(t + 1, int(np.searchsorted(first, first[t] + LOOKUP, "right")) - 1)
            f, x = _mixed(s, pos[first[t] : first[ready]], model)
            np.negative(x, out=x)
            base = bounds[t]
        lo, hi, e0, e1 = at[t], at[t + 1], bounds[t], bounds[t + 1]
        now, part = f[:, e0 - base : e1 - base], x[e0 - base : e1 - base]
        if t:
            shift = moved[:, : hi - lo].repeat(in_unit[lo:hi], axis=1)
            shift *= now
            for more in shift[1:]:
                shift[0] += more
            part -= shift[0]
        # part turns from the other bit's log odds into its odds; both bits' odds over one give the coding error and its cost
        np.minimum(part, _BOUND, out=part)
        np.maximum(part, -_BOUND, out=part)
        np.exp(part, out=part)
        both = part + one
        np.divide(part, both, out=part)
        gain = np.empty((k + 1, e1 - e0), np.float32)
        np.multiply(now, part, out=gain[:k])
        np.log(both, out=gain[k])
        gain = np.add.reduceat(gain, begin[lo:hi] - e0, axis=1)
        coded[: hi - lo] -= gain[k]
        gain = gain[:k]
        gain *= rate
        moved[:, : hi - lo] += gain
    out = np.empty(len(text))
    out[text] = coded / np.log(10)
    return out


def fit_weights(x: list[np.ndarray], seen: np.ndarray, y: np.ndarray, times: np.ndarray | None = None, steps: int = 15) -> np.ndarray:
    """Weights by gate that minimise the coding cost of decisions, each of which came so many ``times`` (Newton, small penalty)."""
    out = np.zeros((4, len(x)))
    for g in range(4):
        on = seen == g
        f = np.stack([a[on] for a in x], axis=1).astype(float)
        m = np.ones(len(f)) if times is None else times[on].astype(float)
        w = np.full(len(x), 0.4)
        for _ in range(steps if on.any() else 0):
            p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
            grad = f.T @ (m * (y[on] - p)) - 1.0 * (w - 0.4)
            hess = (f * (m * p * (1 - p))[:, None]).T @ f + np.eye(len(x))
            w = w + np.clip(np.linalg.solve(hess, grad), -1, 1)
        out[g] = w
    return out


def byte_code(texts: list[str]):
    """Huffman code of the texts' stream bytes, every byte value allowed for."""
    counts = np.ones(256, np.int64)
    for block in blocks(pa.array(texts, pa.string()), BLOCK):
        counts += np.bincount(stream(block).data, minlength=256)
    return huffman(counts)


def mixer(code, tables: list[np.ndarray], texts: list[str]) -> Mixer:
    """The model from its tables, with weights fitted to texts that the tables left out."""
    st, gate, y = [], [], []
    for block in blocks(pa.array(texts, pa.string()), BLOCK):
        s = stream(block)
        n, entry = _entries(s.data, code)
        f, g = predictions(s, np.arange(len(s.data)), n, _node_hashes(code[2])[entry], tables)
        st.append(f)
        gate.append(g)
        y.append(code[3][entry])
    if not y:
        return Mixer(code, tables, np.full((4, len(tables)), 0.4))
    return Mixer(code, tables, fit_weights([np.concatenate(f) for f in zip(*st, strict=True)], np.concatenate(gate), np.concatenate(y)))


# ---------------------------------------------------------------- Spark


def train(docs: DataFrame, mod: int, rest: int) -> tuple[Mixer, DataFrame, int, int]:
    """(mixer, token counts (key, n), number of training tokens, of distinct ones) from documents not in the held-out class."""
    bucket = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(mod))
    learn = docs.where(bucket != rest).select(text_or_empty().alias("text"))
    counts = written(learn.mapInArrow(_count_words, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "tokens")
    tokens = counts.where(F.col("key") >= _TOKEN_END)
    total = tokens.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    data = np.ones(256, np.int64)  # every byte value is allowed for
    for r in counts.where(F.col("key") < _TOKEN_END).collect():
        data[_BYTE - r["key"]] += r["n"]
    code = huffman(data)
    pieces = (
        learn.mapInArrow(_count_decisions(code), "kind int, piece int, blob binary")
        .repartition("kind", "piece")
        .sortWithinPartitions("kind", "piece")
        .mapInArrow(_sum_pieces, "kind int, piece int, blob binary, left_out binary")
        .toArrow()
    )
    tables = [np.full(1 << bits, _UNSEEN, np.int8) for bits in TABLE_BITS]
    left_out = [np.zeros(2 << bits, np.uint8) for bits in TABLE_BITS]
    for kind, piece, blob, less in zip(*(pieces.column(i) for i in range(4)), strict=True):
        at = piece.as_py() * PIECE
        tables[kind.as_py()][at : at + PIECE] = np.frombuffer(blob.as_py(), np.int8)
        left_out[kind.as_py()][2 * at : 2 * (at + PIECE)] = np.frombuffer(less.as_py(), np.uint8)
    del pieces
    shared = docs.sparkSession.sparkContext.broadcast((code, left_out))
    cells = learn.mapInArrow(_count_predictions(shared), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    shared.unpersist()
    weights = _weights_of_cells(cells.column("cell").to_numpy().astype(np.int64), cells.column("n").to_numpy())
    return Mixer(code, tables, weights), tokens, int(total["n"] or 0), int(total["v"] or 0)


def _of_like_length(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each batch in parts of about ``BLOCK`` bytes and like lengths, so that few steps have few texts."""
    for batch in batches:
        size = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(size, kind="stable")
        part = np.cumsum(size[order]) // BLOCK
        for rows in np.split(order, np.flatnonzero(np.diff(part)) + 1):
            yield batch.take(pa.array(rows))


class Head:
    """The most frequent words' keys in order, found from the first one of the same leading bits on (the keys are hashes: few share them)."""

    def __init__(self, keys: np.ndarray):
        self.size = len(keys)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        begin = np.cumsum(np.bincount(keys >> 63 - HEAD_BITS, minlength=1 << HEAD_BITS))
        self.begin = np.append(0, begin[:-1]).astype(np.int32)

    def places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's place among the keys, and whether it is one of them."""
        place = self.begin.take(words >> 63 - HEAD_BITS).astype(np.intp)
        before = np.flatnonzero(self.keys.take(place) < words)
        while len(before):
            place[before] += 1
            before = before[self.keys.take(place[before]) < words[before]]
        return place, (self.keys.take(place) == words) & (place < self.size)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, head_key, head_n, total, distinct = shared.value
        model = Mixer(model.code, _in_own_memory(model.tables), model.weights)
        head, head_log = Head(head_key), np.log10((head_n + 1) / (total + distinct + 1))
        for batch in _of_like_length(batches):
            for block in blocks(batch.column("text"), BLOCK):
                s = stream(block)
                row = doc_of(s.first)
                word = s.words.view(np.int64)
                place, hit = head.places(word)
                logs = np.bincount(row[hit], head_log[place[hit]], block.rows).astype(float)  # of no words they are integers
                known = np.bincount(row[hit], minlength=block.rows)
                tail = np.flatnonzero(~hit)
                cut = np.searchsorted(row[tail], np.arange(block.rows + 1)).astype(np.int32)
                take = pa.array(np.arange(block.first_row, block.first_row + block.rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(take),
                        pa.array(np.diff(s.first) + 1),
                        pa.array(known),
                        pa.array(logs),
                        pa.array(log10_probabilities(s, model)),
                        pa.array(np.diff(s.offsets)),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(word[tail])),
                    ],
                    names=["doc_id", "n_tokens", "known", "logs", "score", "n_bytes", "tail"],
                )

    return run


def score(docs: DataFrame, mod: int = 7, rest: int = 2, head_words: int = HEAD_WORDS) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte), one per document row.

    Documents whose crc32(doc_id as text) modulo ``mod`` is ``rest`` are held out, all others train.
    """
    spark = docs.sparkSession
    model, tokens, total, distinct = train(docs, mod, rest)
    head = tokens.where(F.col("key") != _TOKEN_END).orderBy(F.desc("n"), "key").limit(head_words).toArrow()
    order = np.argsort(head.column("key").to_numpy())
    head_key, head_n = head.column("key").to_numpy()[order], head.column("n").to_numpy()[order]
    end = tokens.where(F.col("key") == _TOKEN_END).agg(F.sum("n")).first()[0] or 0
    shared = spark.sparkContext.broadcast((model, head_key, head_n, total, distinct))
    parts = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
            _score(shared),
            "doc_id long, n_tokens long, known long, logs double, score double, n_bytes long, tail array<long>",
        ),
        "parts",
    ).withColumn("row", F.monotonically_increasing_id())
    rare = parts.select("row", F.explode("tail").alias("key")).groupBy("row", "key").agg(F.count("*").alias("k"))
    gained = (
        rare.join(tokens.where(F.col("key") != _TOKEN_END), "key", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("t_known"),
            F.sum(F.col("k") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(total + distinct + 1)))).alias("t_logs"),
        )
    )
    end_known = 1 if end else 0
    end_log = float(np.log10((end + 1) / (total + distinct + 1)))
    bucket = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(mod))
    return parts.join(gained, "row", "left").select(
        "doc_id",
        (bucket == rest).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("t_known", F.lit(0)) + end_known).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("t_logs", F.lit(0.0)) + end_log).alias("base_score"),
        "score",
        (-F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")).alias("bits_per_byte"),
    )
