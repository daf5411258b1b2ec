"""SimHash near-duplicates by anchor-point covering.

Fingerprint: 64 bits; bit i is 1 if it is set in more than half of the XXH64 values (seed 42) of the text's word
shingles, repeats included. Two fingerprints link at ``max_bits`` differing bits or fewer.

Search: the 64 bits are cut into blocks with thresholds t such that the sum of (t + 1) exceeds ``max_bits``; a linked
pair then differs by at most t in some block. In each block the anchors are the words of a covering code: the [15, 11]
Hamming code (covering radius R = 1) on 15 bits with the block's other bits kept raw, or, where t = 0, all words
(R = 0). Every fingerprint has one home anchor within R, and is replicated to every anchor within R + t; the home anchor
of either end of a pair within t therefore also gets the other end, so no link is lost. At each anchor the home
fingerprints are compared with all that came, over all 64 bits, and a spanning forest of the links found there is
emitted: n fingerprints at an anchor never give more than n - 1 edges a task.

Hot anchors: equal fingerprints are collapsed before the search (a third of all rows may be copies of one text), and an
anchor with more than ``BLOCK_ROWS`` fingerprints is dealt out as pairs of blocks, so no task holds more than two
blocks of one anchor. Components run on distinct fingerprints; documents join their fingerprint's label at the end.

Defined results: a null or wordless text has fingerprint 0 and links like any other; repeated rows keep their number;
a null doc_id keeps its row (its component is the smallest known id, null if there is none); an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written
from .components import connected_components

SEED = 42
#: Stands for a null doc_id in join keys.
_NO_ID = -(1 << 63)
#: An anchor's fingerprints are compared in blocks of at most about so many.
BLOCK_ROWS = 8192
#: Candidate pairs held at once while comparing.
PAIRS_AT_ONCE = 1 << 20


@dataclass(frozen=True)
class AnchorBlock:
    """``width`` bits from ``shift``; pairs within ``t`` there are found. ``code``: bits under the Hamming code (15 or 0)."""

    shift: int
    width: int
    t: int
    code: int


#: Blocks for 64 bits: thresholds 1 + 1 + 0, which (1+1) + (1+1) + (0+1) = 5 > 4 bits cover.
BLOCKS = (AnchorBlock(0, 22, 1, 15), AnchorBlock(22, 21, 1, 15), AnchorBlock(43, 21, 0, 0))


# ---------------------------------------------------------------- fingerprints


def shingle_hashes(text: str, shingle_words: int) -> np.ndarray:
    """XXH64 of each shingle of the text, A-Z lower-cased (the whole sequence where there are fewer words)."""
    import xxhash

    words = text.encode().lower().split()  # bytes.split and bytes.lower know ASCII only, as the definition asks
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle_words + 1
    spans = zip(starts[:n].tolist(), ends[shingle_words - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """Bitwise strict majority, as a signed 64-bit integer."""
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint_column(text: str = "text", shingle_words: int = 4) -> Column:
    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(shingle_hashes(t.as_py() or "", shingle_words)) for t in texts], pa.int64())

    return simhash(F.col(text).cast("string"))


# ---------------------------------------------------------------- anchors


def _syndromes(values: np.ndarray) -> np.ndarray:
    """Syndrome of the low 15 bits under the Hamming code whose i-th column is i + 1."""
    s = np.zeros(len(values), np.uint64)
    for i in range(15):
        s ^= ((values >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
    return s


def anchor_masks(block: AnchorBlock) -> list[np.ndarray]:
    """By syndrome: the difference patterns that lead from a value to each anchor within R + t, the home anchor first."""
    if not block.code:
        return [np.array([sum(1 << i for i in c) for w in range(block.t + 1) for c in combinations(range(block.width), w)], np.uint64)]
    out: list[list[int]] = [[] for _ in range(16)]
    for weight in range(block.t + 2):
        for bits in combinations(range(block.width), weight):
            mask = sum(1 << i for i in bits)
            s = 0
            for i in bits:
                s ^= i + 1 if i < block.code else 0
            out[s].append(mask)
    for s in range(16):  # nearest first: the home anchor flips at most one bit under the code
        out[s].sort(key=lambda m: (m.bit_count(), m >> block.code, m))
    return [np.array(m, np.uint64) for m in out]


def replicas(fps: np.ndarray, blocks=BLOCKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor key, fingerprint, is home) of every replica; the key holds the block's number in its top bits."""
    keys, vals, home = [], [], []
    u = fps.view(np.uint64)
    for no, b in enumerate(blocks):
        masks = anchor_masks(b)
        part = (u >> np.uint64(b.shift)) & np.uint64((1 << b.width) - 1)
        syndrome = _syndromes(part) if b.code else np.zeros(len(part), np.uint64)
        for s, m in enumerate(masks):
            rows = np.flatnonzero(syndrome == s)
            if len(rows):
                keys.append(((part[rows, None] ^ m[None, :]) | np.uint64(no << 60)).ravel())
                vals.append(np.repeat(fps[rows], len(m)))
                first = np.zeros((len(rows), len(m)), bool)
                first[:, 0] = True
                home.append(first.ravel())
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return np.concatenate(keys).view(np.int64), np.concatenate(vals), np.concatenate(home)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for i in range(0, len(fps), 4096):
            key, fp, home = replicas(fps[i : i + 4096])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp), pa.array(home)], names=["anchor", "fp", "home"])


# ---------------------------------------------------------------- comparison


def spanning_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (node, smallest node of its tree) of the pairs (a, b), by min-label hooking and pointer jumping."""
    nodes, idx = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = idx[: len(a)], idx[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def _links(max_bits: int):
    """Compare the rows of each (anchor, left, right) run: home rows with all rows; runs of a batch are done together."""

    def runs_edges(group: np.ndarray, fp: np.ndarray, home: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.append(start, len(group)))
        rows = np.flatnonzero(home & (np.repeat(size, size) > 1))
        if not len(rows):
            return out
        run = np.searchsorted(start, rows, "right") - 1
        each = size[run]
        at = 0
        total = np.cumsum(each)
        while at < len(rows):
            end = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")), at + 1)
            n = each[at:end]
            left = np.repeat(rows[at:end], n)
            right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[run[at:end]], n)
            x, y = fp[left], fp[right]
            near = (np.bitwise_count((x ^ y).view(np.uint64)) <= max_bits) & (x != y)
            if near.any():
                out.append(spanning_edges(x[near], y[near]))
            at = end
        return out

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            cols = [np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in range(4)]
            if held:
                cols = [np.concatenate(p) for p in zip(held, cols, strict=True)]
            anchor, part, fp, home = cols
            change = np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]))
            cut = int(change[-1]) + 1 if len(change) else 0
            held = [c[cut:] for c in cols]
            if cut:
                yield from _edges(runs_edges(_group(anchor[:cut], part[:cut]), fp[:cut], home[:cut]))
        if held and len(held[0]):
            yield from _edges(runs_edges(_group(held[0], held[1]), held[2], held[3]))

    def _group(anchor: np.ndarray, part: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([[0], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])]))

    def _edges(found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if found:
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            if len(found) > 1:
                a, b = spanning_edges(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return compare


def links(fps: DataFrame, max_bits: int = 4, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (column ``fp``) within ``max_bits``; not every pair."""
    if sum(b.t + 1 for b in BLOCKS) <= max_bits:
        raise ValueError("the blocks do not cover this distance")
    rep = written(fps.select("fp").mapInArrow(_replicate, "anchor long, fp long, home boolean"), "replicas")
    parts = (
        rep.groupBy("anchor")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > block_rows)
        .select("anchor", F.ceil(F.col("n") / block_rows).cast("int").alias("parts"))
    )
    # A hot anchor's rows fall into blocks by their hash; each pair of blocks is a run of its own.
    block = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = rep.join(parts, "anchor", "left").select(
        "anchor",
        F.explode(
            F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(
                F.transform(
                    F.sequence(F.lit(0), F.col("parts") - 1),
                    lambda other: F.least(block, other) * F.col("parts") + F.greatest(block, other),
                )
            )
        ).alias("part"),
        "fp",
        "home",
    )
    return (
        dealt.repartition("anchor", "part")
        .sortWithinPartitions("anchor", "part")
        .mapInArrow(_links(max_bits), "a long, b long")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, text_key, fp, label, component_id) of every row.

    ``component_id``: the smallest doc_id reachable over links, its own class included; ``label``: a fingerprint that
    names the component; ``text_key``: hash of the text, which tells rows of one doc_id apart.
    """
    prints = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.xxhash64(text_or_empty(text)).alias("text_key"),
            fingerprint_column(text, shingle_words).alias("fp"),
        ),
        "prints",
    )
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    label = connected_components(links(classes, max_bits))
    named = classes.join(label, F.col("node") == F.col("fp"), "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    component = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = named.join(component, "label").select("fp", "label", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "text_key", "fp", "label", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """One document of each component, all columns kept: the least doc_id (null last), then the least text hash.

    Only ids and hashes are grouped; the texts are filtered by an ordinary join. Rows equal in doc_id and text count as
    one document.
    """
    found = near_duplicates(docs, shingle_words, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    winners = found.groupBy("label").agg(F.min(order).alias("w")).select(
        F.coalesce("w.doc_id", F.lit(_NO_ID)).alias("__id"), F.col("w.text_key").alias("__key")
    )
    keyed = docs.withColumn("__id", F.coalesce("doc_id", F.lit(_NO_ID))).withColumn("__key", F.xxhash64(text_or_empty()))
    once = Window.partitionBy("__id", "__key").orderBy("__key")  # the join's own partitioning: no further shuffle
    kept = keyed.join(winners, ["__id", "__key"], "left_semi").withColumn("__nth", F.row_number().over(once))
    return kept.where("__nth = 1").select(*docs.columns)


def fingerprint_hex(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
