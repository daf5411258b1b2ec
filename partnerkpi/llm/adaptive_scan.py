"""Nearest vectors by an adaptive dimension scan over an inverted-list index.

``build`` draws at most ``SAMPLE`` vectors (least hashes of their content), puts sqrt(rows) list centres on them by k-means (a
sixteenth of the sample at most) and takes a random rotation. It assigns every distinct vector to the list of its nearest centre and writes the rotated
vectors in column blocks (``b0``, ``b1``, ... of ``WIDTH`` dimensions) beside the originals. ``search`` probes each query's
nearest lists: in a list the column blocks are added up one after another, and after each a hypothesis test drops candidates
whose partial distance, scaled to all dimensions, exceeds the query's bound by more than chance allows (factor
1 + ``EPSILON`` / sqrt(dimensions seen)); what survives all blocks is measured on the original vectors in double precision.

The nearest list comes first and gives each query its bound, the other lists are scanned with it. How many lists are probed
is measured at build time: ``CALIBRATION`` sampled vectors are searched by brute force against all rows, and the smallest
number of lists that holds ``TARGET`` of their true neighbours is taken, so that recall holds for clustered and for shapeless
data. Queries get further lists until these hold more vectors than asked for.

Equal vectors are one candidate with their least ids (no more than an answer can hold, so nothing is lost), however many
rows share it, and equal queries are searched once. A list is dealt in blocks of ``BLOCK_ROWS`` vectors and ``BLOCK_QUERIES``
queries, each a group of bounded size.

Defined results: null vectors, vectors of zeros or with null, NaN or infinite components take no part, as query or
candidate; nor do vectors whose length is not the most frequent one (ties: the longer); repeated rows of one id are
candidates each, but never of a query of that id; null ids are candidates last in ties, never queries by id rule; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Vectors in the sample of ``fit`` (fewer if they would take more than ``SAMPLE_BYTES``).
SAMPLE, SAMPLE_BYTES = 20_000, 64 << 20
#: Stands for a null id inside the index: last in ties.
NULL_ID = (1 << 63) - 1
CALIBRATION = 200
TARGET = 0.98
EPSILON = 2.1
WIDTH = 16
BLOCK_ROWS = BLOCK_QUERIES = 8192
#: Pairs of a query and a candidate that are scanned at once, and candidates between two moves of the bounds.
_PAIRS, _CANDIDATES = 1 << 20, 1024


@dataclass(frozen=True)
class Index:
    """The written vectors (h1, h2, ids, vec, list, b0, b1, ...), and what queries need to find their lists."""

    rows: DataFrame
    k: int
    centres: np.ndarray
    rotation: np.ndarray
    sizes: np.ndarray
    probes: int

    @property
    def columns(self) -> list[str]:
        return [f"b{j}" for j in range(-(-len(self.rotation) // WIDTH))]


def usable(table: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(h1, h2, id, v): the rows whose vector takes part, and a 128-bit hash of it; equal rows of one id once."""
    v = F.col(vector).cast("array<double>")
    ok = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = table.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(ok)
    return rows.groupBy(F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), "id").agg(F.first("v").alias("v"))


def distinct_vectors(table: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(h1, h2, v, ids): the distinct vectors of the most frequent length, with the ``k`` + 1 least ids of their rows."""
    rows = usable(table, id_col, vector)
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1)
    rows = rows.join(F.broadcast(length.select("d")), F.size("v") == F.col("d"), "left_semi")
    least = Window.partitionBy("h1", "h2").orderBy(F.asc_nulls_last("id"))
    rows = rows.withColumn("r", F.row_number().over(least)).where(F.col("r") <= k + 1)  # cut before the shuffle, too
    return rows.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.array_sort(F.collect_list(F.coalesce("id", F.lit(NULL_ID)))).alias("ids"))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of each row of x to the centres, less the row's own square."""
    return (centres**2).sum(1)[None] - 2 * (x @ centres.T)


def centres_of(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    """k-means centres; a centre that loses all its vectors stays where it is."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), lists, replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([_nearest(part, centres).argmin(1) for part in np.array_split(sample, -(-len(sample) // 4096))])
        count = np.bincount(own, minlength=lists)
        total = np.zeros_like(centres)
        np.add.at(total, own, sample)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def _matrix(cells: pd.Series, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(cells), kind).reshape(len(cells), -1)


def _cells(rows: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in np.ascontiguousarray(rows)]


def build(table: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding") -> Index | None:
    """The written index of a table's vectors, for searches of up to ``k`` neighbours; None without any vector."""
    classes = written(distinct_vectors(table, k, id_col, vector), "vectors")
    n = classes.count()
    if not n:
        return None
    d = len(classes.select("v").head()[0])
    sample = classes.select("v").orderBy("h1", "h2").limit(max(CALIBRATION, min(SAMPLE, SAMPLE_BYTES // (8 * d))))
    sample = np.array([r[0] for r in sample.collect()], np.float32)
    centres = centres_of(sample, max(1, min(math.isqrt(n), len(sample) // 16)))
    rotation = np.linalg.qr(np.random.default_rng(2).standard_normal((d, d)))[0].astype(np.float32)
    names = [f"b{j}" for j in range(-(-d // WIDTH))]
    shared = classes.sparkSession.sparkContext.broadcast((centres, rotation))

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, rotation = shared.value
        for frame in frames:
            if not len(frame):
                continue
            x = np.stack(frame["v"].to_numpy())
            turned = x.astype(np.float32) @ rotation
            out = frame[["h1", "h2", "ids"]].assign(vec=_cells(x), list=_nearest(x.astype(np.float32), centres).argmin(1))
            yield out.assign(**{b: _cells(turned[:, j * WIDTH : (j + 1) * WIDTH]) for j, b in enumerate(names)})

    schema = "h1 long, h2 long, ids array<long>, vec binary, list int, " + ", ".join(f"{b} binary" for b in names)
    rows = written(classes.mapInPandas(placed, schema), "index")
    sizes = np.zeros(len(centres), np.int64)
    for r in rows.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    probes = _calibrated(rows, sample[:: max(1, len(sample) // CALIBRATION)][:CALIBRATION].astype(np.float64), centres, k)
    return Index(rows, k, centres, rotation, sizes, probes)


def _calibrated(rows: DataFrame, queries: np.ndarray, centres: np.ndarray, k: int) -> int:
    """The least number of lists that holds ``TARGET`` of the queries' true neighbours among all rows."""

    def nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best_d, best_l = np.full((len(queries), 0), 0.0), np.full((len(queries), 0), 0)
        for frame in frames:
            if not len(frame):
                continue
            x = _matrix(frame["vec"])
            dist = (x**2).sum(1)[None] - 2 * (queries @ x.T) + (queries**2).sum(1)[:, None]
            dist[dist < 1e-9] = np.inf  # the query itself
            dist = np.concatenate([best_d, dist], axis=1)
            lists = np.concatenate([best_l, np.broadcast_to(frame["list"].to_numpy(), (len(queries), len(x)))], axis=1)
            at = np.argsort(dist, axis=1)[:, :k]
            best_d, best_l = np.take_along_axis(dist, at, 1), np.take_along_axis(lists, at, 1)
        q, at = np.nonzero(np.isfinite(best_d))
        yield pd.DataFrame({"q": q, "d": best_d[q, at], "list": best_l[q, at]})

    found = rows.select("vec", "list").mapInPandas(nearest, "q int, d double, list int")
    first = F.row_number().over(Window.partitionBy("q").orderBy("d"))
    found = found.withColumn("r", first).where(F.col("r") <= k).select("q", "list").collect()
    if not found:
        return len(centres)
    order = _nearest(queries.astype(np.float32), centres).argsort(1).argsort(1)
    ranks = np.sort([order[r["q"], r["list"]] for r in found])
    return int(ranks[min(len(ranks) - 1, math.ceil(TARGET * len(ranks)) - 1)]) + 1


class Scan:
    """Running nearest candidates of some queries; ``add`` scans a block of candidates with the bounds so far."""

    def __init__(self, exact: np.ndarray, blocks: list[np.ndarray], bound: np.ndarray, k: int):
        self.exact, self.blocks, self.bound, self.k = exact, blocks, bound, k
        self.q, self.c = np.empty(0, np.int64), np.empty(0, np.int64)
        self.dist, self.least = np.empty(0), np.empty(0, np.int64)

    def add(self, exact: np.ndarray, blocks: list[np.ndarray], least: np.ndarray, numbers: np.ndarray) -> None:
        d, seen = sum(b.shape[1] for b in blocks), 0
        for j, (mine, theirs) in enumerate(zip(self.blocks, blocks, strict=True)):
            if j == 0:
                part = (mine**2).sum(1)[:, None] + (theirs**2).sum(1)[None] - 2 * (mine @ theirs.T)
            else:
                part = part + ((mine[q] - theirs[c]) ** 2).sum(1)  # noqa: F821  (set by the first block)
            seen += mine.shape[1]
            # chance of a wrong rejection falls with EPSILON; after the last block only rounding is allowed for
            slack = 1 + (EPSILON / math.sqrt(seen) if seen < d else 1e-4)
            limit = (slack * self.bound) ** 2 * (seen / d)
            if j == 0:
                q, c = np.nonzero(part <= limit[:, None])
                part = part[q, c]
            else:
                keep = part <= limit[q]
                q, c, part = q[keep], c[keep], part[keep]
        dist = np.sqrt(((self.exact[q] - exact[c]) ** 2).sum(1))
        self.q, self.c = np.concatenate([self.q, q]), np.concatenate([self.c, numbers[c]])
        self.dist, self.least = np.concatenate([self.dist, dist]), np.concatenate([self.least, least[c]])
        order = np.lexsort((self.least, self.dist, self.q))
        start = np.searchsorted(self.q[order], np.arange(len(self.bound)))
        rank = np.arange(len(order)) - start[self.q[order]]
        last = order[rank == self.k - 1]
        self.bound[self.q[last]] = np.minimum(self.bound[self.q[last]], self.dist[last])
        order = order[rank < self.k]
        self.q, self.c, self.dist, self.least = self.q[order], self.c[order], self.dist[order], self.least[order]


_FOUND = "h1 long, h2 long, dist double, ids array<long>"


def _scan_lists(index: Index, probes: DataFrame) -> DataFrame:
    """(h1, h2, dist, ids): the best candidates of each probe (h1, h2, vec, turned, bound, list) within its list."""
    names, k = index.columns, index.k + 1
    sizes = index.sizes
    per_list = probes.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("parts"))
    subs = probes.sparkSession.createDataFrame([(i, -(-int(s) // BLOCK_ROWS)) for i, s in enumerate(sizes)], "list int, subs int")
    plan = F.broadcast(per_list.join(subs, "list"))  # a row per list

    def dealt(df: DataFrame, h: str, own: str, other: str) -> DataFrame:
        rows = df.join(plan, "list")
        rows = rows.withColumn(own, F.pmod(h, own).cast("int"))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))

    left = dealt(probes, "h2", "parts", "subs")
    right = dealt(index.rows, "h1", "subs", "parts")

    none = pd.DataFrame({"h1": np.empty(0, np.int64), "h2": np.empty(0, np.int64), "dist": np.empty(0), "ids": np.empty(0, object)})

    def scan(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return none
        exact, least = _matrix(rows["vec"]), np.array([i[0] for i in rows["ids"]], np.int64)
        blocks = [_matrix(rows[b], np.float32) for b in names]
        out = []
        step = max(1, _PAIRS // _CANDIDATES)
        for a in range(0, len(queries), step):
            some = queries.iloc[a : a + step]
            turned = _matrix(some["turned"], np.float32)
            work = Scan(_matrix(some["vec"]), [turned[:, j * WIDTH : (j + 1) * WIDTH] for j in range(len(names))], some["bound"].to_numpy().copy(), k)
            for c in range(0, len(rows), _CANDIDATES):
                part = slice(c, c + _CANDIDATES)
                work.add(exact[part], [b[part] for b in blocks], least[part], np.arange(len(rows))[part])
            out.append(pd.DataFrame({"h1": some["h1"].to_numpy()[work.q], "h2": some["h2"].to_numpy()[work.q], "dist": work.dist, "ids": rows["ids"].to_numpy()[work.c]}))
        return pd.concat(out, ignore_index=True)

    key = ("list", "subs", "parts")
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(scan, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """(h1, h2, dist, id): the ``k`` nearest ids of each query vector."""
    rows = found.select("h1", "h2", "dist", F.explode("ids").alias("id"))
    order = Window.partitionBy("h1", "h2").orderBy("dist", "id")
    return rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")


def search(index: Index, queries: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the nearest ``index.k`` rows of other ids for every usable row of ``queries``."""
    d, k = len(index.rotation), index.k
    asked = written(usable(queries, id_col, vector).where(F.size("v") == d), "queries")
    shared = asked.sparkSession.sparkContext.broadcast((index.centres, index.rotation, index.sizes, index.probes))

    def probed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, rotation, sizes, probes = shared.value
        for frame in frames:
            if not len(frame):
                continue
            x = np.stack(frame["v"].to_numpy())
            order = _nearest(x.astype(np.float32), centres).argsort(1)
            held = np.cumsum(sizes[order], axis=1)
            take = np.maximum(probes, 1 + (held <= k).sum(1))  # a list more than those that hold k vectors or fewer
            lists = [o[:t].tolist() for o, t in zip(order, take, strict=True)]
            yield frame[["h1", "h2"]].assign(vec=_cells(x), turned=_cells(x.astype(np.float32) @ rotation), lists=lists)

    distinct = asked.groupBy("h1", "h2").agg(F.first("v").alias("v"))
    probes = written(distinct.mapInPandas(probed, "h1 long, h2 long, vec binary, turned binary, lists array<int>"), "probes")
    home = probes.withColumn("list", F.col("lists")[0]).withColumn("bound", F.lit(float("inf"))).drop("lists")
    first = written(_best(_scan_lists(index, home), k + 1), "home")
    bounds = first.groupBy("h1", "h2").agg(F.when(F.count("*") == k + 1, F.max("dist")).alias("kth"))
    rest = probes.join(bounds, ["h1", "h2"], "left").withColumn("bound", F.coalesce("kth", F.lit(float("inf")))).drop("kth")
    rest = rest.withColumn("list", F.explode(F.slice("lists", F.lit(2), F.greatest(F.size("lists") - 1, F.lit(0))))).drop("lists")
    near = first.withColumn("ids", F.array("id")).drop("id").unionByName(_scan_lists(index, rest))
    own = Window.partitionBy("query_id", "h1", "h2").orderBy("score", "id")
    found = (
        asked.select("h1", "h2", F.col("id").alias("query_id"))
        .join(_best(near, k + 1).withColumnRenamed("dist", "score"), ["h1", "h2"])
        .where(~F.col("id").eqNullSafe(F.col("query_id")))
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= k)
    )
    return found.select("query_id", "rank", F.nullif("id", F.lit(NULL_ID)).alias("id"), "score")
