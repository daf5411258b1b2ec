"""Quality rules: a base rule, then robust multivariate outliers per language and source.

Each text gives a vector of transformed statistics (``VECTOR``): log mean word length, and the square roots of the shares of
symbols, duplicate lines, words in repeated 3-word windows, and upper-case letters. Among the texts that pass the base
rule, location and scatter are estimated per (language, source) by the minimum covariance determinant: from medians and
median deviations, concentration steps take the ``COVERAGE`` share of a group's texts with the least Mahalanobis distance
and estimate anew from these, which never raises the determinant, until it stays the same. The scatter is floored (``FLOORS``; shares that are 0 in
most texts would make it singular) and rescaled so that the median distance fits the chi-square law. Texts whose squared
distance passes the chi-square cut are rejected, but only if a statistic lies on the bad side of its group's centre.

All steps are grouped aggregations over all texts (quantiles by mergeable sketches, sums of products), so a source with a
third of all rows is pre-aggregated like any other; only one row of estimates per group moves, and back to the texts by
broadcast after a count. The sketches' cuts depend on how rows are split among tasks (rank error 1/2000), so a text whose
distance lies at the cut within that error may be judged otherwise in another run. Groups under ``MIN_GROUP``
texts are pooled by language, and languages still under it in one rest pool.

Defined results: null and empty texts have zero counts and fail the base rule; null languages and sources are groups of
their own; repeated rows count each; a pool without enough texts for any estimate keeps what passes the base rule; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .wordscan import IS_SPACE, blocks, doc_of, gram_hashes, mixed, span_hashes

MIN_WORDS, MAX_REPEAT_SHARE = 50, 0.5
COVERAGE = 0.55
#: Concentration steps at most, and the fall of a log determinant that counts as none.
MOST_STEPS, STEADY = 10, 0.01
MIN_GROUP = 100
#: Rows (some 400 bytes each) up to which a table of a row per group is broadcast.
BROADCAST_POOLS = 20_000
#: Standard normal quantile of the cut (three texts in a hundred thousand of a normal population).
CUT_Z = 4.0
VECTOR = ("log_word_len", "symbol", "dup_line", "repeat", "upper")
#: Least standard deviation of each entry. Those of the two repeat shares let a short clean text say one of its three lines
#: twice; a line that comes back raises both shares, so a third of repeated lines with their words is beyond the cut.
FLOORS = (0.04, 0.05, 0.15, 0.15, 0.05)

# The symbols counted.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def _marked_again(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of items equal to an earlier one of the same text, and of items equal to any other of it."""
    h = mixed(key + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    later, both = np.zeros(len(h), bool), np.zeros(len(h), bool)
    later[order[1:]] = same
    both[order[1:]] = same
    both[order[:-1]] |= same
    return later, both


def text_statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """Base statistics of each text (counts), and ``n_lines``, ``n_upper``."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
    out = {n: np.zeros(len(texts), np.int64) for n in names}
    for b in blocks(texts):
        rows = slice(b.first_row, b.first_row + b.rows)
        starts, ends, first = b.words()
        out["n_words"][rows] = np.diff(first)
        solid = ~IS_SPACE[b.data]
        out["word_chars"][rows] = b.row_sums(solid & ((b.data & 0xC0) != 0x80))
        out["n_symbols"][rows] = b.row_sums(_SYMBOL[b.data])
        out["n_upper"][rows] = b.row_sums(_UPPER[b.data])
        l0, l1, lf = b.lines()
        held = np.searchsorted(starts, l1) > np.searchsorted(starts, l0)
        ldoc = doc_of(lf)
        later, _ = _marked_again(span_hashes(b.data, l0[held], l1[held]), ldoc[held])
        out["n_dup_lines"][rows] = np.bincount(ldoc[held][later], minlength=b.rows)
        out["n_lines"][rows] = np.bincount(ldoc[held], minlength=b.rows)
        doc = doc_of(first)
        grams = gram_hashes(span_hashes(b.data, starts, ends), 3)
        at = np.flatnonzero(doc[: len(grams)] == doc[2:]) if len(grams) else np.empty(0, np.int64)
        _, again = _marked_again(grams[at], doc[at])
        inside = np.zeros(len(starts) + 2, bool)
        for k in range(3):
            inside[at[again] + k] = True
        out["n_repeat_words"][rows] = np.bincount(doc[inside[: len(doc)]], minlength=b.rows)
    return out


def statistics_column(text: str = "text") -> Column:
    """Struct of the statistics and the vector of a text column."""

    @F.arrow_udf(
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, x array<double>"
    )
    def stats(texts: pa.Array) -> pa.Array:
        s = text_statistics(texts)
        chars, words, lines = np.maximum(s["word_chars"], 1), np.maximum(s["n_words"], 1), np.maximum(s["n_lines"], 1)
        x = np.stack(
            [
                np.log(np.maximum(s["word_chars"] / words, 0.5)),
                np.sqrt(s["n_symbols"] / chars),
                np.sqrt(s["n_dup_lines"] / lines),
                np.sqrt(s["n_repeat_words"] / words),
                np.sqrt(s["n_upper"] / chars),
            ],
            axis=1,
        )
        cells = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(VECTOR)), pa.array(x.ravel()))
        counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        return pa.StructArray.from_arrays([*(pa.array(s[c]) for c in counts), cells], [*counts, "x"])

    return stats(F.col(text).cast("string"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 100 * MAX_REPEAT_SHARE * F.col("n_words"))


def chi_square_quantile(d: int, z: float) -> float:
    """Wilson-Hilferty: the chi-square value of d degrees at the standard normal quantile z."""
    return d * (1 - 2 / (9 * d) + z * np.sqrt(2 / (9 * d))) ** 3


def _inverses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group: centre and inverse scatter from counts, sums and sums of products (one row per group)."""
    d = len(VECTOR)
    for batch in batches:
        n = batch.column("n").to_numpy().astype(float)[:, None]
        total = np.stack([batch.column(f"s{i}").to_numpy() for i in range(d)], axis=1)
        mean = total / n
        cov = np.empty((len(n), d, d))
        for i in range(d):
            for j in range(i, d):
                cov[:, i, j] = cov[:, j, i] = batch.column(f"p{i}_{j}").to_numpy() / n[:, 0] - mean[:, i] * mean[:, j]
        cov += np.diag(np.square(FLOORS))[None]
        inv = np.linalg.inv(cov)
        to_list = lambda a, k: pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * k), pa.array(a.ravel()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("pool"), to_list(mean, d), to_list(inv.reshape(len(n), -1), d * d), pa.array(np.linalg.slogdet(cov)[1])],
            names=["pool", "centre", "inverse", "log_det"],
        )


def _distance() -> Column:
    d = len(VECTOR)
    diff = [F.col("x")[i] - F.col("centre")[i] for i in range(d)]
    terms = [diff[i] * diff[j] * F.col("inverse")[i * d + j] * (1 if i == j else 2) for i in range(d) for j in range(i, d)]
    return sum(terms[1:], terms[0])


def _beside(rows: DataFrame, groups: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows with a written table of one row per ``key``: broadcast while that is at most ``BROADCAST_POOLS`` rows, so
    that a group with a third of all rows is not dealt to one task; a shuffled join beyond."""
    return rows.join(F.broadcast(groups) if groups.count() <= BROADCAST_POOLS else groups, key, how)


def estimates(vectors: DataFrame, coverage: float = COVERAGE, most_steps: int = MOST_STEPS) -> DataFrame:
    """(pool, centre, inverse, scale) of every pool of ``vectors`` (pool, x): the minimum covariance determinant.

    Concentration steps end when no pool's log determinant falls by over ``STEADY`` any more, or after ``most_steps``.
    """
    d = len(VECTOR)
    median = [F.percentile_approx(F.col("x")[i], 0.5, 2000).alias(f"m{i}") for i in range(d)]
    mid = written(vectors.groupBy("pool").agg(*median), "medians", small=True)
    spread = _beside(vectors, mid, "pool").groupBy("pool").agg(
        *[F.percentile_approx(F.abs(F.col("x")[i] - F.col(f"m{i}")), 0.5, 2000).alias(f"v{i}") for i in range(d)]
    )
    weight = [1 / ((1.4826 * F.col(f"v{i}")) ** 2 + FLOORS[i] ** 2) for i in range(d)]
    now = spread.join(mid, "pool").select(
        "pool",
        F.array(*[F.col(f"m{i}") for i in range(d)]).alias("centre"),
        F.array(*[weight[i] if i == j else F.lit(0.0) for i in range(d) for j in range(d)]).alias("inverse"),
        F.lit(float("inf")).alias("log_det"),
    )
    now = written(now, "start", small=True)
    for step in range(most_steps):
        far = _beside(vectors, now, "pool").select("pool", "x", _distance().alias("d2"))
        cuts = written(far.groupBy("pool").agg(F.percentile_approx("d2", coverage, 2000).alias("cut")), f"cut{step}", small=True)
        near = _beside(far, cuts, "pool").where("d2 <= cut")
        sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]
        products = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
        new = near.groupBy("pool").agg(F.count("*").alias("n"), *sums, *products).mapInArrow(
            _inverses, "pool string, centre array<double>, inverse array<double>, log_det double"
        )
        new = written(new, f"step{step}", small=True)
        falls = new.join(now.select("pool", F.col("log_det").alias("was")), "pool").agg(F.max(F.col("was") - F.col("log_det"))).first()[0]
        now = new
        if falls is None or falls <= STEADY:
            break
    far = _beside(vectors, now, "pool").groupBy("pool").agg(F.percentile_approx(_distance(), 0.5, 2000).alias("mid"))
    scale = F.greatest(F.col("mid") / F.lit(chi_square_quantile(d, 0.0)), F.lit(1.0))
    return written(now.join(far, "pool").select("pool", "centre", "inverse", scale.alias("scale")), "mcd", small=True)


def pooled(rows: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Add ``pool``: (lang, source) where it has ``min_group`` rows, else its language's rest, else the rest of all."""
    named = F.to_json(F.struct("lang", "source"), {"ignoreNullFields": "false"})
    by_source = rows.groupBy(named.alias("__g"), F.to_json(F.struct("lang"), {"ignoreNullFields": "false"}).alias("__l")).agg(F.count("*").alias("__n"))
    by_source = written(by_source, "sources", small=True)
    rest = by_source.where(F.col("__n") < min_group).groupBy("__l").agg(F.sum("__n").alias("__m")).withColumnRenamed("__l", "__r")
    pool = F.when(F.col("__n") >= min_group, F.col("__g")).when(F.col("__m") >= min_group, F.col("__l")).otherwise("rest")
    names = by_source.join(rest, (F.col("__l") == F.col("__r")) & (F.col("__n") < min_group), "left").select("__g", pool.alias("pool"))
    return _beside(rows.withColumn("__g", named), written(names, "pools", small=True), "__g").drop("__g")


def judged(docs: DataFrame, cut_z: float = CUT_Z) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, lang, source) with its statistics, base_failed, distance (squared) and kept."""
    stats = written(
        docs.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), statistics_column().alias("s")).select(
            "doc_id", "lang", "source", "s.*"
        ),
        "statistics",
    ).withColumn("base_failed", base_failed())
    passing = written(pooled(stats.where("not base_failed")), "passing")
    known = estimates(passing.select("pool", "x"))
    bad_side = F.exists(
        F.sequence(F.lit(1), F.lit(len(VECTOR) - 1)), lambda i: F.get("x", i) > F.get("centre", i) + F.get(F.array(*map(F.lit, FLOORS)), i)
    ) | (F.abs(F.get("x", F.lit(0)) - F.get("centre", F.lit(0))) > 3 * FLOORS[0])
    distance = _distance() / F.col("scale")
    verdict = _beside(passing, known, "pool", "left").select(
        *stats.columns,
        distance.alias("distance"),
        F.coalesce(~((distance > chi_square_quantile(len(VECTOR), cut_z)) & bad_side), F.lit(True)).alias("kept"),
    )
    failed = stats.where("base_failed").select("*", F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return verdict.unionByName(failed)
