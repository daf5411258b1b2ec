"""Language identification by Bayesian evidence fusion.

For a page and a language L the log posterior adds up
- the text's log likelihood: naive Bayes over hashed character trigrams of the visible text, trained on texts of known
  language (a bounded sample, documented below), divided by a temperature so that dependent trigrams are not over-counted;
- the log likelihood of the declared markup language (``<html lang>``) and of the address suffix (top-level domain) given L:
  Laplace-smoothed tables;
- the log prior of L on the page's host, hierarchically smoothed: host counts backed off to its registered domain's, these
  to all pages' (Dirichlet strengths ``HOST_STRENGTH`` and ``DOMAIN_STRENGTH``).
The tables and priors are grouped aggregations of the text-only posteriors over all pages, each page counting with its own
posterior; a host with a third of all pages is pre-aggregated map-side, and its one prior row joins back by an equi-join.

Defined results: a page without visible text has equal text likelihoods and is decided by its other evidence; a missing
declaration or suffix is a value of its own; a null or unreadable address has the host '' (smoothed like any other);
repeated rows count each; an empty page table gives no rows; languages are those of the training sample, sorted, ties to
the first; without any training text every page gets the language null; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written
from .wordscan import FOLD, blocks, mixed

#: Distinct training texts of each language (least by hash) and their longest length.
SAMPLE_DOCS, SAMPLE_CHARS = 500, 20_000
TRIGRAM_BITS = 16
TEMPERATURE = 3.0
HOST_STRENGTH, DOMAIN_STRENGTH = 5.0, 20.0


def _trigrams(block) -> tuple[np.ndarray, np.ndarray]:
    """Slot of the three bytes from each position (white space as one blank), and the row; none across texts."""
    data = FOLD[block.data].copy()
    data[(data >= 9) & (data <= 13)] = 32
    if len(data) < 3:
        return np.empty(0, np.intp), np.empty(0, np.int64)
    h = data[:-2].astype(np.uint64) << np.uint64(16) | data[1:-1].astype(np.uint64) << np.uint64(8) | data[2:]
    row = np.repeat(np.arange(block.rows), np.diff(block.offsets))
    ok = row[:-2] == row[2:]
    return (mixed(h) >> np.uint64(64 - TRIGRAM_BITS)).astype(np.intp)[ok], row[:-2][ok]


def train(texts: list[str], langs: list[str]) -> tuple[list[str], np.ndarray]:
    """(languages, log probability [language, slot])."""
    names = sorted(set(langs))
    counts = np.zeros((len(names), 1 << TRIGRAM_BITS))
    for i, name in enumerate(names):
        for block in blocks(pa.array([t for t, x in zip(texts, langs, strict=True) if x == name], pa.string())):
            counts[i] += np.bincount(_trigrams(block)[0], minlength=1 << TRIGRAM_BITS)
    counts += 0.5
    return names, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32) if names else counts.astype(np.float32)


def sampled(docs: DataFrame, lang: str = "lang", text: str = "text", per_lang: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, text): of each language the ``per_lang`` distinct texts of least hash (ties: the smaller text), in two scans
    however many languages there are.

    The first scan estimates each language's number of distinct texts; the second keeps the texts whose hash lies under the
    language's threshold, chosen so that twice the wanted number is expected, and the least of these are ranked. A
    language whose threshold let too few through (copies, estimate off) just has a smaller sample.
    """
    named = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), text_or_empty(text).alias("text"))
    named = named.where(F.char_length("text").between(1, SAMPLE_CHARS)).withColumn("h", F.shiftrightunsigned(F.xxhash64("text"), 1))
    counts = named.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()  # a row a language
    if not counts:
        return named.select("lang", "text").limit(0)
    under = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], int(min(1.0, 2 * per_lang / max(r["n"], 1)) * ((1 << 63) - 1024)) + 1023)])
    few = named.where(F.col("h") <= F.element_at(under, F.col("lang"))).groupBy("lang", "h").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return few.withColumn("place", place).where(F.col("place") <= per_lang).select("lang", "text")


def fit(docs: DataFrame, lang: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """Train on at most ``SAMPLE_DOCS`` texts of each language (the languages' number is that of the label set)."""
    got = sampled(docs, lang, text).toArrow()
    if not got.num_rows:
        return [], np.zeros((0, 1 << TRIGRAM_BITS), np.float32)
    return train(got.column("text").to_pylist(), got.column("lang").to_pylist())


def text_log_likelihoods(model: tuple[list[str], np.ndarray], text: Column) -> Column:
    """Array of log P(text | language) / TEMPERATURE, in the languages' order."""
    names, logs = model

    @F.arrow_udf("array<double>")
    def likelihoods(texts: pa.Array) -> pa.Array:
        out = np.zeros((len(texts), len(names)))
        for block in blocks(texts):
            slot, row = _trigrams(block)
            for i in range(len(names)):
                out[block.first_row : block.first_row + block.rows, i] = np.bincount(row, logs[i][slot], minlength=block.rows)
        out /= TEMPERATURE
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * len(names)), pa.array(out.ravel()))

    return likelihoods(text)


def visible_text(html: Column) -> Column:
    """Markup removed: comments, scripts, styles, then tags and entities."""
    bare = F.regexp_replace(F.coalesce(html.cast("string"), F.lit("")), r"(?s)<!--.*?-->|(?i:<(script|style)\b).*?(?i:</\1>)", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"&#?\w+;|\s+", " "))


def _posterior(logs: Column) -> Column:
    top = F.array_max(logs)
    weights = F.transform(logs, lambda v: F.exp(v - top))
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b))


def _smoothed(values: Column):
    """Add-one log likelihood of one of ``values`` outcomes, from zipped counts a (outcome) and b (language)."""
    return lambda z: F.log((z["a"] + 1.0) / (z["b"] + values))


def identify(pages: DataFrame, model: tuple[list[str], np.ndarray], page_id: str = "page_id") -> DataFrame:
    """(page_id, host, declared, suffix, text_lang, language, confidence, posterior) of every page."""
    names = model[0]
    n = len(names)
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    parts = pages.select(
        F.col(page_id).alias("page_id"),
        host.alias("host"),
        F.lower(F.regexp_extract(F.coalesce(F.col("html").cast("string"), F.lit("")), r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]+)", 1)).alias("declared"),
        text_log_likelihoods(model, visible_text(F.col("html"))).alias("text_log"),
    ).select(
        "*",
        F.regexp_extract("host", r"([^.]*)$", 1).alias("suffix"),
        F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("domain"),
    )
    if not n:
        return parts.select("page_id", "host", "declared", "suffix", *[F.lit(None).cast(t).alias(c) for c, t in (("text_lang", "string"), ("language", "string"), ("confidence", "double"), ("posterior", "array<double>"))])
    seen = written(parts.withColumn("p", _posterior(F.col("text_log"))), "evidence")

    def counts(*keys: str) -> DataFrame:
        sums = F.array(*[F.sum(F.col("p")[i]) for i in range(n)])
        return seen.groupBy(*keys).agg(sums.alias("c_" + "_".join(keys) if keys else "c_all"))

    def total(c: Column) -> Column:
        return F.aggregate(c, F.lit(0.0), lambda a, b: a + b)

    # one row: the pages' expected number in each language, and how many values each table has
    sums = [F.sum(F.col("p")[i]) for i in range(n)]
    one = seen.agg(F.array(*sums).alias("by_lang"), *[F.count_distinct(k).alias(k) for k in ("declared", "suffix")]).first()
    by_lang = F.array(*[F.lit(float(v or 0.0)) for v in one["by_lang"]])
    kinds = {}
    for name in ("declared", "suffix"):
        c = counts(name)
        distinct = F.lit(float(one[name]))
        kinds[name] = c.select(
            name,
            F.transform(F.arrays_zip(F.col(f"c_{name}").alias("a"), by_lang.alias("b")), _smoothed(distinct)).alias(f"{name}_log"),
        )
    share = F.transform(by_lang, lambda v: (v + 1.0) / (total(by_lang) + n))
    domain = counts("domain").select(
        "domain",
        F.transform(F.arrays_zip(F.col("c_domain").alias("a"), share.alias("b")), lambda z: (z["a"] + DOMAIN_STRENGTH * z["b"]) / (total(F.col("c_domain")) + DOMAIN_STRENGTH)).alias("d_prior"),
    )
    hosts = counts("host", "domain").join(domain, "domain").select(
        "host",
        F.transform(F.arrays_zip(F.col("c_host_domain").alias("a"), F.col("d_prior").alias("b")), lambda z: F.log((z["a"] + HOST_STRENGTH * z["b"]) / (total(F.col("c_host_domain")) + HOST_STRENGTH))).alias("host_log"),
    )
    fused = (
        seen.join(hosts, "host")
        .join(kinds["declared"], "declared")
        .join(kinds["suffix"], "suffix")
        .withColumn(
            "posterior",
            _posterior(F.transform(F.arrays_zip("text_log", "host_log", "declared_log", "suffix_log"), lambda z: z["text_log"] + z["host_log"] + z["declared_log"] + z["suffix_log"])),
        )
    )
    label = F.array(*map(F.lit, names))

    def best(c: str) -> Column:
        return F.element_at(label, F.array_position(c, F.array_max(c)).cast("int"))

    return fused.select(
        "page_id", "host", "declared", "suffix", best("p").alias("text_lang"), best("posterior").alias("language"),
        F.array_max("posterior").alias("confidence"), "posterior",
    )
