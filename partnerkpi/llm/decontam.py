"""Benchmark decontamination with DataFrame functions only (no Python on the executors).

Words are runs of 0-9, a-z (A-Z lower-cased) and all characters beyond ASCII. A window is ``n`` consecutive words of a
benchmark item, or the whole item where it has fewer (but some). The windows' 64-bit hashes form a broadcast hash set;
the word windows of every document are hashed, probed against it and verified word by word on a hit, all in one pass
over the documents: the word array rides along as a reference and is only copied for hits.

The broadcast is bounded: the windows' number is counted first, and beyond ``max_windows`` they are dealt by hash into
as many sets as needed, each scanned in a pass of its own over all documents (a stated query set in blocks).

Defined results: null or wordless texts have no words and no hits; an item without words has no window; equal windows
of many items count for each of these items; repeated document rows keep their number, also under a null doc_id; an
empty benchmark leaves every document clean; extra columns are ignored by ``contamination`` and kept by ``remove_*``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_ascii, text_or_empty, written

WORD_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A broadcast set holds at most so many windows (about 150 bytes each with their words).
MAX_WINDOWS = 1_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(fold_ascii(text), WORD_SEPARATORS), "")


def benchmark_windows(benchmark: DataFrame, n: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per distinct window: ``h``, ``window`` (its words), ``size`` and ``items`` (the ids that hold it)."""
    items = benchmark.select(F.col(item_id).alias("item_id"), words(text_or_empty(text)).alias("w")).where("size(w) > 0")
    size = F.least(F.size("w"), F.lit(n))
    each = items.select(
        "item_id", "w", size.alias("size"), F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("at")
    )
    return (
        each.select("item_id", "size", F.slice("w", F.col("at"), F.col("size")).alias("window"))
        .groupBy("window", "size")
        .agg(F.collect_set("item_id").alias("items"))
        .select(F.xxhash64("window").alias("h"), "window", "size", "items")
    )


def _window_hashes(w: Column, k: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(w) - k + 1), lambda i: F.xxhash64(F.slice(w, i, F.lit(k))))


def _hits(base: DataFrame, windows: DataFrame, sizes: list[int], keep: list[str]) -> DataFrame:
    """Rows (keep..., at, size, items) of verified hits, and one row with at = 0 for every document row."""
    w, n = F.col("__w"), F.col("n_words")
    # one array of hashes per document: a sentinel, then the windows of the least size, of the next, ...
    probes = F.array(F.lit(0).cast("long"))
    for k in sizes:
        hashes = _window_hashes(w, k)
        probes = F.concat(probes, F.when(F.size(w) >= k, hashes).otherwise(F.array().cast("array<bigint>")))
    # the sentinel's partner: every document row comes through
    sentinel = base.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("b_h"),
        F.lit(None).cast("array<string>").alias("b_window"),
        F.lit(0).alias("size"),
        F.lit(None).cast(windows.schema["items"].dataType).alias("items"),
    )
    side = windows.select(F.col("h").alias("b_h"), F.col("window").alias("b_window"), "size", "items").unionAll(sentinel)
    # outer: the array is never empty, and Spark then infers no filter that would compute it twice
    probed = base.select(*keep, "__w", probes.alias("__p")).select(*keep, "__w", F.posexplode_outer("__p").alias("pos", "h"))
    before = F.lit(1).cast("long")  # entries ahead of the first window of this size
    offset = F.lit(None).cast("long")
    for k in sizes:
        offset = F.when(F.col("size") == k, before).otherwise(offset)
        before = before + F.greatest(n - k + 1, F.lit(0))
    at = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("pos") - offset + 1).cast("int")
    same = F.when(F.col("at") > 0, F.slice("__w", F.col("at"), F.col("size")) == F.col("b_window"))
    return (
        probed.join(F.broadcast(side), F.col("h") == F.col("b_h"))
        .withColumn("at", at)
        .where(((F.col("size") == 0) & (F.col("pos") == 0)) | ((F.col("size") > 0) & same))
        .select(*keep, "at", "size", "items")
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """One row per document row: doc_id, n_words, hits (array of at, size: 1-based word windows), items (sorted ids as strings).

    ``text_key`` tells texts under one doc_id apart.
    """
    windows = written(benchmark_windows(benchmark, n, item_id), "windows", small=True)
    stats = windows.agg(F.count("*").alias("n"), F.sort_array(F.collect_set("size")).alias("sizes")).first()
    sets = max(1, -(-stats["n"] // max_windows))
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(text_or_empty(text)).alias("text_key"),
        words(text_or_empty(text)).alias("__w"),
    )
    base = base.withColumn("n_words", F.size("__w").cast("long"))
    hits = None
    for s in range(sets):
        part = windows.where(F.pmod("h", F.lit(sets)) == s) if sets > 1 else windows
        found = _hits(base, part, list(stats["sizes"]), ["doc_id", "text_key", "n_words"])
        hits = found if hits is None else hits.unionAll(found)
    grouped = hits.groupBy("doc_id", "text_key", "n_words").agg(
        F.count_if(F.col("at") == 0).alias("rows"),
        F.collect_set(F.when(F.col("at") > 0, F.struct("at", "size"))).alias("hits"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    return grouped.select(
        "doc_id",
        "text_key",
        "n_words",
        "hits",
        F.sort_array(F.transform("items", lambda i: i.cast("string"))).alias("items"),
        F.explode(F.sequence(F.lit(1).cast("long"), (F.col("rows") / sets).cast("long"))).alias("copy"),
    ).drop("copy")


def hit_words(hits: str = "hits") -> Column:
    """The distinct 1-based word positions inside any hit."""
    inside = F.transform(F.col(hits), lambda h: F.sequence(h["at"], h["at"] + h["size"] - 1))
    return F.array_distinct(F.flatten(inside))


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without any hit, all columns kept."""
    bad = contamination(docs, benchmark, n, doc_id, text).where(F.size("hits") > 0)
    bad = bad.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    key = F.xxhash64(text_or_empty(text))
    return docs.join(bad, docs[doc_id].eqNullSafe(F.col("__id")) & (key == F.col("__key")), "left_anti")


def remove_spans(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, doc_id: str = "doc_id", text: str = "text", out: str = "clean_words"
) -> DataFrame:
    """Add ``out``: the document's words without those inside hits, space-joined (null where nothing was hit)."""
    bad = contamination(docs, benchmark, n, doc_id, text).where(F.size("hits") > 0)
    bad = bad.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.first(hit_words()).alias("__hit"))
    key = F.xxhash64(text_or_empty(text))
    joined = docs.join(bad, docs[doc_id].eqNullSafe(F.col("__id")) & (key == F.col("__key")), "left")
    kept = F.transform(
        F.array_except(F.sequence(F.lit(1), F.size(words(F.col(text)))), F.col("__hit")),
        lambda i: F.element_at(words(F.col(text)), i),
    )
    cleaned = F.when(F.col("__hit").isNotNull(), F.array_join(kept, " "))
    return joined.withColumn(out, cleaned).drop("__id", "__key", "__hit")
