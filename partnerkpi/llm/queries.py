"""The registered queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    adaptive_scan,
    bpe,
    decontam,
    filter_audit,
    language_id,
    lm_mixing,
    periodic_runs,
    quality_crf,
    quality_rules,
    simhash,
    suffix_dedup,
    token_rollup,
    toxicity,
)
from .common import id_bucket, read_table, scratch_dir, text_or_empty, with_code, written


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (4-word shingles, links at 4 bits or fewer)."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)
    return found.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op2_language_evidence_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, the text model trained on the documents' languages."""
    model = language_id.fit(read_table(spark, sf_dir, "documents"))
    found = language_id.identify(read_table(spark, sf_dir, "pages"), model)
    return found.select("page_id", "host", "declared", "suffix", "text_lang", "language", F.round("confidence", 6).alias("confidence"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes of every document."""
    import public_tokenizers

    ranks = bpe.broadcast_ranks(
        spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, ranks).drop("text"), ranks)
    return coded.select(
        "doc_id",
        bpe.n_tokens().alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op4_quality_rules_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of every document."""
    found = quality_rules.judged(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document, for windows of 10 words."""
    found = decontam.contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), n=10
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size(decontam.hit_words()).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def training_labels(spark: SparkSession, sf_dir: str, mod: int = 5) -> DataFrame:
    """The labelled rows that may be learned from: crc32 of the doc_id as text, modulo ``mod``, is not 0."""
    return read_table(spark, sf_dir, "labels").where(id_bucket(mod) != 0)


def op6_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, trained on the labelled rows outside the held-out fifth."""
    docs = read_table(spark, sf_dir, "documents")
    model = quality_crf.fit(docs, training_labels(spark, sf_dir), label="quality")
    scored = docs.select("doc_id", quality_crf.score_column(model).alias("score"))
    return scored.select(
        "doc_id", (id_bucket(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op7_lm_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base score and context-mixing score of every document, trained outside the held-out seventh."""
    return lm_mixing.score(read_table(spark, sf_dir, "documents"), mod=7, rest=2)


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by source, language and tokenizer version after five batches, one of them sent twice.

    All documents are inserted under two versions; those labelled of bad quality are deleted from both; the toxic ones
    among the others are revised from ``pieces-1`` to ``pieces-2``; two batches are folded into a base on the way.
    """
    texts = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    docs = written(token_rollup.counted(texts, {"words": "words-1", "pieces": "pieces-1", "recount": "pieces-2"}), "counts")
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    bad = docs.join(labels.where("quality = 0"), "doc_id", "left_semi")
    toxic = docs.join(labels.where("quality = 1 and toxic = 1"), "doc_id", "left_semi")
    words, pieces = F.col("words"), F.col("pieces")
    store = token_rollup.TokenRollup(spark, scratch_dir(spark))
    store.commit("words", token_rollup.deltas(docs, "words-1", "insert", words))
    store.commit("pieces", token_rollup.deltas(docs, "pieces-1", "insert", pieces))
    store.compact()
    gone = token_rollup.deltas(bad, "words-1", "delete", words).unionAll(token_rollup.deltas(bad, "pieces-1", "delete", pieces))
    store.commit("bad-quality", gone)
    store.commit("bad-quality", gone)  # sent again: no effect
    store.commit("recount", token_rollup.revision(toxic, "pieces-1", "pieces-2", pieces, F.col("recount")))
    return store.totals()


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal passages of 50 words or more that another document holds too, with the first holder."""
    return suffix_dedup.repeated_passages(read_table(spark, sf_dir, "documents"), min_words=50)


def op10_toxicity_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, trained on the labelled rows outside the held-out fifth."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, training_labels(spark, sf_dir), label="toxic")
    scored = docs.select("doc_id", toxicity.score_column(model).alias("score"))
    return scored.select(
        "doc_id", (id_bucket(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op11_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest other rows of every hundredth vector, by Euclidean distance."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = adaptive_scan.build(vectors, k=10)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = adaptive_scan.search(index, vectors.where(F.col("vec_id") % 100 == 0))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of five filters over all documents: kept, removed, redundant, unique, lost rows and Shapley sums by source."""
    return filter_audit.audit(spark, f"{sf_dir.rstrip('/')}/documents.parquet", read_table(spark, sf_dir, "labels"))


def planted_tails(docs: DataFrame) -> DataFrame:
    """``doc_id`` and text, where every tenth text (by h = crc32 of the id as text) ends in a repeated unit.

    With g = h div 10 and n words, word i >= a = g mod n becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    """
    h = id_bucket(1 << 32).cast("long")
    docs = docs.select("doc_id", text_or_empty().alias("text"), h.alias("h"), F.floor(h / 10).alias("g"))
    spaced = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    words = F.when((F.col("h") % 10 == 0) & (spaced != ""), F.split(spaced, " "))  # null: the text stays
    docs = docs.withColumn("words", words).withColumn("n", F.size("words").cast("long"))
    docs = docs.withColumn("a", F.when(F.col("words").isNotNull(), F.col("g") % F.col("n")))
    docs = docs.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    a, p, rest = F.col("a").cast("int"), F.col("p").cast("int"), (F.col("n") - F.col("a")).cast("int")
    unit = F.array_repeat(F.slice("words", a + 1, F.least(p, rest)), F.ceil(rest / p).cast("int"))
    tail = F.slice(F.flatten(unit), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return docs.select("doc_id", F.coalesce(planted, F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 24 words and three periods or more in every document after its tail is planted, and digests of them."""
    docs = planted_tails(read_table(spark, sf_dir, "documents"))
    found = periodic_runs.with_runs(docs, result="p", min_words=24, min_repeats=3).select("doc_id", "p.runs", "p.collapsed")
    found = found.withColumn("best", periodic_runs.strongest(F.col("runs")))
    milli = F.floor(1000 * F.col("best.length") / F.col("best.period"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        milli.cast("long").alias("exponent_milli"),
        F.sha2(periodic_runs.runs_text(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_language_evidence_fusion": op2_language_evidence_fusion,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_quality_rules_mcd": op4_quality_rules_mcd,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_quality_crf": op6_quality_crf,
    "op7_lm_context_mixing": op7_lm_context_mixing,
    "op8_token_rollup": op8_token_rollup,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_toxicity_string_kernel": op10_toxicity_string_kernel,
    "op11_adaptive_scan": op11_adaptive_scan,
    "op12_filter_audit": op12_filter_audit,
    "op13_periodic_runs": op13_periodic_runs,
}

QUERIES = {name: with_code(query) for name, query in _QUERIES.items()}

_OP5_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

ORACLE_SQL: dict[str, str] = {
    "op5_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_OP5_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_OP5_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, w[i : i + least(len(w), 10) - 1] AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
grams AS (SELECT r, k, i, w[i : i + k - 1] AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
hit AS (SELECT r, grams.k, i, item_id FROM grams JOIN win ON grams.k = win.k AND grams.g = win.g),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS id_list
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(id_list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN ids USING (r)""",
    "op8_token_rollup": r"""
WITH l AS (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT source, lang, coalesce(quality = 0, false) AS bad, coalesce(quality = 1 AND toxic = 1, false) AS moved,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w1,
  len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[0-9]+|[^\x00-\x7F]+')) AS p1,
  len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[0-9]|[^\x00-\x7F]+')) AS p2
  FROM documents LEFT JOIN l USING (doc_id)),
t AS (SELECT source, lang, 'words-1' AS version, w1 AS n FROM c WHERE NOT bad
  UNION ALL SELECT source, lang, 'pieces-1', p1 FROM c WHERE NOT bad AND NOT moved
  UNION ALL SELECT source, lang, 'pieces-2', p2 FROM c WHERE moved)
SELECT source, lang, version, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM t GROUP BY ALL""",
    "op12_filter_audit": r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lab AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
  100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t) AS c, regexp_matches(t, '[#$%&*|]') AS dd,
  coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS e FROM d LEFT JOIN lab USING (doc_id)),
k AS (SELECT part, good, toxic, CAST(a AS INT) + 2 * CAST(b AS INT) + 4 * CAST(c AS INT) + 8 * CAST(dd AS INT) + 16 * CAST(e AS INT) AS mask,
  count(*) AS n FROM m GROUP BY ALL),
o(ord) AS (SELECT '' UNION ALL SELECT ord || x FROM o, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(x) WHERE NOT contains(ord, x)),
s AS (SELECT ord AS filter_order, i AS step, CAST(pow(2, ascii(ord[i]) - 65) AS INT) AS bit,
  CAST(list_sum([pow(2, ascii(ord[j]) - 65) for j in range(1, i)]) AS INT) AS seen FROM o, range(1, 6) r(i) WHERE len(ord) = 5),
x AS (SELECT part, filter_order, step, bit, coalesce(seen, 0) AS seen, mask, n, good, toxic FROM s, k),
y AS (SELECT part, filter_order, CAST(step AS INT) AS step, bit,
  CAST(coalesce(sum(n) FILTER (mask & (seen | bit) = 0), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (mask & seen = 0 AND mask & bit > 0), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (mask & seen > 0 AND mask & bit > 0), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(n) FILTER (mask & seen = 0 AND mask & bit > 0 AND good), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(n) FILTER (mask & seen = 0 AND mask & bit > 0 AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM x GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM y""",
}
