"""Repeated passages by a sparse suffix array.

Words are runs of anything but space and \\x09-\\x0D, A-Z lower-cased. Suffixes are retained only at minimiser positions:
of every ``window`` neighbouring ``gram_words``-word grams the one of least hash (ties all). With window + gram_words - 1
<= min_words, two texts that share a passage of ``min_words`` words retain the same suffix start inside it.

1. Sort: the retained suffixes are range-sorted by their opening gram and text, so equal openings are neighbours; one
   whose run holds another text too survives. A run that reaches the end of a sorted batch is kept without a look
   across the border, which costs a candidate, never a match, so a run of any length needs no single task.
2. Extend: around each surviving suffix the ``min_words``-word windows that contain its opening are taken, one for each
   split of the remaining words into an extension to the left and one to the right. A window that two texts hold is a
   repeated passage of at least ``min_words`` words; runs of neighbouring windows make up the maximal passage. The
   windows are matched by a 96-bit hash and aggregated map-side (least holder, another holder or not), so a passage in a
   third of all texts is no hot group.

Equal texts are collapsed to one class (128-bit digest) first and get their class's passages at the end; a text of
``min_words`` words or more with a copy repeats as a whole. Repeats inside one text alone are not reported.

Defined results: null, empty and short texts (under ``min_words`` words) repeat nothing; repeated rows (also of one
doc_id) are copies of each other; the holder of a passage is the one with the least doc_id, null last; an empty table
gives no rows; ``repeated_passages`` ignores extra columns, ``cut_repeats`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, written
from .wordscan import FOLD, Block, blocks, doc_of, gram_hashes, span_hashes

MIN_WORDS = 50
GRAM_WORDS = 19
#: Rank of a text that no doc_id names.
_NO_ID = (1 << 63) - 1


def _word_hashes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each (lower-cased) word, and the first word of each text."""
    starts, ends, first = block.words()
    return span_hashes(FOLD[block.data], starts, ends), first


def minimiser_positions(grams: np.ndarray, window: int, usable: np.ndarray) -> np.ndarray:
    """Flags of positions that hold the least value of some full window; ``usable[j]``: the window at j is in one text."""
    n = len(grams)
    low = grams.copy()
    reach = 1
    while reach < window:  # low[j] = min of grams[j : j + reach]
        step = min(reach, window - reach)
        rest = max(n - step, 0)  # a block may have fewer grams than the step
        low[:rest] = np.minimum(low[:rest], low[step:])
        reach += step
    low[~usable] = 0
    high = low
    reach = 1
    while reach < window:  # high[p] = max of low[p - reach + 1 : p + 1]
        step = min(reach, window - reach)
        nxt = high.copy()
        nxt[step:] = np.maximum(high[step:], high[: max(n - step, 0)])
        high = nxt
        reach += step
    return (grams <= high) & (high > 0)


def retained(block: Block, min_words: int, gram_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Retained suffixes of a block: row, word position, opening hash; and the number of words of each row."""
    words, first = _word_hashes(block)
    count = np.diff(first)
    window = min_words - gram_words + 1
    grams = gram_hashes(words, gram_words)
    if not len(grams):
        e = np.empty(0, np.int64)
        return e, e, np.empty(0, np.uint64), count
    doc = doc_of(first)
    usable = np.zeros(len(grams), bool)
    last = len(words) - min_words + 1
    if last > 0:
        usable[:last] = doc[:last] == doc[min_words - 1 :]
    at = np.flatnonzero(minimiser_positions(grams, window, usable))
    return doc[at], at - first[doc[at]], grams[at], count


def _suffixes(min_words: int, gram_words: int):
    schema = pa.schema([("cls", pa.binary()), ("doc_id", pa.int64()), ("n_words", pa.int32()), ("keys", pa.list_(pa.int64())), ("pos", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                doc, pos, key, count = retained(block, min_words, gram_words)
                rows = np.flatnonzero(count >= min_words)
                cut = np.searchsorted(doc, np.append(rows, block.rows)).astype(np.int32)
                take = pa.array(rows + block.first_row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("cls").take(take),
                        batch.column("doc_id").take(take),
                        pa.array(count[rows], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(key.view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(pos, pa.int32())),
                    ],
                    schema=schema,
                )

    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of suffixes in sorted order, those whose run of equal openings holds another text (or touches the batch's ends)."""
    for batch in batches:
        key = batch.column("key").to_numpy(zero_copy_only=False)
        if not len(key):
            continue
        cls = batch.column("cls").to_numpy(zero_copy_only=False)
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        keep = cls[start] != cls[start + size - 1]  # sorted by text inside the run
        keep[[0, -1]] = True
        rows = pa.array(np.flatnonzero(np.repeat(keep, size)))
        yield pa.RecordBatch.from_arrays([batch.column("cls").take(rows), batch.column("pos").take(rows)], names=["cls", "pos"])


def _windows(min_words: int, gram_words: int):
    """For each text with surviving suffixes: start and two hashes of every window that contains one of their openings."""
    reach = min_words - gram_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_pos = batch.column("pos")
            for block in blocks(batch.column("text")):
                words, first = _word_hashes(block)
                count = np.diff(first)
                part = all_pos.slice(block.first_row, block.rows)
                n_pos = np.diff(np.asarray(part.offsets))
                pos = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(block.rows), n_pos)
                marks = np.zeros(len(words) + 1, np.int64)
                np.add.at(marks, first[row] + np.maximum(pos - reach, 0), 1)
                np.add.at(marks, first[row] + pos + 1, -1)
                inside = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
                doc = doc_of(first)[inside]
                inside = inside[inside + min_words <= first[doc + 1]]
                doc = doc_of(first)[inside]
                h1 = gram_hashes(words, min_words)[inside] if len(inside) else np.empty(0, np.uint64)
                h2 = gram_hashes(words ^ (words >> np.uint64(29)), min_words)[inside] if len(inside) else h1
                cut = pa.array(np.searchsorted(doc, np.arange(block.rows + 1)).astype(np.int32))
                take = pa.array(np.arange(block.first_row, block.first_row + block.rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("cid").take(take),
                        batch.column("rank").take(take),
                        pa.ListArray.from_arrays(cut, pa.array(h1.view(np.int64))),
                        pa.ListArray.from_arrays(cut, pa.array((h2 >> np.uint64(32)).astype(np.uint32).view(np.int32))),
                        pa.ListArray.from_arrays(cut, pa.array((inside - first[doc]).astype(np.int32))),
                    ],
                    names=["cid", "rank", "h1", "h2", "start"],
                )

    return run


def _merge(min_words: int):
    """Merge each class's shared windows into maximal passages, those first held here and those held ``later`` apart."""
    schema = pa.schema([("cid", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("first_doc_id", pa.int64()), ("later", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, hits in zip(batch.column("cid").to_pylist(), batch.column("hits"), strict=True):
                v = hits.values
                start = v.field("start").to_numpy(zero_copy_only=False)
                later = np.asarray(v.field("later").to_numpy(zero_copy_only=False), bool)
                holder = v.field("first_doc_id").to_pylist()
                order = np.lexsort((start, later))
                start, later = start[order], later[order]
                new = np.concatenate([[True], (np.diff(start) > 1) | (later[1:] != later[:-1])])
                at = np.flatnonzero(new)
                end = np.append(at[1:], len(start)) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([cid] * len(at), pa.int64()),
                        pa.array(start[at].astype(np.int32)),
                        pa.array((start[end] + min_words).astype(np.int32)),
                        pa.array([holder[order[i]] for i in at], pa.int64()),
                        pa.array(later[at]),
                    ],
                    schema=schema,
                )

    return run


def _class_passages(docs: DataFrame, min_words: int, gram_words: int) -> tuple[DataFrame, DataFrame]:
    """(classes, passages): cls, cid, rep_id, n_copies, n_words; and cid, start, end (words), first_doc_id, later."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text_or_empty())).alias("cls"), text_or_empty().alias("text"))
    light = base.mapInArrow(
        _suffixes(min_words, gram_words), "cls binary, doc_id long, n_words int, keys array<long>, pos array<int>"
    )
    classes = written(
        light.groupBy("cls").agg(
            F.min("doc_id").alias("rep_id"),
            F.count("*").alias("n_copies"),
            F.first("n_words").alias("n_words"),
            F.first("keys").alias("keys"),
            F.first("pos").alias("pos"),
        ).withColumn("cid", F.xxhash64("cls")),
        "classes",
    )
    suffixes = classes.select("cls", F.explode(F.arrays_zip("keys", "pos")).alias("s")).select(
        F.col("s.keys").alias("key"), "cls", F.col("s.pos").alias("pos")
    )
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = (
        suffixes.repartitionByRange(tasks, "key", "cls", "pos")
        .sortWithinPartitions("key", "cls", "pos")
        .mapInArrow(_neighbours, "cls binary, pos int")
        .groupBy("cls")
        .agg(F.sort_array(F.collect_list("pos")).alias("pos"))
    )
    wanted = shared.join(classes.select("cls", "rep_id", "cid"), "cls").select(F.col("cls").alias("w_cls"), "rep_id", "cid", "pos")
    texts = base.join(wanted, (F.col("cls") == F.col("w_cls")) & F.col("doc_id").eqNullSafe(F.col("rep_id"))).select(
        "cid", F.coalesce("rep_id", F.lit(_NO_ID)).alias("rank"), "pos", "text"
    )
    windows = written(
        texts.mapInArrow(
            _windows(min_words, gram_words), "cid long, rank long, h1 array<long>, h2 array<int>, start array<int>"
        )
        .select("cid", "rank", F.explode(F.arrays_zip("h1", "h2", "start")).alias("w"))
        .select("cid", "rank", F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2"), F.col("w.start").alias("start")),
        "windows",
    )
    held = (
        windows.groupBy("h1", "h2")
        .agg(F.min("rank").alias("first"), F.min("cid").alias("low"), F.max("cid").alias("high"))
        .where("low <> high")
        .select("h1", "h2", "first")
    )
    hit = F.struct("start", F.nullif("first", F.lit(_NO_ID)).alias("first_doc_id"), (F.col("rank") > F.col("first")).alias("later"))
    passages = (
        windows.join(held, ["h1", "h2"])
        .groupBy("cid")
        .agg(F.collect_set(hit).alias("hits"))
        .mapInArrow(_merge(min_words), "cid long, start int, end int, first_doc_id long, later boolean")
    )
    return classes, written(passages, "passages", small=True)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS) -> DataFrame:
    """Every maximal passage of ``min_words`` words or more that another document holds too.

    One row per document and passage: doc_id, start_word, end_word (0-based, exclusive), n_words, first_doc_id (the
    least document that holds its beginning), is_copy (the whole text has a copy).
    """
    classes, passages = _class_passages(docs, min_words, gram_words)
    whole = classes.where("n_copies > 1").select(
        "cid", F.lit(0).alias("start"), F.col("n_words").alias("end"), F.col("rep_id").alias("first_doc_id"), F.lit(True).alias("is_copy")
    )
    # windows held first here and those held first elsewhere touch: a document's passage is their union
    part = passages.join(whole.select("cid"), "cid", "left_anti").select("cid", "start", "end", "first_doc_id")
    joined = part.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("start", "end", "first_doc_id"))).alias("p"))
    merged = joined.select(
        "cid",
        F.explode(
            F.aggregate(
                "p",
                F.slice("p", 1, 0),
                lambda acc, x: F.when((F.size(acc) == 0) | (F.element_at(acc, -1)["end"] <= x["start"]), F.concat(acc, F.array(x))).otherwise(
                    F.concat(
                        F.slice(acc, 1, F.size(acc) - 1),
                        F.array(
                            F.struct(
                                F.element_at(acc, -1)["start"].alias("start"),
                                F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"),
                                F.least(F.element_at(acc, -1)["first_doc_id"], x["first_doc_id"]).alias("first_doc_id"),
                            )
                        ),
                    )
                ),
            )
        ).alias("m"),
    ).select("cid", "m.*", F.lit(False).alias("is_copy"))
    ids = docs.select(F.col("doc_id"), F.xxhash64(F.unhex(F.md5(text_or_empty()))).alias("cid"))
    return ids.join(whole.unionByName(merged), "cid").select(
        "doc_id",
        F.col("start").alias("start_word"),
        F.col("end").alias("end_word"),
        (F.col("end") - F.col("start")).alias("n_words"),
        "first_doc_id",
        "is_copy",
    )


def _cut_words(texts: pa.Array, spans: pa.Array) -> list[str]:
    out: list[str] = []
    for block in blocks(texts):
        starts, ends, first = block.words()
        for r in range(block.rows):
            cuts = spans[block.first_row + r].as_py() or []
            raw = block.data[block.offsets[r] : block.offsets[r + 1]].tobytes()
            base, lo, hi = int(block.offsets[r]), int(first[r]), int(first[r + 1])
            kept, at = [], 0
            for c in sorted(cuts, key=lambda c: (c["start"], c["end"])):
                s = int(starts[lo + c["start"]]) - base
                e = int(ends[min(lo + c["end"], hi) - 1]) - base
                if s > at:
                    kept.append(raw[at:s])
                at = max(at, e)
            kept.append(raw[at:])
            out.append(b"".join(kept).decode("utf-8"))
    return out


def cut_repeats(docs: DataFrame, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS) -> DataFrame:
    """The documents with each repeated passage left only where the least document holds it; emptied documents go.

    Of equal texts of ``min_words`` words or more, the rows of least doc_id stay (all, where none has one); texts that
    share a doc_id do not cut each other.
    Other columns are kept, ``n_chars`` (where present) is counted anew.
    """
    classes, passages = _class_passages(docs, min_words, gram_words)
    later = passages.where("later").groupBy("cid").agg(F.collect_list(F.struct("start", "end")).alias("__cuts"))
    copies = classes.where("n_copies > 1").select("cid", F.col("rep_id").alias("__rep"))
    marks = later.join(copies, "cid", "full").withColumnRenamed("cid", "__m_cid")

    @F.arrow_udf("string")
    def without(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array(_cut_words(texts, spans), pa.string())

    cid = F.xxhash64(F.unhex(F.md5(text_or_empty())))
    joined = docs.withColumn("__cid", cid).join(marks, F.col("__cid") == F.col("__m_cid"), "left")
    joined = joined.where(F.col("__rep").isNull() | (F.col("doc_id") == F.col("__rep")))
    text = F.when(F.col("__cuts").isNotNull(), without(F.col("text"), F.col("__cuts"))).otherwise(F.col("text"))
    kept = joined.withColumn("text", text).where(F.col("__cuts").isNull() | (F.trim(F.col("text")) != ""))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("__cuts").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return kept.select(*docs.columns)
