"""Filter interaction audit: what each of five filters removes in every order, kept up to date by a retracting stream.

``audit`` reads the documents' files as a stream of available-now micro-batches. Filters A to D look at one text and give a
mask of failed conditions; E fails where a smaller id has the same text, which later files can bring at any time:

* state holds, for each text (its 128-bit digest), the least id so far and the parts of its rows;
* a larger id adds its mask with E; an equal id adds its mask without; a smaller id retracts the earlier holder's mask, adds
  that mask with E, and takes its place;
* the signed rows of a batch, joined to the labels, are summed by (part, mask, good, toxic) and written to the folder of
  their batch id, overwritten when the batch is run again, so that a restart from the stream's checkpoint counts nothing
  twice. The counters are the sums over all batches.

Counters have at most 128 rows a part; ``orders_report`` reads all 120 orders from them. A call of Python for each text would
cost milliseconds, so texts share state rows by digest: one bucket for each ``BUCKET_BYTES`` of the first input (the number is
kept with the checkpoint), merged as a whole frame. A batch rewrites the state, some 40 bytes a text, so batches should be
a hundredth of the input or more. Before the shuffle each Arrow batch keeps only the least id of a text; its other rows are
beaten already and need no state, they are spread by id, so a text that a third of the rows share sends one row for each
10,000 of them to its bucket. State lives in the session's state store (``spark.sql.streaming.stateStore.providerClass``;
choose RocksDB where two copies of the state do not fit the executors' heaps) with its checkpoint below
``spark.checkpoint.dir``: lost executors reload it from there.

Defined results: a null text is empty, a null source the empty string; rows without id are judged by A to D and neither fail
E nor make others fail; rows of equal id and text do not beat each other, each counts; equal ids in ``labels`` count as good
or toxic if any of their rows does; no documents give no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from .common import scratch_dir, text_or_empty
from .wordscan import blocks, doc_of, mixed, span_hashes

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
MIN_WORDS, MIN_DISTINCT_PCT, MAX_UPPER_PCT = 200, 50, 2
#: Compressed input of one micro-batch; the labels are read once for each.
BATCH_BYTES = 256 << 20
#: Compressed input for one bucket of the state, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 16 << 20, 256

# The symbols of filter D.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*|")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True

_MASKED = "bucket int, past boolean, d1 long, d2 long, doc_id long, part string, mask int, n long"
_MASKED_ARROW = pa.schema([
    ("bucket", pa.int32()), ("past", pa.bool_()), ("d1", pa.int64()), ("d2", pa.int64()), ("doc_id", pa.int64()),
    ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64()),
])
_TEXT_COLUMNS = ["d1", "d2", "doc_id", "part", "mask", "n"]
_DELTA_COLUMNS = ["doc_id", "part", "mask", "n"]
_DELTAS = "doc_id long, part string, mask int, n long"
_REPORT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)
_STATE = "texts binary"


def text_masks(texts: pa.Array) -> np.ndarray:
    """Failed conditions among A to D of each text, as bits."""
    out = np.zeros(len(texts), np.int32)
    for b in blocks(texts):
        starts, ends, first = b.words()
        doc = doc_of(first)
        words = np.diff(first)
        keys = mixed(span_hashes(b.data, starts, ends) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        new = np.ones(len(keys), bool)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        distinct = np.bincount(doc[order[new]], minlength=b.rows)
        points = b.row_sums((b.data & 0xC0) != 0x80)
        failed = (
            words < MIN_WORDS,
            100 * distinct < MIN_DISTINCT_PCT * words,
            100 * b.row_sums(_UPPER[b.data]) > MAX_UPPER_PCT * points,
            b.row_sums(_SYMBOL[b.data]) > 0,
        )
        out[b.first_row : b.first_row + b.rows] = sum(f.astype(np.int32) << k for k, f in enumerate(failed))
    return out


def _masked(buckets: int):
    """Rows of ``_MASKED``: of each text in an Arrow batch the least id goes to the text's bucket, the others are beaten."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            digest = np.frombuffer(b"".join(batch["digest"].to_pylist()), np.int64).reshape(-1, 2)
            known = np.asarray(batch["doc_id"].is_valid())
            ids = batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
            rows = pd.DataFrame({"d1": digest[:, 0], "d2": digest[:, 1], "doc_id": ids, "part": batch["part"].to_pandas(), "mask": text_masks(batch["text"])})
            least = rows[known].groupby(["d1", "d2"])["doc_id"].transform("min").reindex(rows.index, fill_value=0)
            beaten = known & (rows["doc_id"] > least).to_numpy()
            rows.loc[beaten, "mask"] |= COPY
            rows["known"], rows["past"] = known, beaten | ~known
            rows["bucket"] = (np.where(rows["past"], ids, digest[:, 0]) % buckets).astype(np.int32)
            rows = rows.groupby(["bucket", "past", "d1", "d2", "doc_id", "part", "mask", "known"], sort=False).size().reset_index(name="n")
            rows["doc_id"] = rows["doc_id"].astype("Int64").where(rows["known"])
            yield pa.RecordBatch.from_pandas(rows.drop(columns="known"), _MASKED_ARROW, preserve_index=False)

    return run


def retracted(held: pd.DataFrame, arrived: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The new state, and the signed rows that arrivals cause; a state has the rows of least id of each text."""
    every = pd.concat([held, arrived], ignore_index=True) if len(held) else arrived
    new = np.arange(len(every)) >= len(held)
    beaten = (every["doc_id"] > every.groupby(["d1", "d2"])["doc_id"].transform("min")).to_numpy()
    copies = every["mask"] | COPY
    displaced = every[beaten & ~new]
    signed = pd.concat([
        every.assign(mask=every["mask"].where(~beaten, copies))[new],
        displaced.assign(n=-displaced["n"]),
        displaced.assign(mask=displaced["mask"] | COPY),
    ])
    state = every[~beaten].groupby(["d1", "d2", "doc_id", "part", "mask"], sort=False)["n"].sum().reset_index()
    return state, signed


def _on_bucket(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """``retracted`` with a bucket's state as an Arrow file; rows that need no state go through."""
    arrived = []
    for frame in frames:
        past = frame["past"].astype(bool)
        if past.any():  # an empty frame would come out as a row of nulls
            yield frame.loc[past, _DELTA_COLUMNS]
        arrived.append(frame.loc[~past, _TEXT_COLUMNS])
    arrived = pd.concat(arrived, ignore_index=True)
    if arrived.empty:
        return
    arrived["doc_id"] = arrived["doc_id"].astype("int64")
    held = pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else arrived.iloc[:0]
    held, signed = retracted(held, arrived)
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(held, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    state.update((sink.getvalue().to_pybytes(),))
    yield signed[_DELTA_COLUMNS]


def deltas(docs: DataFrame, buckets: int) -> DataFrame:
    """Signed mask rows (doc_id, part, mask, n) of a stream of documents; at any time their sums are the true counts."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
    ).withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    masked = rows.mapInArrow(_masked(buckets), _MASKED)
    return masked.groupBy("bucket").applyInPandasWithState(_on_bucket, _DELTAS, _STATE, "update", GroupStateTimeout.NoTimeout)


def _buckets(spark: SparkSession, path: str, folder: str) -> int:
    """The number of buckets of this folder's state: set by its first input, then kept."""
    kept = spark.read.schema("buckets int").parquet(f"{folder}/buckets").head() if _exists(spark, f"{folder}/buckets") else None
    if kept:
        return kept["buckets"]
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).head()[0] or 0  # lists the files, reads none
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{folder}/buckets")
    return buckets


def _exists(spark: SparkSession, path: str) -> bool:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


def _as_glob(path: str) -> str:
    """The same path as a pattern: a file stream takes a plain path for a folder, a pattern for a file or a folder."""
    path = path.rstrip("/")
    return path if set(path) & set("*?[{") else f"{path[:-1]}[{path[-1]}]"


def counters(
    spark: SparkSession, path: str, schema: StructType, labels: DataFrame, folder: str, batch_bytes: int = BATCH_BYTES, batch_files: int | None = None
) -> DataFrame:
    """(part, mask, good, toxic, n) over all files of ``path``, by a stream whose checkpoint and batches live in ``folder``.

    Called again with the same folder it reads only files that came since.
    """
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    spark.createDataFrame([], "part string, mask int, good boolean, toxic boolean, n long").write.mode("overwrite").parquet(
        f"{folder}/counters/batch=-1"
    )  # an empty input has no batch of its own
    marks.where("good or toxic").write.mode("overwrite").parquet(f"{folder}/labels")

    def commit(batch: DataFrame, number: int) -> None:
        marked = batch.join(batch.sparkSession.read.parquet(f"{folder}/labels"), "doc_id", "left")
        good, toxic = (F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic"))
        sums = marked.groupBy("part", "mask", good, toxic).agg(F.sum("n").alias("n")).where("n <> 0")
        sums.coalesce(1).write.mode("overwrite").parquet(f"{folder}/counters/batch={number}")

    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", batch_files) if batch_files else reader.option("maxBytesPerTrigger", batch_bytes)
    query = (
        deltas(reader.parquet(_as_glob(path)), _buckets(spark, path, folder))
        .writeStream.outputMode("update")
        .foreachBatch(commit)
        .option("checkpointLocation", f"{folder}/stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = spark.read.schema("part string, mask int, good boolean, toxic boolean, n long, batch int").parquet(f"{folder}/counters")
    return found.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")


def _part_report(counts: pd.DataFrame) -> pd.DataFrame:
    """All orders and steps of one part, from its counters (128 rows at most).

    Everything follows from the 32 numbers "rows that fail no filter of the set S": what a step removes is their difference
    between the filters before it and those with it. A set S before a filter stands in |S|! (4 - |S|)! orders.
    """
    sets = np.arange(1 << len(FILTERS))
    mask = counts["mask"].to_numpy()
    outside = (mask[:, None] & sets[None]) == 0
    n, good, toxic = (counts["n"].to_numpy() * w for w in (1, counts["good"].to_numpy(), counts["toxic"].to_numpy()))
    clean, clean_good, clean_toxic = (np.sum(w[:, None] * outside, axis=0) for w in (n, good, toxic))
    times = [math.factorial(s.bit_count()) * math.factorial(len(FILTERS) - 1 - s.bit_count()) if s.bit_count() < len(FILTERS) else 0 for s in sets.tolist()]
    bits = [1 << k for k in range(len(FILTERS))]
    shapley = {b: sum(times[s] * int(clean[s] - clean[s | b]) for s in sets.tolist() if not s & b) for b in bits}
    rows = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            b = 1 << FILTERS.index(name)
            after = before | b
            removed = clean[before] - clean[after]
            rows.append((
                counts["part"].iloc[0], "".join(order), step, clean[after], removed, clean[0] - clean[b] - removed, n[mask == b].sum(),
                clean_good[before] - clean_good[after], clean_toxic[before] - clean_toxic[after], shapley[b],
            ))
            before = after
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _REPORT.split(", ")])


def orders_report(counts: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step, from (part, mask, good, toxic, n)."""
    return counts.groupBy("part").applyInPandas(_part_report, _REPORT)


def audit(spark: SparkSession, path: str, labels: DataFrame, folder: str | None = None, **batches: int) -> DataFrame:
    """The report over the Parquet files of ``path`` (columns doc_id, text, source)."""
    folder = folder or scratch_dir(spark)
    return orders_report(counters(spark, path, spark.read.parquet(path).schema, labels, folder, **batches))
