"""Token counts as delta-maintained rollups.

A store (a folder on shared storage) holds additive totals by (source, lang, tokenizer version). Changes come in batches of
signed deltas: an insert adds a document's tokens, a delete takes them away, a revision does both (old count out, new one
in). A batch is summed to one row per group before it is written, so the store's size follows groups and batches, not
documents; the hot source is pre-aggregated map-side.

Commits are idempotent: rows are written to a folder of their own, and a log entry that names batch and folder makes them
count. A batch that is sent again is left as it was committed; one whose driver was lost halfway was never committed.
``totals`` sums the newest base and the batches that it does not hold; ``compact`` folds all batches into a new base, whose
log entry names them, so that a folded batch that arrives again is ignored, also by a client that was not there before.

Defined results: null sources and languages are groups of their own; null texts count no tokens but one document; a null
or unknown operation is an error; groups whose documents sum to zero leave the totals; deltas in any order give the
same totals; an empty batch is a batch without rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_ascii, text_or_empty

KEYS = ["source", "lang", "version"]
_SCHEMA = "source string, lang string, version string, n_docs long, n_tokens long"

# The tokenizer versions and their patterns.
VERSIONS = {"words-1": r"[^\x20\x09-\x0D]+", "pieces-1": r"[A-Za-z]+|[0-9]+|[^\x00-\x7F]+", "pieces-2": r"[a-z]+|[0-9]|[^\x00-\x7F]+"}


def count_tokens(version: str, text: str = "text") -> Column:
    """Tokens of a text under a version (``pieces-2`` lower-cases A-Z first and counts each digit)."""
    body = fold_ascii(text_or_empty(text)) if version == "pieces-2" else text_or_empty(text)
    return F.regexp_count(body, F.lit(VERSIONS[version])).cast("long")


def deltas(docs: DataFrame, version: str, op: str, tokens: Column | None = None) -> DataFrame:
    """Signed delta rows of documents under a version; ``op`` is insert or delete."""
    sign = {"insert": 1, "delete": -1}[op]
    count = count_tokens(version) if tokens is None else tokens
    return docs.select(
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.lit(version).alias("version"),
        F.lit(sign).cast("long").alias("n_docs"),
        (sign * count).alias("n_tokens"),
    )


def revision(docs: DataFrame, old: str, new: str, old_tokens: Column | None = None, new_tokens: Column | None = None) -> DataFrame:
    """Documents counted under ``old`` move to ``new``: one delete and one insert each."""
    return deltas(docs, old, "delete", old_tokens).unionAll(deltas(docs, new, "insert", new_tokens))


def counted(docs: DataFrame, versions: dict[str, str], text: str = "text") -> DataFrame:
    """The documents without their text, with one token count for each {column: version}; joins then move no text."""
    return docs.select(*[c for c in docs.columns if c != text], *[count_tokens(v, text).alias(c) for c, v in versions.items()])


class TokenRollup:
    """The store below ``path``: attempts of batches and bases in folders of their own, and what counts in ``log``.

    A log entry is one small JSON file, moved to its name in one step when it is whole. It names the folder of a batch, or
    of a base and all batches that the base holds. A new client of the path therefore knows what is folded; nothing has to
    be remembered by the caller.
    """

    _LOG = "kind string, id string, seq long, folder string, holds array<string>"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _log(self) -> list:
        """The log entries, one a batch and one a base: bounded by commits, not by documents.

        Where two writers committed the same batch or base at a time, all readers take the same one of the two.
        """
        try:
            rows = self.spark.read.schema(self._LOG).json(f"{self.path}/log/*").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return list({(r["kind"], r["id"], r["seq"]): r for r in sorted(rows, key=lambda r: r["folder"])}.values())

    def _commit(self, kind: str, batch_id: str | None, seq: int | None, folder: str, holds: list[str]) -> None:
        entry = self.spark.createDataFrame([(kind, batch_id, seq, folder, holds)], self._LOG)
        entry.coalesce(1).write.mode("errorifexists").json(f"{self.path}/log/{uuid.uuid4().hex}")

    def _write(self, rows: DataFrame) -> str:
        """Rows into a folder of their own; one that the log never names is left by a lost driver."""
        folder = f"attempts/{uuid.uuid4().hex}"
        rows.write.mode("errorifexists").parquet(f"{self.path}/{folder}")
        return folder

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch of delta rows; False if a batch of this id is committed already (it is then left as it is).

        A driver lost before the log entry leaves no trace in the totals, and the batch can be sent again.
        """
        if any(r["kind"] == "batch" and r["id"] == batch_id for r in self._log()):
            return False
        summed = changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        self._commit("batch", batch_id, None, self._write(summed), [batch_id])
        return True

    def batches(self) -> list[str]:
        """Ids of the committed batches."""
        return sorted(r["id"] for r in self._log() if r["kind"] == "batch")

    def _parts(self) -> list:
        """The log entries that make the totals: the newest base, and the batches that it does not hold."""
        log = self._log()
        bases = sorted((r for r in log if r["kind"] == "base"), key=lambda r: r["seq"])[-1:]
        folded = set(bases[0]["holds"]) if bases else set()
        return bases + [r for r in log if r["kind"] == "batch" and r["id"] not in folded]

    def totals(self) -> DataFrame:
        """Totals over all committed batches, each counted once."""
        return self._sum(self._parts()).where("n_docs <> 0")

    def _sum(self, parts: list) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], _SCHEMA)
        rows = self.spark.read.schema(_SCHEMA).parquet(*[f"{self.path}/{r['folder']}" for r in parts])
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> int:
        """Fold everything committed so far into a new base; returns its number. A batch that is committed meanwhile stays a batch."""
        parts = self._parts()
        seq = 1 + max((r["seq"] for r in parts if r["kind"] == "base"), default=0)
        holds = sorted({b for r in parts for b in r["holds"]})
        self._commit("base", None, seq, self._write(self._sum(parts)), holds)
        return seq
