"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

``encode`` adds the token ids of a text column, packed as little-endian unsigned 32-bit integers (4 bytes a token: the
compact form that token stores use); ``unpack_ids`` turns them into an array, ``decode`` gives the raw bytes back, so a
token sequence that ends inside a character round-trips too.

Long texts are cut at safe boundaries first, so one text never needs regex or merge state for all its bytes: between a
character that is no white space and a following space or line end no match of the split pattern can reach across, and
a white-space run followed by text is one match but for its last character. Each piece's ids are then those of the
whole. Very long white-space runs (on which the backtracking regex engine overflows its stack) are cut the same way
and merged as the single match they are.

Nulls encode as the empty text (no ids, empty bytes); row order, repeated rows and other columns are untouched. The
rank file is read on the driver and broadcast (its size is that of the vocabulary, under 1 MB for 50,000 ranks), so
executors need no file of their own.
"""

from __future__ import annotations

import base64
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts of more characters are cut into pieces of about so many.
PIECE_CHARS = 1 << 16
#: White-space runs of more characters are merged as single matches.
LONG_RUN = 512
# The characters with Unicode property White_Space, which \s of the split pattern matches.
WHITE_SPACE = (
    "\x09\x0a\x0b\x0c\x0d\x20\x85\xa0            "
    "    　"
)

_SAFE = re.compile(r"(?<=\S)(?=[ \n])")
_LONG = re.compile(f"[{WHITE_SPACE}]{{{LONG_RUN},}}")
_CODECS: dict[int, object] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def broadcast_ranks(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """Read the rank file on the driver and send it to every worker, under a name of its own."""
    return spark.sparkContext.broadcast((uuid.uuid4().hex, pattern, load_ranks(path)))


def codec(shared: Broadcast):
    """The encoding object of a broadcast rank table, built once per Python worker."""
    import tiktoken

    key, pattern, ranks = shared.value
    if key not in _CODECS:
        _CODECS[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _CODECS[key]


def safe_pieces(text: str, piece_chars: int = PIECE_CHARS):
    """Yield (piece, whole): pieces of a text at safe boundaries; ``whole`` marks a piece that is one match by itself."""
    start = 0
    for run in _LONG.finditer(text):
        yield from ((p, False) for p in _cut(text, start, run.start(), piece_chars))
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : end], True
        start = end
    yield from ((p, False) for p in _cut(text, start, len(text), piece_chars))


def _cut(text: str, start: int, end: int, piece_chars: int):
    while end - start > piece_chars:
        at = _SAFE.search(text, start + piece_chars, end)
        if at is None:
            break
        yield text[start : at.start()]
        start = at.start()
    if start < end:
        yield text[start:end]


def encode_text(enc, text: str) -> np.ndarray:
    """Token ids of one text (whole, without special tokens)."""
    if len(text) <= LONG_RUN:
        return np.array(enc.encode_ordinary(text), "<u4")
    parts = [
        enc._encode_single_piece(piece) if whole else enc.encode_ordinary(piece) for piece, whole in safe_pieces(text)
    ]
    return np.concatenate([np.array(p, "<u4") for p in parts])


def encode(docs: DataFrame, ranks: Broadcast, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Add ``out``: the packed token ids of column ``text``."""

    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        enc = codec(ranks)
        return pa.array([encode_text(enc, t.as_py() or "").tobytes() for t in texts], pa.binary())

    return docs.withColumn(out, ids(F.col(text).cast("string")))


def decode(tokens: DataFrame, ranks: Broadcast, ids: str = "token_ids", out: str = "bytes") -> DataFrame:
    """Add ``out``: the raw bytes of packed ids. Null ids give empty bytes; an id outside the rank file is an error."""

    @F.arrow_udf("binary")
    def raw(packed: pa.Array) -> pa.Array:
        enc = codec(ranks)
        return pa.array([enc.decode_bytes(np.frombuffer(p.as_py() or b"", "<u4").tolist()) for p in packed], pa.binary())

    return tokens.withColumn(out, raw(F.col(ids)))


def n_tokens(ids: str = "token_ids") -> Column:
    return (F.octet_length(F.col(ids)) / 4).cast("long")


def unpack_ids(ids: str = "token_ids") -> Column:
    """Packed ids as an array column."""

    @F.arrow_udf("array<long>")
    def unpacked(packed: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(p.as_py() or b"", "<u4").astype(np.int64) for p in packed], pa.list_(pa.int64()))

    return unpacked(F.col(ids))
