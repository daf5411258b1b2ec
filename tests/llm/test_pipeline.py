"""The pipeline against a plain version of its stages, and its behaviour on edge rows."""

from __future__ import annotations

import brute
import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from conftest import SF_SMALL

import corpus_pipeline
from partnerkpi.llm import bpe, quality_crf, queries
from partnerkpi.llm.common import read_table

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_run_equals_the_stages_done_plainly(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = sorted(rows)
    model = quality_crf.fit(docs, queries.training_labels(spark, SF_SMALL))
    score = quality_crf.quality_scores(pa.array([rows[d] for d in ids]), model)
    rows = {d: rows[d] for d, s in zip(ids, score, strict=True) if s >= corpus_pipeline.MIN_QUALITY}
    ids = sorted(rows)
    group = brute.components([brute.simhash(rows[d]) for d in ids], ids)
    rows = {d: rows[d] for d, g in zip(ids, group, strict=True) if d == g}
    rows = brute.cut(rows)
    items = {r["item_id"]: r["text"] for r in read_table(spark, SF_SMALL, "benchmark").collect()}
    rows = {d: t for d, t in rows.items() if not brute.hits(t, items)[0]}
    table = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(got) == set(rows)
    for d, t in rows.items():
        assert got[d]["text"] == t
        assert np.frombuffer(got[d]["token_ids"], "<u4").tolist() == enc.encode_ordinary(t)
        assert got[d]["n_tokens"] == len(enc.encode_ordinary(t)) and got[d]["n_chars"] == len(t)


def test_stages_keep_the_documents_columns_and_stand_edge_rows(spark):
    schema = read_table(spark, SF_SMALL, "documents").schema
    long = " ".join(f"w{i % 700}" for i in range(3000))
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, long, "en", "s", len(long)), (2, long, "en", "s", len(long)), (3, long, "de", "s", len(long))]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF_SMALL)
            if i + 1 < len(corpus_pipeline.STAGES):
                assert out.columns == docs.columns, name
            assert out.count() <= len(data), name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "passage_dedup", "decontaminate", "encode"]
