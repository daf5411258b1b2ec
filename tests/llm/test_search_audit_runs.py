"""Nearest vectors, filter audit and periodic runs against brute force, with their defined edge results."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import shutil
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_ORACLE, SF_SMALL
from pyspark.sql import functions as F

from partnerkpi.llm import adaptive_scan, filter_audit, periodic_runs, queries
from partnerkpi.llm.common import read_table, scratch_dir
from partnerkpi.llm.wordscan import blocks

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

# ---------------------------------------------------------------- 11 nearest vectors


def brute_nearest(rows: list[tuple], query: int, vector, k: int) -> list[tuple]:
    q = np.array(vector, np.float64)
    near = sorted((float(np.sqrt(((np.array(v, np.float64) - q) ** 2).sum())), i) for i, v in rows if i != query)
    return near[:k]


def test_op11_recall_and_scores(spark):
    got: dict[int, list] = {}
    for r in queries.QUERIES["op11_adaptive_scan"](spark, SF_ORACLE).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    rows = [(r["vec_id"], r["embedding"]) for r in read_table(spark, SF_ORACLE, "embeddings").collect()]
    vectors = dict(rows)
    assert set(got) == {i for i in vectors if i % 100 == 0}
    hits = total = 0
    for q, found in got.items():
        found.sort()
        want = brute_nearest(rows, q, vectors[q], 10)
        assert [r for r, _, _ in found] == list(range(1, len(want) + 1))
        for _, v, score in found:
            assert math.isclose(score, math.dist(vectors[q], vectors[v]), rel_tol=1e-12)
        hits += len({v for _, v, _ in found} & {v for _, v in want})
        total += len(want)
    assert hits / total >= 0.9


def test_scan_abandons_no_true_neighbour_without_bound_slack():
    """With clustered vectors, a running scan equals brute force."""
    rng = np.random.default_rng(5)
    x = (rng.standard_normal((40, 48))[rng.integers(0, 40, 3000)] + 0.1 * rng.standard_normal((3000, 48))).astype(np.float64)
    blocks_of = lambda a: [a[:, j : j + 16].astype(np.float32) for j in range(0, 48, 16)]
    scan = adaptive_scan.Scan(x[:20], blocks_of(x[:20]), np.full(20, np.inf), 6)
    for c in range(0, 3000, 500):
        part = slice(c, c + 500)
        scan.add(x[part], blocks_of(x[part]), np.arange(3000)[part], np.arange(3000)[part])
    for q in range(20):
        want = np.lexsort((np.arange(3000), np.sqrt(((x - x[q]) ** 2).sum(1))))[:6]
        assert scan.c[scan.q == q].tolist() == want.tolist()


def test_search_edges(spark):
    """Unusable vectors, ties, equal vectors in masses, repeated rows, fewer rows than asked for, clashing columns."""
    rng = random.Random(3)
    hot = [1.0, 0.0, 0.0]
    rows = [(i, hot) for i in range(0, 60)] + [(i, [rng.random() for _ in range(3)]) for i in range(60, 70)]
    bad = [(100, None), (200, []), (300, [0.0, 0.0, 0.0]), (400, [1.0, None, 2.0]), (500, [float("nan"), 1.0, 1.0]), (600, [float("inf"), 0.0, 1.0]), (700, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 2.0, 3) for i, v in rows + rows[:5] + bad], "vec_id long, embedding array<float>, list int, dist double, h1 long")
    index = adaptive_scan.build(df, k=10)
    found = adaptive_scan.search(index, df.where("vec_id % 20 = 0 or vec_id >= 100")).collect()
    got: dict[int, list] = {}
    for r in found:
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    assert set(got) == {0, 20, 40, 60}
    single = {i: np.float32(v).astype(float).tolist() for i, v in rows}
    for q, near in got.items():
        want = brute_nearest(list(single.items()), q, single[q], 10)
        assert [(v, round(s, 9)) for _, v, s in sorted(near)] == [(v, round(s, 9)) for s, v in want]
    few = adaptive_scan.build(df.where("vec_id in (0, 61, 62)"), k=10)
    assert sorted((r["rank"], r["id"]) for r in adaptive_scan.search(few, df.where("vec_id = 0")).collect())[0][0] == 1
    assert adaptive_scan.search(few, df.where("vec_id = 0")).count() == 2
    assert adaptive_scan.build(df.where("vec_id >= 100 and vec_id < 700"), k=10) is None
    assert adaptive_scan.build(df.limit(0), k=10) is None


# ---------------------------------------------------------------- 12 filter audit


def brute_audit(docs: list[tuple], good: set, toxic: set) -> Counter:
    """{(part, order, step): (kept, removed, redundant, unique, good lost, toxic lost, shapley)} by applying every order."""
    least: dict[str, int] = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    failing = []
    for d, t, _ in docs:
        t, words = t or "", WORDS.findall(t or "")
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and least[t] < d,
        }
        failing.append({k for k, v in fails.items() if v})
    out = {}
    for part in {s or "" for _, _, s in docs}:
        mine = [k for k, (_, _, s) in enumerate(docs) if (s or "") == part]
        removed_by = Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in failing[k]]
                left = [k for k in left if f not in failing[k]]
                removed_by[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in failing[k] for k in mine) - len(gone), sum(failing[k] == {f} for k in mine),
                    sum(docs[k][0] in good for k in gone), sum(docs[k][0] in toxic for k in gone), f,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[6] = removed_by[row[6]]
    return {k: tuple(v) for k, v in out.items()}


AUDIT_COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audited(df) -> dict:
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in AUDIT_COLUMNS) for r in df.collect()}


def audit_rows(seed: int = 2) -> list[tuple]:
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["one", "Two", "three", "four#", "UP"]) for _ in range(n)) for n in (3, 3, 250, 260, 10)]
    texts += [" ".join(f"w{rng.randrange(900)}" for _ in range(300)) for _ in range(3)] + ["", None, "plain words only"]
    ids = list(range(400))
    rng.shuffle(ids)
    rows = [(i, rng.choice(texts), rng.choice(["s", "t", None, ""])) for i in ids]
    return rows + rows[:3] + [(None, texts[5], "s"), (None, texts[5], "t"), (rows[0][0], rows[0][1], "other")]


@pytest.mark.parametrize("files_per_batch", [1, 3])
def test_audit_retracts_across_batches(spark, files_per_batch):
    """Ids come in random order over seven files, so later batches displace holders of earlier ones; nulls and ties too."""
    rows = audit_rows()
    folder = scratch_dir(spark)
    schema = "doc_id long, text string, source string, mask int, n long, key int"
    for k in range(7):
        spark.createDataFrame([(*r, 1, 2, 3) for r in rows[k::7]], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 5 == 0)) for i in range(400)] + [(7, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = audited(filter_audit.audit(spark, f"{folder}/in", labels, f"{folder}/state", batch_files=files_per_batch))
    good = {i for i in range(400) if i % 3 == 0} | {7}
    toxic = {i for i in range(400) if i % 5 == 0} | {7}
    assert got == brute_audit(rows, good, toxic)
    if files_per_batch == 1:  # called again: only what came since is read, and smaller ids retract once more
        more = [(-1, rows[4][1], "s"), (-2, "", "t")]
        spark.createDataFrame([(*r, 1, 2, 3) for r in more], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        again = audited(filter_audit.audit(spark, f"{folder}/in", labels, f"{folder}/state", batch_files=1))
        assert again == brute_audit(rows + more, good, toxic)


def test_audit_counts_a_repeated_batch_once(spark):
    """A batch whose result was written but not yet logged is run again after a restart; the counters stay."""
    folder = scratch_dir(spark)
    docs = read_table(spark, SF_SMALL, "documents")
    docs.repartition(3, "doc_id").write.parquet(f"{folder}/in")
    labels = read_table(spark, SF_SMALL, "labels")
    want = audited(filter_audit.audit(spark, f"{folder}/in", labels, f"{folder}/state", batch_files=1))
    local = folder.removeprefix("file:")
    last = max(int(p.name) for p in __import__("pathlib").Path(f"{local}/state/stream/commits").iterdir() if p.name.isdigit())
    moved = scratch_dir(spark).removeprefix("file:")
    shutil.copytree(f"{local}/state", moved, ignore=lambda d, names: [n for n in names if d.endswith("commits") and n.strip(".").split(".")[0] == str(last)])
    assert audited(filter_audit.audit(spark, f"{folder}/in", labels, moved, batch_files=1)) == want


def test_audit_of_nothing(spark):
    folder = scratch_dir(spark)
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{folder}/in")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark, f"{folder}/in", labels).count() == 0


# ---------------------------------------------------------------- 13 periodic runs


def brute_runs(w: list[str], least: int = 24, repeats: int = 3) -> list[tuple[int, int, int]]:
    out = []
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, repeats * q):
                part = w[i : i + size]
                if all(any(part[k] != part[k + p] for k in range(size - p)) for p in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng: random.Random) -> list[str]:
    w = [rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGH"[: rng.choice([1, 2, 3, 30])]) * rng.choice([1, 1, 2]) for _ in range(rng.randrange(160))]
    if w and rng.random() < 0.7:
        a, p = rng.randrange(len(w)), rng.randrange(1, 12)
        for i in range(a + p, len(w)):
            w[i] = w[i - p]
    return w


@pytest.mark.parametrize(("least", "repeats"), [(24, 3), (6, 2), (7, 3), (20, 5)])
def test_runs_and_collapsed_texts_equal_brute_force(least, repeats):
    rng = random.Random(least)
    for _ in range(40):
        docs = [random_words(rng) for _ in range(6)]
        texts = pa.array([rng.choice([" ", " \n\t"]).join(d) for d in docs])
        for b in blocks(texts):
            words = b.words()
            runs, first = periodic_runs.block_runs(b, words, least, repeats), words[2]
            data, size = periodic_runs._collapsed(b, words, runs)
            ends = np.concatenate([[0], np.cumsum(size)])
            for r, d in enumerate(docs):
                want = brute_runs(d, least, repeats)
                assert [(int(s - first[r]), int(n), int(q)) for s, n, q in runs if first[r] <= s < first[r + 1]] == want
                gone = {i for s, n, q in want for i in range(s + q, s + n)}
                assert data[ends[r] : ends[r + 1]].tobytes().decode() == " ".join(x for i, x in enumerate(d) if i not in gone)


def test_words_of_one_hash_are_told_apart():
    data = np.frombuffer(b"aa bb aa", np.uint8)
    starts, ends = np.array([0, 3, 6]), np.array([2, 5, 8])
    symbol, size = periodic_runs._symbols(data, starts, ends, np.zeros(3, np.uint64))
    assert size == 2 and symbol[0] == symbol[2] != symbol[1]


def test_long_periodic_texts_are_one_run():
    rng = random.Random(1)
    unit = [f"u{rng.randrange(10**6)}" for _ in range(40)]
    for w, q in ((["x"] * 100_000, 1), (unit * 2_500, 40)):
        b = next(blocks(pa.array([" ".join(w)]), 1 << 40))
        assert periodic_runs.block_runs(b, b.words(), 24, 3).tolist() == [[0, len(w), q]]


def expected_op13(doc_id: int, text: str | None) -> tuple:
    w = WORDS.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{size},{q}\n" for s, size, q in runs)), digest(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def test_op13_equals_brute_force(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op13_periodic_runs"](spark, SF_SMALL).collect()}
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, SF_SMALL, "documents").collect()}
    assert set(got) == set(texts)
    short = {d: t for d, t in texts.items() if len(t or "") < 12_000}
    assert len(short) > 150
    assert {d: got[d] for d in short} == {d: expected_op13(d, t) for d, t in short.items()}


def test_runs_of_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 23), (5, "a " * 24), (5, "a " * 24), (None, "b c " * 30), (7, "é" * 9000)]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, runs int, n_words int")
    got = periodic_runs.with_runs(df).select("doc_id", "periodic.*").collect()
    assert sorted(str((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"][:20])) for r in got) == sorted(
        str(x) for x in [
            (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 23, [], "a a a a a a a a a a "), (5, 24, [(0, 24, 1)], "a"),
            (5, 24, [(0, 24, 1)], "a"), (None, 60, [(0, 60, 2)], "b c"), (7, 1, [], "é" * 20),
        ]
    )
    assert periodic_runs.with_runs(df.limit(0)).count() == 0
    assert queries.planted_tails(df).count() == len(rows)
    assert queries.planted_tails(df).where(F.col("text").isNull()).count() == 0


# ---------------------------------------------------------------- 6 memory of the line labels


def test_quality_memory_follows_the_lines():
    """100,000 lines beside 2,000 short texts: the forward-backward pass keeps what the lines need, not lines times texts."""
    import tracemalloc

    from partnerkpi.llm import quality_crf

    rng = np.random.default_rng(0)
    model = quality_crf.Crf(rng.normal(size=quality_crf.WIDTH), rng.normal(size=(2, 2)), 0.5, 2.0, -1.0)
    short = [f"Line one of {k}.\nAnd two\n\nthree" for k in range(2000)]
    texts = pa.array(["\n" * 100_000, *short])
    tracemalloc.start()
    together = quality_crf.quality_scores(texts, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
    assert np.allclose(together[1:], quality_crf.quality_scores(pa.array(short), model))
    assert together[0] == 0.5  # no text


def test_line_scores_equal_the_wide_features():
    from partnerkpi.llm import quality_crf

    emit = np.random.default_rng(1).normal(size=quality_crf.WIDTH)
    for b in blocks(pa.array(["", "a", "a\nb c\n\n42 # x", None, "x\n" * 7])):
        x, weight, first = quality_crf.line_features(b)
        scores, w, f = quality_crf.line_scores(b, emit)
        assert np.allclose(x @ emit, scores, atol=1e-5) and (w == weight).all() and (f == first).all()
