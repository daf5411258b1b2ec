"""The pipeline operators against brute force, held-out accuracy and exact round trips, and their defined edge results."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from conftest import SF_ORACLE, SF_SMALL
from pyspark.sql import functions as F

from partnerkpi.llm import (
    bpe,
    decontam,
    language_id,
    lm_mixing,
    quality_crf,
    quality_rules,
    queries,
    simhash,
    suffix_dedup,
    token_rollup,
    toxicity,
)
from partnerkpi.llm.common import read_table, scratch_dir

public_tokenizers = pytest.importorskip("public_tokenizers")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, h long, label long, at int"
_RNG = random.Random(7)
LONG = " ".join(_RNG.choice(["alpha", "Beta", "gämma", "d", "42"]) + str(_RNG.randrange(900)) for _ in range(6000))
EDGE = [
    (1, None, None, None), (2, "", "en", "s"), (3, "  \n\t ", "en", "s"), (4, "one two", "en", None),
    (5, LONG, "de", "s"), (6, LONG, "de", "t"), (6, LONG, "de", "t"), (None, "no id here", None, "s"), (7, "é" * 9000, "fr", "s"),
    (8, "word " * 300, "en", "s"), (None, None, None, None),
]


@pytest.fixture(scope="module")
def edge(spark):
    """Null, empty, blank, long, repeated and id-less rows, and columns whose names clash with the operators' own."""
    rows = [(d, t, la, so, len(t or ""), 0.5, 1, 2, 3) for d, t, la, so in EDGE]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return read_table(spark, SF_SMALL, "documents")


def texts(df) -> dict:
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


# ---------------------------------------------------------------- 1 SimHash


def test_simhash_components_equal_brute_force(small):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(small).select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id").collect()}
    t = texts(small)
    ids = sorted(t)
    prints = [brute.simhash(t[d]) for d in ids]
    want = dict(zip(ids, zip([f"{p:016x}" for p in prints], brute.components(prints, ids), strict=True), strict=True))
    assert got == want


@pytest.mark.parametrize("block_rows", [8, 8192])
def test_links_lose_no_pair_even_in_hot_anchors(spark, block_rows):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = set(base)
    for b in base[:6]:
        for _ in range(40):
            x = b
            for bit in rng.sample(range(64), rng.randrange(1, 9)):
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([((f - (1 << 64)) if f >> 63 else f,) for f in fps], "fp long")
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(df, 4, block_rows).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in edges)
    want = brute.components(fps, fps)
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert [find(f) for f in fps] == want


def test_simhash_edges(edge, empty):
    rows = simhash.near_duplicates(edge).collect()
    assert len(rows) == len(EDGE)
    zero = {r["component_id"] for r in rows if r["fp"] == 0}
    assert zero == {1}  # null, empty and blank texts link, an unknown id among them
    assert {r["component_id"] for r in rows if r["doc_id"] in (5, 6)} == {5}
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 4, 5, 7, 8]
    assert simhash.keep_one(empty).count() == 0


# ---------------------------------------------------------------- 2 language


def test_language_agrees_with_the_declaration_and_uses_other_evidence(spark):
    model = language_id.fit(read_table(spark, SF_ORACLE, "documents"))
    got = language_id.identify(read_table(spark, SF_ORACLE, "pages"), model).collect()
    assert np.mean([r["declared"] == r["language"] for r in got]) > 0.98
    german = " ".join(["der die einheit und erst den achlich"] * 5)
    pages = [(i, "http://www.a.example.de/x", f"<html lang=de><body>{german}</body>") for i in range(30)]
    pages += [(90, "http://www.a.example.de/y", "<html lang='de'><script>the of and</script></html>"), (91, None, None), (91, None, None)]
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, host string")
    out = {r["page_id"]: r for r in language_id.identify(frame, model).collect()}
    assert out[90]["language"] == "de" and out[90]["host"] == "www.a.example.de" and out[90]["suffix"] == "de"
    assert out[91]["host"] == "" and 0 < out[91]["confidence"] <= 1
    assert abs(sum(out[91]["posterior"]) - 1) < 1e-9
    assert language_id.identify(frame.limit(0), model).count() == 0
    assert language_id.identify(frame, ([], np.zeros((0, 1 << language_id.TRIGRAM_BITS)))).first()["language"] is None


def test_language_posteriors_equal_a_plain_computation(spark):
    """Text likelihoods as given; tables, smoothing, priors and the fusion worked out by loops over the pages."""
    import re

    model = language_id.fit(read_table(spark, SF_ORACLE, "documents"))
    names = model[0]
    pages = read_table(spark, SF_SMALL, "pages").select("page_id", "url", "html")
    odd = [(9001, None, None), (9002, "not an address", "<html lang=fr>"), (9003, "http://localhost/x", "<p>the of and</p>"), (9001, None, None)]
    pages = pages.unionByName(spark.createDataFrame(odd, pages.schema)).coalesce(2).cache()
    logs = language_id.text_log_likelihoods(model, language_id.visible_text(F.col("html")))
    rows = []
    for r in pages.select("*", logs.alias("logs")).collect():
        host = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", r["url"] or "")
        host = host.group(1).lower() if host else ""
        declared = re.search(r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]+)", r["html"] or "")
        domain = re.search(r"([^.]+\.[^.]+)$", host)
        x = np.array(r["logs"])
        p = np.exp(x - x.max())
        rows.append((r["page_id"], host, declared.group(1).lower() if declared else "", host.rsplit(".", 1)[-1], domain.group(1) if domain else "", x, p / p.sum()))
    def table(place):
        sums = {}
        for r in rows:
            sums[r[place]] = sums.get(r[place], 0) + r[6]
        return sums
    everything = sum(r[6] for r in rows)
    share = (everything + 1) / (everything.sum() + len(names))
    declared, suffix = table(2), table(3)
    domain = {k: (v + language_id.DOMAIN_STRENGTH * share) / (v.sum() + language_id.DOMAIN_STRENGTH) for k, v in table(4).items()}
    hosts = table(1)
    want = []
    for page, host, d, s, dom, x, _ in rows:
        prior = (hosts[host] + language_id.HOST_STRENGTH * domain[dom]) / (hosts[host].sum() + language_id.HOST_STRENGTH)
        z = x + np.log(prior) + np.log((declared[d] + 1) / (everything + len(declared))) + np.log((suffix[s] + 1) / (everything + len(suffix)))
        z = np.exp(z - z.max())
        want.append((page, host, d, s, *(z / z.sum())))
    got = [(r["page_id"], r["host"], r["declared"], r["suffix"], *r["posterior"]) for r in language_id.identify(pages, model).collect()]
    assert len(got) == len(want)
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:4] == b[:4] and np.allclose(a[4:], b[4:], atol=1e-9)


def test_the_language_sample_is_the_least_distinct_texts_of_each_language(spark, edge, empty):
    rows = [(la, f"text {i} of {la}") for la, n in (("en", 4000), ("de", 30)) for i in range(n)]
    rows += [("en", "a copy")] * 3000 + [(None, "nameless"), ("fr", ""), ("fr", None), ("es", "x" * (language_id.SAMPLE_CHARS + 1))]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = {(r["lang"], r["text"]) for r in language_id.sampled(docs, per_lang=50).collect()}
    hashed = docs.where("lang in ('en', 'de')").distinct().select("lang", "text", F.shiftrightunsigned(F.xxhash64("text"), 1).alias("h")).collect()
    for la in ("en", "de"):
        least = sorted((r["h"], r["text"]) for r in hashed if r["lang"] == la)[:50]
        assert {t for x, t in got if x == la} == {t for _, t in least}
    assert {la for la, _ in got} == {"en", "de"}
    assert language_id.sampled(edge).count() == 4 and language_id.sampled(empty).count() == 0


# ---------------------------------------------------------------- 3 BPE


@pytest.fixture(scope="module")
def ranks(spark):
    return bpe.broadcast_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def enc():
    table = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def test_ids_are_those_of_the_library_and_round_trip(spark, small, ranks, enc):
    coded = bpe.decode(bpe.encode(small, ranks), ranks).select("text", bpe.unpack_ids().alias("ids"), "bytes", bpe.n_tokens().alias("n"))
    for r in coded.collect():
        assert r["ids"] == enc.encode_ordinary(r["text"]) and bytes(r["bytes"]) == r["text"].encode() and r["n"] == len(r["ids"])


def test_safe_cuts_change_no_id(enc):
    rng = random.Random(3)
    alphabet = ["a", "Z", "é", " ", "  ", "\n", "\t", "'s", "'", "7", "?!", " ", " ", "\x1c", "漢", " \n "]
    for _ in range(300):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 300)))
        parts = list(bpe.safe_pieces(t, 16))
        assert "".join(p for p, _ in parts) == t
        got = [i for p, whole in parts for i in (enc._encode_single_piece(p) if whole else enc.encode_ordinary(p))]
        assert got == enc.encode_ordinary(t)
    for t in ("x" + " " * 3000 + "y z", "\n" * 2000, "a" + "\t" * 1500 + " b", " " * 700 + "k"):
        assert bpe.encode_text(enc, t).tolist() == enc.encode_ordinary(t)
    assert enc.decode_bytes(bpe.encode_text(enc, " " * 2_000_000 + "end").tolist()) == b" " * 2_000_000 + b"end"


def test_bpe_edges_and_raw_bytes(spark, edge, empty, ranks, enc):
    rows = bpe.decode(bpe.encode(edge, ranks), ranks).collect()
    assert [(bytes(r["bytes"]).decode(), r["score"]) for r in rows] == [(r["text"] or "", 0.5) for r in rows]
    assert bpe.encode(empty, ranks).count() == 0
    part = np.array(enc.encode_ordinary("漢")[:1], "<u4").tobytes()  # ends inside a character
    one = spark.createDataFrame([(part,), (None,)], "token_ids binary")
    assert [bytes(r["bytes"]) for r in bpe.decode(one, ranks).collect()] == [enc.decode_bytes(enc.encode_ordinary("漢")[:1]), b""]


def test_op3_digests(spark):
    table = {r["doc_id"]: r for r in queries.QUERIES["op3_byte_bpe"](spark, SF_SMALL).collect()}
    for d, t in texts(read_table(spark, SF_SMALL, "documents")).items():
        assert table[d]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


# ---------------------------------------------------------------- 4 quality rules


def test_base_statistics_equal_brute_force(small, edge):
    import re

    for df in (small, edge):
        for r in df.select("text", quality_rules.statistics_column().alias("s")).collect():
            t = r["text"] or ""
            w = re.findall(r"[^\x20\x09-\x0D]+", t)
            grams = Counter(zip(w, w[1:], w[2:], strict=False))
            inside = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
            lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside))
            assert tuple(r["s"][:5]) == want


def test_outliers_go_and_clean_documents_stay(spark, edge, empty):
    labels = read_table(spark, SF_ORACLE, "labels")
    got = quality_rules.judged(read_table(spark, SF_ORACLE, "documents")).join(labels, "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in got if r["quality"] == 1]
    bad = [r["kept"] for r in got if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.25
    rows = quality_rules.judged(edge).collect()
    assert len(rows) == len(EDGE) and not any(r["kept"] for r in rows if r["n_words"] < 50)
    assert quality_rules.judged(empty).count() == 0


@pytest.mark.parametrize("pools", [20_000, 0])
def test_a_source_with_two_fifths_junk_keeps_its_clean_centre(spark, monkeypatch, pools):
    """With and without broadcast estimates; junk of three kinds, nearly none of which the base rule rejects."""
    monkeypatch.setattr(quality_rules, "BROADCAST_POOLS", pools)
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(3000)]

    def lines(n):
        return [" ".join(rng.choices(vocabulary, k=rng.randint(6, 14))).capitalize() + "." for _ in range(n)]

    def junk(kind):
        some = lines(rng.randint(8, 20))
        if kind == 0:  # symbols between the words
            return "\n".join(x.replace(" ", " | ") for x in some)
        if kind == 1:  # shouting
            return "\n".join(x.upper() for x in some)
        return "\n".join(some + [some[0]] * (len(some) * 4 // 5))  # a line again and again

    rows = [(i, "\n".join(lines(rng.randint(8, 20))) if i % 5 < 3 else junk(i % 3), "en", "hot") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    got = quality_rules.judged(docs).collect()
    assert len(got) == len(rows) and np.mean([r["base_failed"] for r in got]) < 0.1
    got = [r for r in got if not r["base_failed"]]
    clean = [r["kept"] for r in got if r["doc_id"] % 5 < 3]
    for kind in range(3):
        dropped = [not r["kept"] for r in got if r["doc_id"] % 5 >= 3 and r["doc_id"] % 3 == kind]
        assert np.mean(dropped) > 0.95, kind
    assert np.mean(clean) > 0.98


def test_pools_fall_back_to_language_and_rest(spark):
    rows = [("en", "a")] * 6 + [("en", "b")] * 2 + [("en", "c")] * 3 + [("de", "a")] * 2 + [(None, None)]
    got = Counter(r["pool"] for r in quality_rules.pooled(spark.createDataFrame(rows, "lang string, source string"), 5).collect())
    assert got == {'{"lang":"en","source":"a"}': 6, '{"lang":"en"}': 5, "rest": 3}


# ---------------------------------------------------------------- 5 decontamination


def test_contamination_equals_brute_force_and_removal_takes_effect(spark, edge, empty):
    bench = [(1, "One two"), (2, " ".join(LONG.split()[100:130])), (3, None), (4, "?!"), (5, "no id here really"), (2, "one TWO")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    merged = {1: "One two", 2: None, 3: None, 4: "?!", 5: "no id here really"}
    got = decontam.contamination(edge, items, max_windows=4).collect()  # several sets of windows
    assert len(got) == len(EDGE)
    by = {(r["doc_id"], r["n_words"]): r for r in got}
    for d, t, *_ in EDGE:
        pos, found = brute.hits(t, merged)
        for t2 in (bench[1][1], bench[5][1]):
            p2, f2 = brute.hits(t, {2: t2})
            pos, found = pos | p2, found | f2
        r = by[(d, len(brute.item_words(t)))]
        covered = {i for h in r["hits"] for i in range(h["at"] - 1, h["at"] - 1 + h["size"])}
        assert covered == pos and r["items"] == sorted(map(str, found))
    kept = decontam.remove_documents(edge, items)
    assert kept.columns == edge.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 7, 8, None}
    spans = {r["doc_id"]: r["clean_words"] for r in decontam.remove_spans(edge, items).collect()}
    assert spans[4] == "" and len(spans[5].split()) == 6000 - 30 and spans[7] is None
    assert decontam.contamination(empty, items).count() == 0
    clean = decontam.contamination(edge, items.limit(0)).collect()
    assert len(clean) == len(EDGE) and not any(r["hits"] for r in clean)


# ---------------------------------------------------------------- 6 quality classifier


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    first = np.array([0, 3, 3, 4, 8])
    s, trans = rng.normal(size=8), rng.normal(size=(2, 2))
    good, pairs, log_z = quality_crf.marginals(s, trans, first)
    want, total, want_pairs = np.zeros(8), 0.0, np.zeros((2, 2))
    for a, b in itertools.pairwise(first):
        z, g, p = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            e = math.exp(sum(s[a + i] * v for i, v in enumerate(y)) + sum(trans[u, v] for u, v in itertools.pairwise(y)))
            z += e
            g += e * np.array(y)
            for u, v in itertools.pairwise(y):
                p[u, v] += e
        want[a:b], total, want_pairs = g / z, total + math.log(z), want_pairs + p / z
    assert np.allclose(good, want) and np.allclose(pairs, want_pairs) and abs(log_z - total) < 1e-9


def test_quality_on_held_out_rows_and_edges(spark, edge, empty):
    got = queries.QUERIES["op6_quality_crf"](spark, SF_ORACLE).join(read_table(spark, SF_ORACLE, "labels"), "doc_id").where("held_out").collect()
    hit = np.mean([r["predicted"] == r["quality"] for r in got])
    assert hit > 0.9
    docs, labels = read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "labels")
    model = quality_crf.fit(docs, labels.unionByName(spark.createDataFrame([(1, None, None), (None, 1, 0)], labels.schema)))
    rows = edge.select("text", quality_crf.score_column(model).alias("q")).collect()
    assert all(0 <= r["q"] <= 1 for r in rows)
    assert {r["q"] for r in rows if not (r["text"] or "").strip()} == {model.blank}
    none = quality_crf.fit(docs, labels.limit(0))
    assert edge.select(quality_crf.score_column(none).alias("q")).distinct().collect() == [(0.5,)]
    assert empty.select(quality_crf.score_column(model)).count() == 0


# ---------------------------------------------------------------- 7 language model


@pytest.mark.parametrize("head", [20, 500_000])
def test_base_scores_equal_brute_force_and_the_model_is_a_distribution(spark, small, edge, head):
    docs = small.select("doc_id", "text").unionByName(edge.select("doc_id", "text"))
    rows = [(r["doc_id"], brute.words(r["text"])) for r in docs.collect()]
    trains = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2
    count: Counter = Counter()
    for d, w in rows:
        if trains(d):
            count.update([*w, b"\0end"])
    n, v = sum(count.values()), len(count)
    want = Counter(
        (d, len(w) + 1, sum(count[t] > 0 for t in [*w, b"\0end"]), n, round(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in [*w, b"\0end"]), 5), not trains(d))
        for d, w in rows
    )
    got = lm_mixing.score(docs, head_words=head).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5), r["held_out"]) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    held = [r for r in got if r["held_out"] and r["n_tokens"] > 20]
    assert np.mean([r["bits_per_byte"] for r in held]) < 4


def test_a_texts_score_does_not_depend_on_its_neighbours_and_bytes_sum_to_one():
    sample = [LONG[:3000], "the cat sat on the mat " * 40]
    code = lm_mixing.byte_code(sample)
    rows = sorted(lm_mixing._count_decisions(code)(iter([pa.RecordBatch.from_arrays([pa.array(sample)], names=["text"])])), key=lambda r: (r["kind"][0].as_py(), r["piece"][0].as_py()))
    tables = [np.full(1 << b, lm_mixing._UNSEEN, np.int8) for b in lm_mixing.TABLE_BITS]
    for r in lm_mixing._sum_pieces(iter(rows)):
        at = r["piece"][0].as_py() * lm_mixing.PIECE
        tables[r["kind"][0].as_py()][at : at + lm_mixing.PIECE] = np.frombuffer(r["blob"][0].as_py(), np.int8)
    model = lm_mixing.mixer(code, tables, sample)

    def scores(*ts):
        (block,) = lm_mixing.blocks(pa.array(ts), 1 << 30)
        return lm_mixing.log10_probabilities(lm_mixing.stream(block), model)

    alone = scores("the cat and the dog sat")[0]
    assert np.allclose(scores(LONG, "the cat and the dog sat", None, "x")[1], alone, atol=1e-4)
    # a text of one letter after "ca": its letter's share, over all bytes that can follow, sums to one
    first, size, node, bit = code
    paths = {tuple(zip(node[first[b] : first[b] + size[b]], bit[first[b] : first[b] + size[b]], strict=True)) for b in range(256)}
    assert len(paths) == 256 and abs(sum(2.0 ** -len(p) for p in paths) - 1) < 1e-12
    assert scores("")[0] < 0


def test_weights_move_through_the_whole_text():
    rng = np.random.default_rng(3)
    code = lm_mixing.byte_code([LONG[:3000]])
    tables = [rng.integers(-20, 21, 1 << b).astype(np.int8) for b in lm_mixing.TABLE_BITS]
    model = lm_mixing.Mixer(code, tables, np.full((4, 3), 0.4))
    ts = [LONG[:2500], "short", "again and " * 300]
    (block,) = lm_mixing.blocks(pa.array(ts), 1 << 30)
    s = lm_mixing.stream(block)
    got = lm_mixing.log10_probabilities(s, model, rate=0.05)
    n, entry = lm_mixing._entries(s.data, code)
    f, gate = lm_mixing.predictions(s, np.arange(len(s.data)), n, lm_mixing._node_hashes(code[2])[entry], tables)
    f, y, at = np.stack(f, axis=1).astype(float), code[3][entry], np.concatenate([[0], np.cumsum(n)])
    for t in range(len(ts)):  # one text after another, no restart
        moved, want = np.zeros(3), 0.0
        for b in range(s.offsets[t], s.offsets[t + 1], lm_mixing.STRIDE):
            e = slice(at[b], at[min(b + lm_mixing.STRIDE, s.offsets[t + 1])])
            x = ((model.weights[gate[e]] + moved) * f[e]).sum(axis=1)
            p = 1 / (1 + np.exp(-np.clip(x, -12, 12)))
            want += np.log10(np.where(y[e] == 1, p, 1 - p)).sum()
            moved = moved + 0.05 * (f[e] * (y[e] - p)[:, None]).sum(axis=0)
        assert abs(got[t] / want - 1) < 1e-3


def test_code_tables_and_weights_come_from_every_training_text(spark):
    rng = np.random.default_rng(11)
    vocabulary = ["Tea", "teapot", "a", "of", "über", "x9", "longer-word", "tea\ttime"]
    rows = [(i, " ".join(rng.choice(vocabulary, 40))) for i in range(150)] + [(500, "rare " * 6), (501, "rare " * 6), (502, None), (None, "z" * 25_000)]
    learned = [t for d, t in rows if zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2]
    model, _, _, _ = lm_mixing.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 7, 2)
    code = lm_mixing.byte_code([t or "" for t in learned])
    assert all(np.array_equal(a, b) for a, b in zip(model.code, code, strict=True))
    # every decision of every training text, one after another: counts of both bits, then the prediction without that one
    (block,) = lm_mixing.blocks(pa.array(learned, pa.string()), 1 << 30)
    s = lm_mixing.stream(block)
    n, entry = lm_mixing._entries(s.data, code)
    node, y = lm_mixing._node_hashes(code[2])[entry], code[3][entry]
    x = []
    for table, context, bits in zip(model.tables, lm_mixing.contexts(s.keys), lm_mixing.TABLE_BITS, strict=True):
        slot = np.repeat(context, n) ^ node
        counts = np.zeros((1 << bits, 2), np.int64)
        np.add.at(counts, (slot, y), 1)
        assert np.array_equal(table, lm_mixing._stretch(counts[:, 0], counts[:, 1]))
        less = counts[slot]
        less[np.arange(len(y)), y] -= 1
        x.append(lm_mixing._stretch(less[:, 0], less[:, 1]))
    gate = (x[1] != lm_mixing._UNSEEN) + 2 * (x[2] != lm_mixing._UNSEEN)
    x = [np.where(v == lm_mixing._UNSEEN, 0, np.rint(v / 5) * 5) / 8 for v in x]
    assert np.allclose(model.weights, lm_mixing.fit_weights(x, gate, y), atol=1e-6)


def test_streams_do_not_depend_on_the_scanned_parts():
    texts = ["", " ", None, "  Two\t\nwords ", "x", "\n", LONG * 4, "ABC" * 20_000, "é b" * 30_000, ""]
    want = []
    for t in texts:  # word by word
        out, keys, four, word = bytearray(), [], b"\n" * 4, b""
        for b in b"".join(w + b" " for w in brute_stream_words(t)) + b"\n":
            keys.append((four[::-1], word, b))
            four, word = four[1:] + bytes([b]), (b"" if b == 32 else (word + bytes([b]))[:40])
            out.append(b)
        want.append((bytes(out), keys))
    (block,) = lm_mixing.blocks(pa.array(texts, pa.string()), 1 << 30)
    s = lm_mixing.stream(block)
    prefixes = {}
    for t, (out, keys) in enumerate(want):
        at = slice(s.offsets[t], s.offsets[t + 1])
        assert s.data[at].tobytes() == out
        assert (s.keys[at].astype(np.uint8) == s.data[at]).all()
        assert (s.keys[at] >> np.uint64(8)).astype(">u4").tobytes() == b"".join(k[0] for k in keys)
        for k, h in zip(keys, (s.keys[at] >> np.uint64(40)).tolist(), strict=True):
            if len(k[1]) < 40:
                assert prefixes.setdefault(k[1], h) == h
        assert s.first[t + 1] - s.first[t] == len(brute_stream_words(texts[t]))
    assert len(set(prefixes.values())) > 0.99 * len(prefixes)


def test_predictions_are_looked_up_and_frequent_words_found_a_few_at_a_time(monkeypatch):
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 63, 5000)
    words[:600] = words[0] + np.arange(600)  # many of the same leading bits
    keys = np.sort(words[::2])
    head = lm_mixing.Head(keys)
    place, hit = head.places(words)
    assert np.array_equal(place, np.searchsorted(keys, words)) and np.array_equal(hit, np.isin(words, keys))
    assert not lm_mixing.Head(keys[:0]).places(np.append(words, np.iinfo(np.int64).max))[1].any()
    assert np.array_equal(lm_mixing._translated(words.view(np.uint8), lm_mixing.FOLD), lm_mixing.FOLD[words.view(np.uint8)])
    # no more than LOOKUP bytes' predictions are held at once, and the scores are those of looking up all at once
    code = lm_mixing.byte_code([LONG[:3000]])
    tables = [rng.integers(-20, 21, 1 << b).astype(np.int8) for b in lm_mixing.TABLE_BITS]
    model = lm_mixing.Mixer(code, tables, rng.random((4, 3)))
    (block,) = lm_mixing.blocks(pa.array([LONG[:2500], "short", None, "again and " * 300, *["x y"] * 50]), 1 << 30)
    s, held, mix = lm_mixing.stream(block), [], lm_mixing._mixed
    monkeypatch.setattr(lm_mixing, "_mixed", lambda s, pos, model: held.append(len(pos)) or mix(s, pos, model))
    scores = []
    for at_once in (1 << 20, 500, 64, 1):
        monkeypatch.setattr(lm_mixing, "LOOKUP", at_once)
        held.clear()
        scores.append(lm_mixing.log10_probabilities(s, model))
        assert sum(held) == len(s.data) and max(held) <= max(at_once, lm_mixing.STRIDE * block.rows)
    assert all(np.array_equal(scores[0], x) for x in scores[1:])
    # tallies hold every byte once, however they are cut
    batch = pa.RecordBatch.from_arrays([pa.array([LONG, "", None, "x " * 400, "Tea"])], names=["text"])
    (block,) = lm_mixing.blocks(batch.column("text"), 1 << 30)
    want = Counter(lm_mixing.stream(block).keys.tolist())
    for tally in (1 << 20, 900, 7):
        monkeypatch.setattr(lm_mixing, "TALLY", tally)
        got = Counter()
        for keys, times in lm_mixing._tallied(iter([batch, batch.slice(3)])):
            got.update(dict(zip(keys.tolist(), times.tolist(), strict=True)))
        assert got - want == Counter(lm_mixing.stream(next(lm_mixing.blocks(batch.slice(3).column("text"), 1 << 30))).keys.tolist())


def brute_stream_words(text):
    return [w.translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))) for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode()) if w]


def test_lm_empty_table(spark, empty):
    assert lm_mixing.score(empty).count() == 0


# ---------------------------------------------------------------- 8 token counts


def rollup_rows(df):
    return {(r["source"], r["lang"], r["version"]): (r["n_docs"], r["n_tokens"]) for r in df.collect()}


def test_rollup_is_idempotent_and_additive(spark, edge, empty):
    path = scratch_dir(spark)
    store = token_rollup.TokenRollup(spark, path)
    assert store.totals().count() == 0
    batches = {
        "a": token_rollup.deltas(edge, "words-1", "insert"),
        "c": token_rollup.revision(edge.where("source = 't'"), "words-1", "pieces-1"),
        "b": token_rollup.deltas(edge.where("source = 's'"), "words-1", "delete"),
        "none": token_rollup.deltas(empty, "words-1", "insert"),
    }
    assert [store.commit(k, d) for k, d in batches.items()] == [True] * 4
    assert [store.commit(k, d) for k, d in batches.items()] == [False] * 4  # sent again
    want = rollup_rows(store.totals())
    assert want == {(None, None, "words-1"): (2, 0), (None, "en", "words-1"): (1, 2), ("t", "de", "pieces-1"): (2, want[("t", "de", "pieces-1")][1])}
    assert store.compact() == 1
    later = token_rollup.TokenRollup(spark, path)  # a client that knows nothing of the base
    assert later.batches() == ["a", "b", "c", "none"] and rollup_rows(later.totals()) == want
    assert [later.commit(k, d) for k, d in batches.items()] == [False] * 4
    assert rollup_rows(later.totals()) == want
    assert later.commit("d", token_rollup.deltas(edge.where("source is null"), "words-1", "delete")) and later.compact() == 2
    assert rollup_rows(token_rollup.TokenRollup(spark, path).totals()) == {k: v for k, v in want.items() if k[0] == "t"}
    with pytest.raises(KeyError):
        token_rollup.deltas(edge, "words-1", "upsert")


def test_rollup_survives_a_lost_driver_and_two_writers(spark, edge):
    path = scratch_dir(spark)
    store = token_rollup.TokenRollup(spark, path)
    ins = token_rollup.deltas(edge, "words-1", "insert")
    store._write(ins)  # rows written, then the driver is lost before the log entry
    assert store.totals().count() == 0 and store.batches() == []
    assert store.commit("a", ins)
    want = rollup_rows(store.totals())
    summed = ins.groupBy(*token_rollup.KEYS).agg({"n_docs": "sum", "n_tokens": "sum"}).toDF(*token_rollup.KEYS, "n_docs", "n_tokens")
    store._commit("batch", "a", None, store._write(summed), ["a"])  # a second writer that looked before the first committed
    assert rollup_rows(store.totals()) == want
    store.compact()
    assert rollup_rows(store.totals()) == want


def test_a_base_keeps_tokens_of_groups_without_documents(spark, edge):
    """Deltas may arrive in any order: a delete before its insert, folded in between."""
    store = token_rollup.TokenRollup(spark, scratch_dir(spark))
    one = edge.where("source = 's'").limit(1)
    store.commit("out", token_rollup.deltas(one, "words-1", "delete", F.lit(7).cast("long")))
    store.commit("in", token_rollup.deltas(one, "words-1", "insert", F.lit(3).cast("long")))
    store.compact()
    store.commit("again", token_rollup.deltas(one, "words-1", "insert", F.lit(5).cast("long")))
    assert [v for v in rollup_rows(store.totals()).values()] == [(1, 1)]


# ---------------------------------------------------------------- 9 suffix arrays


def test_repeated_passages_equal_brute_force(spark, small):
    t = texts(read_table(spark, SF_ORACLE, "documents").where("doc_id < 1000"))
    got = {(r["doc_id"], r["start_word"], r["end_word"]) for r in suffix_dedup.repeated_passages(read_table(spark, SF_ORACLE, "documents")).collect()}
    assert got == brute.passages(t)


def test_truncated_passages_in_mixed_contexts(spark):
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(120)]
    rows = {}
    for d in range(60):
        a = rng.randrange(0, 60)
        b = a + rng.randrange(20, 61)
        rows[d] = " ".join([f"l{d}x{i}" for i in range(rng.randrange(30))] + passage[a:b] + [f"r{d}x{i}" for i in range(rng.randrange(30))])
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {(r["doc_id"], r["start_word"], r["end_word"]) for r in suffix_dedup.repeated_passages(df).collect()}
    assert got == brute.passages(rows)
    kept = {r["doc_id"]: r["text"] for r in suffix_dedup.cut_repeats(df).collect()}
    assert kept == brute.cut(rows)


def test_suffix_edges(edge, empty):
    rows = suffix_dedup.repeated_passages(edge).collect()
    assert sorted((r["doc_id"], r["start_word"], r["end_word"], r["first_doc_id"]) for r in rows) == [(5, 0, 6000, 5)] + [(6, 0, 6000, 5)] * 2
    kept = suffix_dedup.cut_repeats(edge)
    assert kept.columns == edge.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, -1, 1, 2, 3, 4, 5, 7, 8]
    assert suffix_dedup.repeated_passages(empty).count() == 0 and suffix_dedup.cut_repeats(empty).count() == 0


def test_blocks_of_any_few_words_pass(spark):
    words = [f"w{i}" for i in range(60)]
    for n in range(1, 61):
        block = next(suffix_dedup.blocks(pa.array([" ".join(words[:n])])))
        row, pos, _, count = suffix_dedup.retained(block, 50, 19)
        assert count.tolist() == [n] and (len(pos) > 0) == (n >= 50) and not row.any()
    rows = [(n, " ".join(words[:n])) for n in range(1, 61)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string")  # each in a partition of its own
    got = {(r["doc_id"], r["start_word"], r["end_word"]) for r in suffix_dedup.repeated_passages(df).collect()}
    assert got == {(n, 0, min(n, 59)) for n in range(50, 61)}
    assert {r["doc_id"] for r in suffix_dedup.cut_repeats(df).collect()} >= set(range(1, 51))


# ---------------------------------------------------------------- 10 toxicity


def test_kernel_equals_the_sum_over_shared_gapped_subsequences():
    def phi(w):
        out = Counter()
        for i, j, k in itertools.combinations(range(len(w)), 3):
            if k - i < toxicity.MAX_SPAN:
                out[w[i], w[j], w[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    rng = random.Random(2)
    ws = [bytes(rng.randrange(5) for _ in range(rng.randrange(3, 12))) for _ in range(12)]
    got = toxicity.Landmarks(ws).kernel(ws)
    for (i, a), (j, b) in itertools.product(enumerate(ws), repeat=2):
        x, y = phi(a), phi(b)
        want = sum(v * y[k] for k, v in x.items()) / (toxicity._norm(np.array(len(a))) * toxicity._norm(np.array(len(b))))
        assert abs(got[i, j] - want) < 1e-5
    assert np.linalg.eigvalsh(got).min() > -1e-6


def test_toxicity_finds_whole_gapped_and_spaced_insults_and_leaves_clean_texts(spark, edge, empty):
    rng = random.Random(4)
    parts = ["an", "er", "the", "ing", "on", "re", "st", "ly", "ou", "ti"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(1, 4)))
    clean = [" ".join(word() for _ in range(60)) for _ in range(400)]
    bad = [" ".join([*(word() for _ in range(40)), rng.choice(["blockhead", "dumkopf", "wretch"]), word()]) for _ in range(200)]
    model = toxicity.train(clean[:300] + bad[:150], [0] * 300 + [1] * 150)

    def chance(ts):
        return model.chance(toxicity._top_scores(pa.array(ts, pa.string()), model.weights, model.bias))

    assert (chance(bad[150:]) >= 0.5).mean() > 0.97 and (chance(clean[300:]) >= 0.5).mean() < 0.03
    assert (chance(["the b l o c k h e a d on", "re bl.ock.head!", "BLOCKHEAD", "blockkhead", "dumkxopf er"]) >= 0.5).all()
    rows = edge.select(toxicity.score_column(model).alias("p"), "score").collect()
    assert len(rows) == len(EDGE) and all(0 <= r["p"] <= 1 for r in rows)
    nothing = toxicity.train(["a b"], [0])
    assert chance([None, ""]).tolist() == [chance([""])[0]] * 2
    assert nothing.chance(np.array([1.0]))[0] < 1e-100
    assert empty.select(toxicity.score_column(model)).count() == 0


@pytest.mark.parametrize(("toxic", "clean", "wrong"), [(200, 200, 0), (150, 300, 0), (400, 400, 20)])
def test_many_rare_insults_are_learned_at_any_class_sizes(toxic, clean, wrong):
    rng = random.Random(11)
    make = lambda n: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(n))
    ordinary = [make(rng.randrange(2, 4)) for _ in range(400)]
    insults = [make(2) + "xq" + make(1) for _ in range(20)]
    text = lambda: [rng.choice(ordinary) for _ in range(60)]
    fine = lambda: " ".join(text())
    rude = lambda i: " ".join([*text(), insults[i % 20]])
    labelled = [(rude(i), 1) for i in range(toxic)] + [(fine(), 0) for _ in range(clean - wrong)] + [(rude(i), 0) for i in range(wrong)]
    model = toxicity.train([t for t, _ in labelled], [y for _, y in labelled])
    chance = lambda ts: model.chance(toxicity._top_scores(pa.array(ts, pa.string()), model.weights, model.bias))
    assert (chance([rude(i) for i in range(100)]) >= 0.5).mean() >= 0.9
    assert (chance([fine() for _ in range(100)]) >= 0.5).mean() <= 0.05


def test_strings_score_as_written_out_across_spaces_and_in_long_words():
    weights = np.random.default_rng(0).normal(size=toxicity.CODES).astype(np.float32)
    ts = ["id iot", "a", "", None, "the cat sat on it", "x" * 5000, "漢字" * 60 + " abc", "one two three " * 20]
    for block in toxicity.blocks(pa.array(ts, pa.string())):
        x = toxicity.strings(block)
        assert np.allclose(toxicity.string_scores(x, weights), toxicity.word_scores(*x.marked(np.arange(len(x.row))), weights), atol=1e-3)
        assert b"idiot" in {bytes(x.body[s:e] + 97) for s, e in zip(x.start, x.end, strict=True)}
        for r in np.unique(x.row):  # every letter is in a string that is no longer than a run
            own = (x.row == r) & (x.end - x.start <= toxicity.RUN * toxicity.LONG)
            held = np.zeros(len(x.body) + 1, int)
            np.add.at(held, x.start[own], 1)
            np.add.at(held, x.end[own], -1)
            everything = x.row == r
            assert (np.cumsum(held)[x.start[everything].min() : x.end[everything].max()] > 0).all()
    assert abs(toxicity._norm(np.array(9000)) / toxicity._norm(np.array(4500)) - 2**0.5) < 1e-3


@pytest.mark.parametrize("kind", ["phrase", "split", "no spaces"])
def test_toxic_phrases_split_insults_and_texts_without_spaces(kind):
    rng = random.Random(5)
    make = lambda n: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(n))
    ordinary = [make(rng.randrange(2, 4)) for _ in range(300)]
    signs = [chr(0x4E00 + i) for i in range(400)]
    if kind == "split":
        ordinary += ["xqu", "izv", "jho", "wyx"] * 5
    bad = {"phrase": [" ".join(ordinary[3 * i : 3 * i + 3]) for i in range(3)], "split": ["xqu izv", "jho wyx"]}.get(kind)
    bad = bad or ["".join(rng.choice(signs) for _ in range(3)) for _ in range(3)]

    def text(rude):
        gap = "" if kind == "no spaces" else " "
        words = [rng.choice(signs if kind == "no spaces" else ordinary) for _ in range(100)]
        return gap.join([*words[:40], rng.choice(bad), *words[40:]] if rude else words)

    model = toxicity.train([text(True) for _ in range(200)] + [text(False) for _ in range(400)], [1] * 200 + [0] * 400)
    chance = lambda ts: model.chance(toxicity._top_scores(pa.array(ts, pa.string()), model.weights, model.bias))
    assert (chance([text(True) for _ in range(100)]) >= 0.5).mean() >= 0.9
    assert (chance([text(False) for _ in range(100)]) >= 0.5).mean() <= 0.1


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op10_toxicity_string_kernel"](spark, sf).join(read_table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    right = [r for r in got if r["toxic"] == 1]
    clean = [r for r in got if r["toxic"] == 0]
    assert np.mean([r["predicted"] for r in right]) > 0.85 and np.mean([r["predicted"] for r in clean]) < 0.08


# ---------------------------------------------------------------- SQL


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(queries.ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    got = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(cols)
    assert Counter(map(tuple, got.select(*cols).collect())) == Counter(cur.fetchall())


def test_queries_are_named_by_their_operators():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert F is not None
