import itertools
import re
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.operators import nearcopies, text as docs, vectors as vec
from tidemark.session import folder


def model(text, size=300):
    """Plain account of the chunker: pack sentences, close before the one that is too long."""
    if not text.strip(" \t\n\r\f"):
        return []
    packed, used = [], 0
    for s in text.split(". "):
        if packed and used and used + len(s) <= size:
            packed[-1].append(s)
        else:
            packed.append([s])
            used = 0
        used += len(s) + 2
    joined = [". ".join(p).strip(" \t\n\r\f") for p in packed]
    return [j if j.endswith(".") else j + "." for j in joined]


TEXTS = [
    "",
    "   ",
    "One.",
    "No stop at all",
    "A. B. C.",
    ". ".join("word " * n for n in range(1, 40)),
    "x" * 1000 + ". short. " + "y" * 290 + ". z",
    "Ends with blank. ",
    "\n \n",
    "\nLine one. Line\ntwo.\n",
    "é" * 299 + ". ü. ö",
]


def chunked(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = docs.chunk_rows(df, "doc_id", "text", **kw).orderBy("doc_id", "chunk_index").collect()
    return [[r["chunk_text"] for r in got if r["doc_id"] == i] for i in range(len(texts))]


def test_chunks_equal_the_model(spark):
    assert chunked(spark, TEXTS) == [model(x) for x in TEXTS]


def test_chunk_udf_equals_the_model(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = df.select("doc_id", docs.chunk_udf()("text").alias("c")).orderBy("doc_id").collect()
    assert [[c["chunk_text"] for c in r["c"]] for r in got] == [model(x) for x in TEXTS]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text("abc é", min_size=1, max_size=120), min_size=1, max_size=12), min_size=1, max_size=6))
def test_chunks_keep_every_sentence_once(spark, many):
    texts = [". ".join(s) for s in many]
    for text, parts in zip(texts, chunked(spark, texts)):
        if text.strip(" "):
            strip = lambda s: re.sub(r"[. ]", "", s)
            assert strip("".join(parts)) == strip(text)


def test_chunk_overlap_repeats_sentences(spark):
    text = ". ".join(f"sentence {i} " + "x" * 100 for i in range(6))
    plain, over = chunked(spark, [text])[0], chunked(spark, [text], overlap=1)[0]
    assert len(plain) == len(over) and over[0] == plain[0]
    assert "sentence 1" in plain[0] and "sentence 1" not in plain[1] and "sentence 1" in over[1]


def test_words_and_shingles(spark):
    df = spark.createDataFrame([("Ab, cd!  Éf-ab 12",), ("",)], "t string")
    assert [r[0] for r in df.select(tx.words(F.col("t"))).collect()] == [["ab", "cd", "éf", "ab"], []]
    assert [len(r[0]) for r in df.select(tx.shingles(F.col("t"))).collect()] == [2, 1]


def test_token_scores(spark):
    df = spark.createDataFrame([(1, "the cat sat sat", "the cat ran"), (2, "", "x"), (3, "same", "same")], "k long, a string, e string")
    got = {r["k"]: tuple(round(r[c], 4) for c in ("precision", "recall", "f1")) for r in docs.token_scores(df, ["k"], "a", "e").collect()}
    assert got == {1: (0.5, 0.6667, 0.5714), 2: (0.0, 0.0, 0.0), 3: (1.0, 1.0, 1.0)}


def test_fold_splits_a_long_conversation(spark):
    df = spark.range(600).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("x").alias("text"))
    got = docs.fold_conversations(df).orderBy("page").collect()
    assert [len(r["messages"]) for r in got] == [256, 256, 88]
    assert [m["turn"] for r in got for m in r["messages"]] == list(range(600))


def _shingles(text, n=3):
    w = re.findall(r"[^\W\d_]+", text.lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {tuple(w)}


def groups_by_hand(texts, percent=70):
    """(id, smallest id reachable, size) of every text linked with another."""
    sets = {i: _shingles(x or "") for i, x in texts}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, j in itertools.combinations(sorted(sets), 2):
        common = len(sets[i] & sets[j])
        if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            a, b = sorted((find(i), find(j)))
            top[b] = a
    sizes = Counter(map(find, sets))
    return sorted((i, find(i), sizes[find(i)]) for i in sets if sizes[find(i)] > 1)


@pytest.mark.parametrize("path", ["pairs", "blocks"])
def test_near_groups_against_all_pairs(spark, monkeypatch, path):
    if path == "blocks":
        monkeypatch.setattr(nearcopies, "LIST", 1)
        monkeypatch.setattr(nearcopies, "BLOCK_DOCS", 4)
    rng = np.random.default_rng(3)
    vocab = [a + b + c for a, b, c in itertools.product("bdkm", "aeio", "nrst")]
    texts = []
    for _ in range(25):
        base = list(rng.choice(vocab, 80))
        texts.append(" ".join(base))
        for _ in range(int(rng.integers(0, 6))):  # each copy drifts from the one before: A ~ C ~ D, A unlike D
            base = list(base)
            for at in rng.integers(0, 80, 3):
                base[at] = "changed" + str(rng.integers(9))
            texts.append(" ".join(base))
    texts += ["one and the same text again and again"] * 60 + [None, "", " ", "a", "a b", "A B"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame([(int(i), x) for i, x in rows], "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, nearcopies.near_groups(df, "doc_id", "text").collect()))
    assert got == groups_by_hand(rows)


def test_near_groups_of_a_long_list_of_unlike_texts(spark):
    """2,000 texts share one rare passage and little else; three of them are a chain of copies."""
    word = lambda *x: "".join("abcdefghij"[int(c)] for c in "".join(map(str, x)))
    texts = [" ".join(["shared rare words"] + [word(i, 7, k) for k in range(20)]) for i in range(2000)]
    chain = texts[5].split()
    for k in (8, 12):
        chain[k] = chain[k] + "x"
        texts.append(" ".join(chain))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(map(tuple, nearcopies.near_groups(df, "doc_id", "text").collect()))
    assert got == [(5, 5, 3), (2000, 5, 3), (2001, 5, 3)]


def test_rare_postings_bound_what_two_sets_share(spark):
    """The bound of a shared posting holds for every pair, and shingles are shuffled twice only."""
    rng = np.random.default_rng(8)
    sets = {i: sorted({int(x) for x in rng.zipf(1.3, 40) % 500} | {1000 + i}) for i in range(60)}
    sets |= {100 + i: sets[i][:-2] + [2000 + i] for i in range(30)}
    df = spark.createDataFrame(list(sets.items()), "id long, s array<long>")
    postings = nearcopies.rare_postings(df, 70)
    plan = postings._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 2
    x, y = F.col("x"), F.col("y")
    one, two = (postings.select("h", F.struct("id", "known", "place").alias(k)) for k in "xy")
    met = one.join(two, "h").filter(x["id"] < y["id"])
    rows = met.select(x["id"].alias("a"), y["id"].alias("b"), nearcopies.reachable(x, y).alias("most")).collect()
    common = {(r.a, r.b): len(set(sets[r.a]) & set(sets[r.b])) for r in rows}
    assert all(common[r.a, r.b] <= r.most for r in rows)
    assert {(i, 100 + i) for i in range(30) if 100 * (len(sets[i]) - 2) >= 70 * (len(sets[i]) + 1)} <= set(common)


def test_only_sets_of_pairs_are_compared(spark, monkeypatch):
    """Sets of documents without a candidate do not reach the comparison."""
    seen = []
    wanted = nearcopies._sets_of
    monkeypatch.setattr(nearcopies, "_sets_of", lambda n, s: seen.append(wanted(n, s)) or seen[-1])
    sets = spark.createDataFrame([(i, [i, 7, 8, 9]) for i in range(50)], "id long, s array<long>")
    pairs = spark.createDataFrame([(3, 4), (4, 5)], "a long, b long")
    assert nearcopies._verified(pairs, sets, 60).count() == 2
    assert [sorted(r.id for r in x.collect()) for x in seen] == [[3, 4, 5]]


def test_components(spark):
    """A path, a star, a ring and a doubled edge."""
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(1, 2), (2, 1), (3, 3)]
    got = {r.node: r.label for r in nearcopies.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 60)} | {200: 200, 201: 200, 202: 200, 1: 1, 2: 1}
    assert got == want
    assert nearcopies.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(400, 16))
    m[10] = m[3]
    m[11] = 0
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    corpus = spark.createDataFrame(rows, "id long, v array<double>").repartition(5)
    queries = spark.createDataFrame([(i, rows[i][1]) for i in range(0, 60, 3)], "query_id long, v array<double>")
    return m, corpus, queries


def brute(m, qids, k):
    unit = m / np.where(np.linalg.norm(m, axis=1, keepdims=True) > 0, np.linalg.norm(m, axis=1, keepdims=True), np.nan)
    out = {}
    for q in qids:
        s = np.round(unit @ unit[q], 9)
        order = sorted((i for i in range(len(m)) if not np.isnan(s[i])), key=lambda i: (-s[i], i))
        out[q] = order[:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


def test_nearest_equals_brute_force(cloud):
    m, corpus, queries = cloud
    want = brute(m, range(0, 60, 3), 5)
    assert found(vec.nearest(corpus, "id", "v", queries, 5)) == want
    assert found(vec.nearest(corpus, "id", "v", queries, 5, limit=1)) == want
    assert found(vec.nearest_blocks(corpus, "id", "v", queries, 5, corpus_rows=60, query_rows=7)) == want


def test_index_recall_grows_to_exact(spark, cloud):
    m, corpus, queries = cloud
    index = vec.HyperplaneIndex(folder(spark, "index"), 16, bits=3)
    index.write(corpus, "id", "v")
    want = brute(m, range(0, 60, 3), 5)

    def recall(reach):
        got = found(index.search(queries, "v", 5, reach))
        return sum(len(set(got.get(q, [])) & set(w)) for q, w in want.items()) / (5 * len(want))

    near, full = recall(1), recall(3)
    assert full == 1.0 and 0.4 < near <= full


@pytest.mark.parametrize("limit", ["small", "blocks"])
def test_inverted_file(spark, cloud, monkeypatch, limit):
    """All cells: the codes alone cost little recall. Few cells: less is read. Scores are exact, zero vectors never found."""
    m, corpus, queries = cloud
    if limit == "blocks":  # query sets beyond one task
        monkeypatch.setattr(vec.nearest, "__defaults__", (None, 0, vec._unit))
    index = vec.InvertedFile(folder(spark, "ivf"), parts=8, words=64, cells=10)
    index.write(corpus, "id", "v")
    want = brute(m, range(0, 60, 3), 5)
    unit = np.nan_to_num(m / np.linalg.norm(m, axis=1, keepdims=True))

    def searched(probes):
        rows_ = index.search(queries, "v", 5, probes, 40).collect()
        assert all(abs(r["score"] - unit[r["query_id"]] @ unit[r["id"]]) < 1e-9 and r["id"] != 11 for r in rows_)
        got = found(index.search(queries, "v", 5, probes, 40))
        return sum(len(set(got.get(q, [])) & set(w)) for q, w in want.items()) / (5 * len(want))

    full, few = searched(10), searched(3)
    assert full >= 0.95 and 0.3 < few <= full


def test_search_scores_are_bounded(spark, monkeypatch):
    """A batch of 10,000 rows beside 4,000 visits of 400 cells: a product of all would take 320 MB."""
    m = np.random.default_rng(5).normal(size=(10_000, 4))
    frame = type(spark.range(0))
    captured, real = [], frame.mapInPandas
    monkeypatch.setattr(frame, "mapInPandas", lambda self, f, schema: captured.append(f) or real(self, f, schema))
    visits = spark.range(4_000).selectExpr(
        "id % 10 AS query_id", "transform(sequence(0, 3), i -> cast(sin(1 + id % 10 + i * i) AS double)) AS v", "cast(id div 10 AS int) AS c"
    )
    q = {r[0]: np.array(r[1]) for r in visits.select("query_id", "v").distinct().collect()}
    corpus = spark.createDataFrame([(i, v, i % 500) for i, v in enumerate(m[:3_000].tolist())], "id long, v array<double>, c int")
    got = found(vec.nearest(corpus, "id", "v", visits, 5, cell="c"))
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    held = np.flatnonzero(np.arange(3_000) % 500 < 400)
    order = {i: sorted(held, key=lambda r: (-round(float(unit[r] @ v / np.linalg.norm(v)), 9), r))[:5] for i, v in q.items()}
    assert got == order

    def peak(work):
        tracemalloc.start()
        try:
            work()
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    batch = pd.DataFrame({"id": np.arange(10_000), "v": m.tolist(), "cell": np.arange(10_000) % 500})
    assert peak(lambda: list(captured[0](iter([batch])))) < 64 << 20
    assert peak(lambda: vec._closest(m, m[:2_000])) < 64 << 20


def test_lateral_topk_keeps_ties_in_order(spark, rows):
    outer = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    inner = spark.createDataFrame([(1, 5, 1), (1, 5, 0), (1, 4, 2), (2, 1, 3)], "k long, v long, id long")
    got = vec.lateral_topk(outer, inner, ["k"], [F.desc("v"), F.asc("id")], 2)
    assert rows(got, "k", "id") == [(1, 0), (1, 1), (2, 3)]


def test_cosine_and_means(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 0.0])], "k long, v array<double>")
    got = {r["k"]: r["v"] for r in vec.mean_vectors(df, "k", "v").collect()}
    assert got == {1: [0.5, 0.5], 2: [0.0, 0.0]}
    r = spark.range(1).select(
        vec.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))).alias("c"),
        vec.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("z"),
    ).first()
    assert abs(r["c"] - 2**-0.5) < 1e-12 and r["z"] is None


def test_top_sentences_by_bounds(spark):
    """Only some words fit the limit; the sentences are those of exact counts."""
    rows = [(f"g{i % 3}", i, ". ".join(" ".join(f"{'abcdefgh'[(i * j + k * k) % (2 + j)] * (1 + k % 4)}" for k in range(j + 2)) for j in range(1, 7))) for i in range(40)]
    rows += [(None, 50, "alone here"), ("g9", 51, None), ("g1", 7, rows[7][2])]
    df = spark.createDataFrame(rows, "source string, doc_id long, text string")
    spread = df.select("doc_id", F.explode(F.array_distinct(tx.words(F.col("text")))).alias("word")).groupBy("word").agg(F.count("*").alias("docs"))
    floors = {limit: docs.frequent_words(spread, limit)[0] for limit in (1 << 20, 200, 0)}
    assert floors[1 << 20] == 0 and 0 < floors[200] <= floors[0]
    want = sorted(map(tuple, docs.top_sentences(df, "source", "doc_id", "text").collect()), key=repr)
    assert {r[0] for r in want} >= {"g0", "g1", "g2"}
    for limit in (200, 0):
        assert sorted(map(tuple, docs.top_sentences(df, "source", "doc_id", "text", limit=limit).collect()), key=repr) == want
