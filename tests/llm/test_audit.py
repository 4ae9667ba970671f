"""Licence scan, hard negatives and source divergence against plain versions."""

import random
import re
from collections import Counter, defaultdict

from llm import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import iceberg, licences, multiindex

# --- licences ---

LICENCE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def licences_by_hand(texts):
    """(words, places, base labels, labels, score) of each text."""
    split = [LICENCE_WORD.findall(brute.lower(t)) for t in texts]
    counts = Counter(x for w in split for x in set(w))
    out = []
    for w in split:
        places, base, labels, score = [], set(), set(), 0.0
        for phrase, label in licences.PHRASES:
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            places += at
            base |= {label} if at else set()
        for n in licences.notice_rows():
            rare = sorted({x for x in n["words"]} & set(w), key=lambda x: (counts[x], x))[: licences.RARE]
            offsets = Counter(i - p for i, x in enumerate(w) if x in rare for p in n["postings"][x])
            for o, agree in offsets.items():
                at = lambda i: w[i] if 0 <= i < len(w) else None
                keyed = all(at(o + k["at"] + i) == x for k in n["keys"] for i, x in enumerate(k["words"]))
                if agree >= licences.AGREE and keyed:
                    labels.add(n["label"])
                    score = max(score, sum(at(o + p) == x for p, x in enumerate(n["words"])) / len(n["words"]))
        ends = (min(places), max(places)) if places else (None, None)
        out.append((len(w), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(base | labels)), round(score, 9)))
    return out


def licence_texts():
    rng = random.Random(2)
    texts = [n[1] for n in licences.NOTICES] + [n[1].title().replace(" ", ", ") for n in licences.NOTICES]
    for _, text, _ in licences.NOTICES:  # words changed, lost or put in between
        w = text.split()
        for _ in range(4):
            i = rng.randrange(len(w))
            texts.append(" ".join([*w[:i], *rng.choice([[], ["x"], [w[i], "x"]]), *w[i + 1 :]]))
    texts += ["MIT License, mit-license MIT\nLICENSE. mit", "mitİ license", "mKt license", "MIT licence", "license " * 500]
    texts += ["cc " * 300 + "by nc " * 300, " ".join(n[1] for n in licences.NOTICES) * 3, "the general public license " + "a " * 20_000]
    return texts


def test_licences(make, odd):
    texts = licence_texts()
    got = sorted(map(tuple, licences.licence_report(make(list(enumerate(texts)))).collect()))
    assert [g[1:] for g in got] == licences_by_hand(texts)
    rows = odd.collect()
    want = Counter((r.doc_id, *x) for r, x in zip(rows, licences_by_hand([r.text or "" for r in rows])))
    assert Counter(map(tuple, licences.licence_report(odd).collect())) == want


def test_licences_add_labels_and_keep_columns(odd, t):
    out = licences.scanned(odd)
    assert out.columns == ["row", "n_words", "base", "notices"]
    assert out.select("row.*").columns == odd.columns
    labels = {x for r in licences.licence_report(t.documents).collect() for x in r.labels.split(",")}
    assert {"mit", "apache", "gpl"} & labels


def test_licences_run_without_python(shipped, odd):
    plan = licences.licence_report(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- hard negatives ---


def negatives_by_hand(rows, every):
    """rows: (id, label, whole components)."""
    out = []
    for a, mine, x in rows:
        if a % every:
            continue
        score = {b: int(np.dot(x, y)) for b, _, y in rows}
        same = sorted((-score[b], b) for b, label, _ in rows if label == mine and b != a)[:5]
        for s, p in same:
            s = -s
            fit = sorted((-score[b], b) for b, label, _ in rows if label != mine and 30 * s <= 100 * score[b] <= 90 * s)[:10]
            out += [(a, p, i + 1, b, s, -n) for i, (n, b) in enumerate(fit)]
    return sorted(out)


FRAME = "vec_id bigint, label int, embedding array<float>, id int, q int, cell int, wants string, score bigint"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1, "w", 1) for r in rows], FRAME).repartition(3)


RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("start", [40, 4096])
def test_hard_negatives(shipped, monkeypatch, start):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(4, 12))
    rows = [(i, int(rng.integers(4)), None) for i in range(700)]
    rows = [(i, c, (centres[c] + rng.normal(size=12)).astype(np.float32)) for i, c, _ in rows]
    rows += [(1000 + i, i % 2, rows[0][2]) for i in range(60)]  # ties
    monkeypatch.setattr(multiindex, "START", start)
    monkeypatch.setattr(multiindex, "ROWS", 50)
    monkeypatch.setattr(multiindex, "ANCHORS", 4)
    data = frame(shipped, [(i, c, [float(v) for v in x]) for i, c, x in rows])
    got = multiindex.hard_negatives(data, F.col("id") % 50 == 0, codes=6).select(*RESULT)
    want = negatives_by_hand([(i, c, np.floor(256 * x.astype(float)).astype(int)) for i, c, x in rows], 50)
    assert sorted(map(tuple, got.collect())) == want and want


def test_hard_negatives_of_odd_rows(shipped):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5, 0.0]),
        (None, 1, [1.0, 0.5, 0.0]),
        (1, None, [1.0, 0.5, 0.0]),
        (2, 1, None),
        (3, 1, [1.0, None, 0.0]),
        (4, 1, [nan, 0.0, 0.0]),
        (5, 2, [inf, 0.0, 0.0]),
        (6, 1, [0.9, 0.5, 0.0]),
        (6, 1, [0.9, 0.5, 0.0]),
        (7, 2, [0.5, 0.5]),  # shorter
        (8, 2, []),
        (9, 2, [0.5, 0.5, -0.25]),
        (10, 3, [-1.0, -1.0, 0.0]),
        (100, 3, [-1.0, -0.5, 3.0]),
    ]
    got = multiindex.hard_negatives(frame(shipped, rows), F.col("id") % 50 == 0).select(*RESULT)
    sound = {}
    for i, c, x in rows:
        if None not in (i, c, x) and all(v is not None and np.isfinite(v) for v in x):
            sound[i] = (i, c, np.floor(256 * np.array([*x, 0, 0, 0][:3], dtype=np.float32).astype(float)).astype(int))
    assert sorted(map(tuple, got.collect())) == negatives_by_hand(list(sound.values()), 50)


def test_hard_negatives_of_nothing(shipped):
    assert multiindex.hard_negatives(frame(shipped, []), F.col("id") % 100 == 0).collect() == []
    one = frame(shipped, [(0, 1, [1.0, 2.0])])
    assert multiindex.hard_negatives(one, F.col("id") % 100 == 0).collect() == []


def test_cells_come_in_falling_order_of_their_bounds():
    rng = np.random.default_rng(1)
    books, radii = (rng.normal(size=(9, 3)), rng.normal(size=(7, 3))), (rng.random(9), rng.random(7))
    for _ in range(20):
        x = rng.normal(size=6)
        seen = list(multiindex.visits(x, books, radii))
        a = books[0] @ x[:3] + np.linalg.norm(x[:3]) * radii[0]
        b = books[1] @ x[3:] + np.linalg.norm(x[3:]) * radii[1]
        bounds = {i * 7 + j: a[i] + b[j] for i in range(9) for j in range(7)}
        assert sorted(c for _, c in seen) == sorted(bounds)
        assert all(abs(bounds[c] - s) < 1e-9 for s, c in seen)
        assert all(p[0] >= q[0] for p, q in zip(seen, seen[1:]))


def test_large_whole_numbers():
    a = np.array([[2.0**22, -(2.0**22)], [1.0, 3.0]])
    assert multiindex.products(a * 2**8, a * 2**8).tolist() == [[2**61, -(2**39)], [-(2**39), 10 * 2**16]]


# --- source divergence ---

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audit_by_hand(rows, threshold=3, top=200):
    """rows: (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    held, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall(brute.lower(text))
        held[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang in {x for x, _ in counts}:
        kept = [x for x, n in held[lang].items() if n >= threshold]
        sources = {s: c for (g, s), c in counts.items() if g == lang}

        def shares(c):
            size = sum(c[x] for x in kept) + len(kept)
            return {x: 1 + 10**9 * (c[x] + 1) // size for x in kept}

        p = {s: shares(c) for s, c in sources.items()}
        q = shares(sum(sources.values(), Counter()))
        gain = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(sum(gain(p[s][x], p[o][x]) for x in kept), o) for o in sources if o != s]
            terms = [(gain(p[s][x], q[x]), x) for x in kept if sources[s][x] and p[s][x] > q[x]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, s, part, o, v, i + 1) for i, (v, o) in enumerate(items) if part == "pair" or i < top]
    return sorted(out)


def test_audit_of_odd_rows(odd):
    want = audit_by_hand([(r.text, r.lang, r.source) for r in odd.collect()])
    got = iceberg.source_divergence(odd)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("small", [False, True])
def test_audit(make, monkeypatch, small):
    rng = random.Random(9)
    words = ["".join(rng.choice("abé日xyz") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    words += [w[:k] for w in words[:40] for k in (4, 5, 8, 9, 16) if len(w) > k] + ["long" * 3000]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [
        (i, " ".join(rng.choices(words, weights, k=rng.randint(0, 60))), rng.choice(["en", "de", None]), f"s{rng.randint(0, 6)}")
        for i in range(400)
    ]
    docs += [(1000 + i, "long" * 3000 + "!" + "Long" * 3000, "en", "s1") for i in range(3)]
    docs += [(2000, "only here", "xx", "a"), (2001, "nowhere else", "xx", "b"), (2002, None, "yy", None)]  # no kept terms
    if small:
        for name, value in (("SOURCES", 2), ("PART", 50), ("TEXTS", 200), ("BROADCAST_BYTES", 0)):
            monkeypatch.setattr(iceberg, name, value)
    got = iceberg.source_divergence(make(docs), top=30)
    assert sorted(map(tuple, got.collect())) == audit_by_hand([d[1:] for d in docs], top=30)


def test_counts_travel_as_bytes_by_term(make, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("aBé日xyz") for _ in range(rng.randint(1, 12))) for _ in range(200)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(["en", "de"]), f"s{i % 5}é") for i in range(300)]
    monkeypatch.setattr(iceberg, "TEXTS", 1000)
    monkeypatch.setattr(iceberg, "BLOCKS", 1)
    blocks = iceberg.term_blocks(make(docs))
    counts = iceberg.group_counts(blocks, iceberg.frequent_terms(blocks, 3))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(lang#" in plan
    assert not re.search(r"hashpartitioning\([^)]*(source|term)#", plan)  # no row of its own for each count
    held, groups, langs = Counter(), Counter(), Counter()
    for _, text, lang, source in docs:
        found = TERM.findall(brute.lower(text))
        held.update((lang, x) for x in set(found))
        groups.update((lang, source, x) for x in found)
        langs.update((lang, x) for x in found)
    rows = counts.collect()
    want = sorted((g, s, x, n, langs[g, x]) for (g, s, x), n in groups.items() if held[g, x] >= 3)
    assert sorted((r.lang, r.source, r.term, r.n, r.in_lang) for r in rows) == want
    terms = {(r.lang, r.term) for r in rows}
    assert len({(r.lang, r.id) for r in rows}) == len({(r.lang, r.term, r.id) for r in rows}) == len(terms)


def test_prefixes_are_counted_once_a_document():
    rng = random.Random(8)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    docs = [(" ".join(rng.choices(words, k=rng.randint(0, 12))), rng.choice("xy"), rng.choice("st")) for _ in range(80)]
    columns = [pa.array([d[i] for d in docs]) for i in range(3)]
    block = iceberg.Block.of(pa.RecordBatch.from_arrays(columns, names=["text", "lang", "source"]))
    for size in (4, 8, 16):
        want = Counter()
        for text, lang, _ in docs:
            found = {x.encode() for x in TERM.findall(text)}
            want.update((lang, p) for p in {(x + b"\0")[:size] for x in found if size == 4 or len(x) >= size // 2})
        got = block.prefix_documents(size, 4).to_pylist()
        assert {(r["lang"], r["prefix"]): r["n"] for r in got} == want and len(got) == len(want)


def test_shares_of_large_counts(shipped):
    counts = [(0, 1), (5, 7), (8_999_999_999, 9_000_000_001), (9_000_000_000, 10**12), (10**15, 3 * 10**15 + 1)]
    df = shipped.createDataFrame(counts, "n bigint, total bigint")
    got = [r.p for r in df.select(iceberg.part_of(F.col("n"), F.col("total")).alias("p")).collect()]
    assert got == [1 + 10**9 * (n + 1) // total for n, total in counts]


def test_audit_of_nothing(empty):
    assert iceberg.source_divergence(empty).collect() == []
    assert licences.licence_report(empty).collect() == []
