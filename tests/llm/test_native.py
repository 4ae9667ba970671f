"""Quality rules, mixing, exact copies and shards."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

from llm import brute
import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence, exact, mixing, sharding

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars", "row", "h", "size", "words", "node", "kept", "label", "normal", "block"]


# --- quality rules ---


def test_base_counts(odd):
    got = Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in divergence.quality_report(odd).collect()
    )
    want = Counter()
    for r in odd.collect():
        w, t = brute.words(r.text), r.text or ""
        lines = [x for x in t.split("\n") if brute.words(x)]
        n = brute.repeated_words(w)
        symbols = sum(c in "#*$%&|<>" for c in t)
        failed = len(w) < 20 or 100 * n > 30 * len(w)
        want[(r.doc_id, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), n, failed)] += 1
    assert got == want


@pytest.mark.parametrize("listed", [0, 5_000])
def test_common_words_in_order(shipped, monkeypatch, listed):
    """With the set of all languages' words and without it; a word common in another language only does not count."""
    monkeypatch.setattr(divergence, "LISTED", listed)
    refs = shipped.createDataFrame([("a", ["der", "\u03bf\u03c2"]), ("b", ["the", "of"]), ("c", None)], "lang string, common array<string>")
    rows = [("a", ["Der", "THE", "\u039f\u03a3", "der", "rest"]), ("b", ["The", "der", "OF", "the"]), ("c", ["the"]), ("a", [])]
    df = shipped.createDataFrame(rows, "lang string, w array<string>").join(refs, "lang")
    got = sorted((r.lang, r.f) for r in df.select("lang", divergence.common_words(refs, F.col("w")).alias("f")).collect() if r.f is not None)
    assert got == [("a", []), ("a", ["der", "\u03bf\u03c2", "der"]), ("b", ["the", "of", "the"]), ("c", [])]


def test_divergence_tells_junk_from_prose(make):
    rng = random.Random(3)
    common = "the of and to in a is that it for on was with be as by this are re at an from".split()
    rare = lambda: "".join(rng.choice("aeioustrnl") for _ in range(rng.randint(5, 9)))
    text = lambda n: " ".join(rng.choice(common) if rng.random() < 0.5 else rare() for _ in range(n))
    clean = [(i, text(rng.randint(60, 300)) + ".", "en", "s") for i in range(150)]
    junk = [(1000 + i, text(200).upper().replace(" ", "!! "), "en", "s") for i in range(5)]
    junk += [(1010 + i, " | ".join(rare() for _ in range(200)), "en", "s") for i in range(5)]
    short = [(2000, " ".join(rare() for _ in range(20)).upper()[:99], "en", "s")]  # too short for a verdict
    kept = {r.doc_id: r.kept for r in divergence.quality_report(make(clean + junk + short)).collect()}
    assert all(kept[d] for d, *_ in clean)
    assert not any(kept[d] for d, *_ in junk)


def test_labels_on_held_out_documents(shipped, t):
    """Of the labelled documents: few good ones go, and most bad ones that are long enough do."""
    judged = divergence.quality_report(t.documents).join(t.labels, "doc_id").filter("n_words >= 60").collect()
    good, bad = [r for r in judged if r.quality == 1], [r for r in judged if r.quality == 0]
    assert sum(r.kept or r.base_failed for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)


def test_stage_keeps_columns(odd):
    out = divergence.good_documents(odd)
    assert out.columns == DOCUMENT
    assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in odd.collect()}


# --- mixing ---


def mixed_by_hand(rows):
    sizes = [(r.doc_id, r.source, len(brute.words(r.text))) for r in rows]
    totals = defaultdict(int)
    for _, s, n in sizes:
        totals[s] += n
    order = sorted((s for s in totals if s is not None), key=lambda s: s.encode()) + [None] * (None in totals)
    target = brute.water(totals, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    return sizes, totals, target


def test_mixture(odd):
    got = mixing.mixture(odd).collect()
    sizes, totals, target = mixed_by_hand(odd.collect())
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter(sizes)
    largest = defaultdict(int)
    for _, s, n in sizes:
        largest[s] = max(largest[s], n)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == totals[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert r.taken == r["size"] * r.copies and 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for s in totals:  # rows of one id go together: document 15 is there twice
        assert abs(taken[s] - target[s]) <= largest[s]


def test_mixture_is_near_and_repeatable(make):
    rng = random.Random(1)
    docs = [(i, "w " * rng.randint(0, 30), None, "hot" if i % 3 else f"s{i % 7}") for i in range(6000)]
    a = sorted(map(tuple, mixing.mixture(make(docs)).collect()))
    b = sorted(map(tuple, mixing.mixture(make(docs).repartition(7)).collect()))
    assert a == b
    taken = defaultdict(int)
    goal = {}
    for r in mixing.mixture(make(docs)).collect():
        taken[r.source] += r.taken
        goal[r.source] = r.target
    assert all(abs(taken[s] - goal[s]) <= 15 for s in goal)


def test_mixed_rows(odd):
    copies = Counter()
    for r in mixing.mixture(odd).collect():
        copies[r.doc_id, r.source] += r.copies
    out = mixing.mixed(odd)
    assert out.columns == DOCUMENT
    assert Counter((r.doc_id, r.source) for r in out.collect()) == Counter({k: n for k, n in copies.items() if n})


# --- exact copies ---


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact(odd, keep):
    rows = odd.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[brute.lower(r.text)].append(r.doc_id)
    want = Counter()
    for r in rows:
        ids = groups[brute.lower(r.text)]
        known = [d for d in ids if d is not None]
        stays = (max if keep == "largest" else min)(known, default=None) if len(ids) > 1 else r.doc_id
        digest = hashlib.sha256(brute.lower(r.text).encode()).hexdigest()
        want[(r.doc_id, stays, len(ids), r.doc_id == stays, digest)] += 1
    got = Counter(tuple(r) for r in exact.exact_report(odd, keep).collect())
    assert got == want


def test_texts_under_one_hash_are_told_apart(odd):
    plain = Counter(tuple(r)[1:] for r in exact.with_groups(odd).select("normal", "doc_id", "keep_id", "group_size", "kept").collect())
    for weak in (lambda c: F.lit("x"), lambda c: (F.length(c) % 2).cast("string")):
        found = exact.with_groups(odd, digest=weak).select("normal", "doc_id", "keep_id", "group_size", "kept").collect()
        assert Counter(tuple(r)[1:] for r in found) == plain


def test_without_copies(odd):
    out = exact.without_copies(odd)
    assert out.columns == DOCUMENT
    assert len({brute.lower(r.text) for r in out.collect()}) == len({brute.lower(r.text) for r in odd.collect()})


# --- shards ---


def check_shards(rows, got, count):
    groups = defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    first = {t: min((d for d in ids if d is not None), default=-1) for t, ids in groups.items()}
    order = sorted(groups, key=lambda t: (first[t], hashlib.sha256(t.encode()).digest()))
    sizes = [len(groups[t]) * (len(t.encode()) + 1) for t in order]
    capacity, cuts = brute.best_capacity(sizes, count)
    shard_of = {t: sum(c <= i for c in cuts) for i, t in enumerate(order)}
    load, slots, whole = Counter(), defaultdict(list), defaultdict(set)
    by_text = defaultdict(list)
    for r in rows:
        t = r.text or ""
        by_text[(r.doc_id, len(t.encode()) + 1, zlib.crc32(t.encode()))].append(t)
    for r in got:
        key = (r.doc_id, r["size"], r.text_crc32)
        assert key in by_text
        whole[by_text[key][0]].add(r.shard)
        assert r.shard in {shard_of[t] for t in by_text[key]}
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert len(got) == len(rows)
    assert max(load.values()) == capacity and 0 <= min(load) <= max(load) < count
    assert all(len(s) == 1 for s in whole.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_odd_rows(odd):
    check_shards(odd.collect(), sharding.shards(odd, 5).collect(), 5)


@pytest.mark.parametrize("count", [2, 16])
def test_shards(make, count):
    rng = random.Random(count)
    docs = make([(i, "hot" * 50 if i % 3 == 0 else "x" * rng.randint(0, 400)) for i in range(3000)])
    check_shards(docs.collect(), sharding.shards(docs, count).collect(), count)


@pytest.mark.parametrize("grid", [3, 50, 4096])
def test_search_refines_small_grids(make, monkeypatch, grid):
    rng = random.Random(4)
    monkeypatch.setattr(sharding, "GRID", grid)
    monkeypatch.setattr(sharding, "SPLIT", 2)
    docs = make([(i, f"{i} " + "x" * rng.randint(0, 900)) for i in range(500)])
    check_shards(docs.collect(), sharding.shards(docs, 7).collect(), 7)


# --- all ---


def test_empty_tables(empty):
    for out in (
        divergence.quality_report(empty),
        divergence.good_documents(empty),
        mixing.mixture(empty),
        mixing.mixed(empty),
        exact.exact_report(empty),
        exact.without_copies(empty),
        sharding.shards(empty),
    ):
        assert out.collect() == []
