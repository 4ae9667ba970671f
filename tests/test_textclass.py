import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import textclass as tc

ROWS = [
    (1, "a", "the cat sat on the mat"),
    (2, "a", "The dog and the CAT"),
    (3, "b", "le chat est sur la table"),
    (4, "b", "une autre table \U0001f600 ici"),
    (5, "b", None),
    (6, None, "no label here"),
    (7, "a", "xy"),
]
DDL = "id long, label string, text string"


def slots_of(text, n, slots):
    low = [ord(c.lower()) if "A" <= c <= "Z" else ord(c) for c in text or ""]
    out = []
    for i in range(len(low) - n + 1):
        h = 0
        for k in range(n):
            h = h * 31 + low[i + k]
        out.append(h % slots)
    return out


def brute(rows, texts, n, slots):
    hits, docs = {}, Counter()
    for _, label, text in rows:
        if label is not None:
            docs[label] += 1
            hits.setdefault(label, Counter()).update(slots_of(text, n, slots))
    total = sum(docs.values())
    scaled = lambda p: math.floor(10_000 * math.log(p) + 0.5)
    out = []
    for text in texts:
        score = {}
        for label in sorted(docs):
            size = sum(hits[label].values()) + slots
            score[label] = scaled(docs[label] / total) + sum(
                scaled((hits[label][s] + 1) / size) for s in slots_of(text, n, slots)
            )
        out.append(max(sorted(score), key=lambda x: score[x]) if score else None)
    return out


@pytest.mark.parametrize("n, slots", [(3, 4096), (2, 64), (1, 7)])
def test_equals_brute_force(spark, n, slots):
    df = spark.createDataFrame(ROWS, DDL).repartition(3)
    texts = [r[2] for r in ROWS] + ["", "la table", "the mat", "ééé"]
    model = tc.fit_grams(df, "label", "text", n, slots)
    asked = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r["predicted"] for r in model.add_class(asked, "text").orderBy("i").collect()]
    assert got == brute(ROWS, texts, n, slots)


def test_counts_do_not_depend_on_batches_or_held_labels(spark):
    """More labels in a task than it holds at once, and all rows of one label in every task."""
    rows = [(i, f"label{i % 150}", f"text number {i % 7}") for i in range(900)]
    df = spark.createDataFrame(rows, DDL)
    one = tc.gram_counts(df.coalesce(1), "label", "text", 3, 64)
    many = tc.gram_counts(df.repartition(8), "label", "text", 3, 64)
    assert sorted(one.collect()) == sorted(many.collect())
    assert one.filter("slot = -1").agg(F.sum("hits")).first()[0] == 900


def test_odd_inputs(spark):
    empty = spark.createDataFrame([], DDL)
    model = tc.fit_grams(empty, "label", "text")
    asked = spark.createDataFrame([(1, "abc"), (2, None)], "i int, text string")
    assert [r["predicted"] for r in model.add_class(asked, "text").collect()] == [None, None]
    # A column named as one of the result's helpers, integer labels, a very long text.
    rows = [(0, 5, "ab " * 400_000, "s"), (1, 7, "xyz", "s")]
    df = spark.createDataFrame(rows, "label int, hits int, text string, slot string")
    model = tc.fit_grams(df, "hits", "text")
    got = model.add_class(df, "text")
    assert got.columns == ["label", "hits", "text", "slot", "predicted"]
    assert [r["predicted"] for r in got.orderBy("label").collect()] == ["5", "7"]
    with pytest.raises(ValueError):
        tc.fit_grams(df, "hits", "text", max_labels=1)


def test_a_long_text_is_counted_in_pieces(monkeypatch):
    text = "".join(chr(97 + i * i % 23) for i in range(500)) + "\U0001f600x"
    whole = Counter(slots_of(text, 3, 64))
    for piece in (1, 7, 499, 501, 1 << 16):
        monkeypatch.setattr(tc, "PIECE", piece)
        assert dict(whole) == {i: n for i, n in enumerate(tc.slot_hits(text, 3, 64).tolist()) if n}
    assert not tc.slot_hits(None, 3, 64).any() and not tc.slot_hits("ab", 3, 64).any()
