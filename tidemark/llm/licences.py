"""Licence scan by a positional index over the rare words of licence notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import bind
from tidemark.llm.common import lower_ascii, row_of, text_of

# Phrases that name a licence by themselves.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Label, words of a public licence notice, key phrases that must stand in it.
NOTICES = [
    ("mit", "released under the mit license", ["mit license"]),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ["permission is hereby granted free of charge"],
    ),
    ("apache", "licensed under the apache license version 2 0", ["apache license"]),
    (
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ["except in compliance with the license"],
    ),
    ("gpl", "licensed under the gnu general public license version 3", ["general public license"]),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        ["free software you can redistribute it and or modify it", "gnu general public license"],
    ),
    ("lgpl", "licensed under the gnu lesser general public license version 3", ["lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license version 3", ["affero general public license"]),
    ("bsd", "licensed under the bsd license", ["bsd license"]),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ["redistribution and use in source and binary forms"],
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted",
        ["with or without fee is hereby granted"],
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ["mozilla public license"],
    ),
    ("epl", "made available under the terms of the eclipse public license", ["eclipse public license"]),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ["free and unencumbered software"],
    ),
    ("cc0", "released under cc0 1 0 universal", ["cc0 1 0"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by", "creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international", ["commons attribution sharealike"]),
    ("cc-by-nd", "licensed under cc by nd 4 0", ["cc by nd"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international", ["commons attribution noncommercial"]),
]

#: A notice is looked up by the rarest of its words that a file holds; so many of them must lie at one offset.
RARE, AGREE = 8, 2
#: What lies between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def notice_rows(notices: list = NOTICES, counts: dict[str, int] | None = None) -> list[dict]:
    """Label, words, postings (word to places, rarest word first) and the spans of the key phrases of each notice."""
    rarity = lambda x: ((counts or {}).get(x, 0), x)
    rows = []
    for label, text, phrases in notices:
        words = text.split()
        places: dict[str, list[int]] = {}
        for i, x in enumerate(words):
            places.setdefault(x, []).append(i)
        keys = []
        for phrase in (p.split() for p in phrases):
            at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
            keys.append({"at": at, "words": phrase})
        rarest = sorted(places, key=rarity)
        need = sorted({x for k in keys for x in k["words"]}, key=rarity)
        rows.append({"label": label, "words": words, "postings": places, "rarest": rarest, "keys": keys, "need": need})
    return rows


def constant(value) -> str:
    """SQL text of a nested value; the optimizer folds it into one literal."""
    if isinstance(value, list):
        return f"array({', '.join(map(constant, value))})"
    if isinstance(value, dict):
        return "named_struct({})".format(", ".join(f"'{k}', {constant(v)}" for k, v in value.items()))
    return str(value) if isinstance(value, int) else "'{}'".format(value.replace("\\", "\\\\").replace("'", "\\'"))


def index_of(templates: list[dict]) -> Column:
    """The notices as one constant, postings as a map."""

    def entry(t: dict) -> str:
        places = ", ".join(f"{constant(x)}, {constant(p)}" for x, p in t["postings"].items())
        rest = constant({k: v for k, v in t.items() if k != "postings"})
        return rest.replace("named_struct(", f"named_struct('postings', map({places}), ", 1)

    return F.expr(f"array({', '.join(map(entry, templates))})")


def vocabulary(notices: list = NOTICES, phrases: list = PHRASES) -> list[str]:
    return sorted({x for _, text, _ in notices for x in text.split()} | {x for p, _ in phrases for x in p.split()})


def words_of(text: Column) -> Column:
    """Words with A-Z in lower case. Only characters beyond ASCII may come out otherwise: no licence word has one."""
    folds = text.rlike("[\u0130\u212a]")  # their lower case begins with a letter of ASCII
    return F.array_remove(F.split(F.when(folds, lower_ascii(text)).otherwise(F.lower(text)), BETWEEN), "")


def document_counts(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """Documents that hold each word of the vocabulary; at most one row per word."""
    known = F.expr(constant(words))
    held = docs.select(F.explode(F.array_intersect(words_of(text_of()), known)).alias("word"))
    return {r.word: r.n for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def marks_of(w: Column, found: Column) -> Column:
    """Places of the licence words that a file holds."""
    numbered = F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return F.filter(numbered, lambda m: F.array_contains(found, m["x"]))


def phrase_places(w: Column, marks: Column, phrase: str) -> Column:
    """Word numbers at which the phrase begins."""
    words = phrase.split()
    full = F.array(*[F.lit(x) for x in words])
    begins = F.filter(marks, lambda m: (m["x"] == words[0]) & (F.slice(w, m["i"] + 1, len(words)) == full))
    return F.transform(begins, lambda m: m["i"])


def notice_places(t: Column, w: Column, found: Column, marks: Column) -> Column:
    """Where notice ``t`` stands: ``label, first, matched, length`` per place.

    The file's rarest words of the notice (fewest documents, then by the word)
    give offsets of file to notice. Where AGREE of them or more agree, the key
    phrases are read at their places, and all words of the notice are compared.
    """
    rare = F.slice(F.filter(t["rarest"], lambda x: F.array_contains(found, x)), 1, RARE)

    def offsets(r: Column) -> Column:
        hits = F.filter(marks, lambda m: F.array_contains(r, m["x"]))
        return F.array_sort(F.flatten(F.transform(hits, lambda m: F.transform(t["postings"][m["x"]], lambda p: m["i"] - p))))

    def agreeing(o: Column) -> Column:
        numbered = F.transform(o, lambda x, i: F.struct(x.alias("x"), F.get(o, i + (AGREE - 1)).alias("later")))
        return F.array_distinct(F.transform(F.filter(numbered, lambda n: n["x"] == n["later"]), lambda n: n["x"]))

    def stands(o: Column) -> Column:
        def read(k: Column) -> Column:
            at = F.greatest(o + k["at"], F.lit(0))
            return (o + k["at"] >= 0) & (F.slice(w, at + 1, F.size(k["words"])) == k["words"])

        return F.forall(t["keys"], read)

    def place(o: Column) -> Column:
        same = F.filter(F.transform(t["words"], lambda x, p: F.get(w, o + p) == x), lambda x: x)
        return F.struct(
            t["label"].alias("label"), o.alias("first"), F.size(same).alias("matched"), F.size(t["words"]).alias("length")
        )

    places = bind(bind(rare, offsets), agreeing)
    return F.transform(F.filter(places, stands), place)


def scanned(docs: DataFrame, notices: list = NOTICES, phrases: list = PHRASES) -> DataFrame:
    """``row`` (all columns of ``docs``) with ``n_words``, the ``base`` places of each phrase and the ``notices`` found.

    A null text counts as empty. Every row is judged by itself, so ties and
    repeated rows need no rule; word counts for rarity are taken over all rows.
    An empty table gives none.
    """
    known = vocabulary(notices, phrases)
    counts = document_counts(docs, known)
    templates = notice_rows(notices, counts)
    rows = index_of(templates)
    listed = F.expr(constant(known))
    # A file without the rarest word of any key phrase holds none of them.
    needs = [n["need"] for n in templates] + [p.split() for p, _ in phrases]
    leading = F.expr(constant(sorted({min(n, key=lambda x: (counts.get(x, 0), x)) for n in needs})))

    def judged(w: Column, found: Column) -> Column:
        def with_marks(marks: Column) -> Column:
            base = [F.struct(F.lit(name).alias("label"), phrase_places(w, marks, p).alias("places")) for p, name in phrases]
            fitting = F.filter(rows, lambda t: F.size(F.array_except(t["need"], found)) == 0)
            return F.struct(
                F.array(*base).alias("base"),
                F.flatten(F.transform(fitting, lambda t: notice_places(t, w, found, marks))).alias("notices"),
            )

        return F.when(F.arrays_overlap(found, leading), bind(marks_of(w, found), with_marks))

    def all_of(w: Column) -> Column:
        result = bind(F.array_intersect(w, listed), lambda found: judged(w, found))
        return F.struct(F.size(w).cast("long").alias("n"), result.alias("judged"))

    base = docs.select(row_of(docs), bind(words_of(text_of()), all_of).alias("all"))
    return base.select("row", "all.n", "all.judged.*").withColumnRenamed("n", "n_words")


def licence_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts and places of the phrases, their labels, all labels, and a score.

    The score is the largest share of a notice's words that stand at its place.
    """

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    none = F.array().cast("array<string>")
    places = F.coalesce(F.flatten(F.transform("base", lambda b: b["places"])), F.array().cast("array<int>"))
    named = F.coalesce(F.transform(F.filter("base", lambda b: F.size(b["places"]) > 0), lambda b: b["label"]), none)
    noticed = F.coalesce(F.transform("notices", lambda n: n["label"]), none)
    share = F.array_max(F.transform("notices", lambda n: n["matched"] / n["length"]))
    found = scanned(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", places.alias("places"), named.alias("named"), noticed.alias("noticed"),
        F.coalesce(share, F.lit(0.0)).alias("share"),
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        joined(F.col("named")).alias("base_labels"),
        joined(F.concat("named", "noticed")).alias("labels"),
        F.round("share", 9).alias("score"),
    )
