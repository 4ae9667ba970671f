"""URL rules and secrets against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import secretscan, urlrules

PAGES = "page_id long, url string, host string, key string, kind int, block int"


def by_hand(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
        path = re.split("[?#]", rest[n:], maxsplit=1)[0]
    fits = [
        (len(h) + len(p), len(h), h + p, v)
        for h, p, v in rules
        if host and (host == h or host.endswith("." + h) or not h) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


@pytest.mark.parametrize("blocks", [1, 40])
def test_judged(shipped, monkeypatch, blocks):
    rng = random.Random(blocks)
    label = lambda: rng.choice(["a", "b", "www", "com", "net", "x-y", "ä"])
    host = lambda: ".".join(label() for _ in range(rng.randint(1, 4)))
    path = lambda: "/" + "/".join(rng.choice(["", "en", "e", "fr"]) for _ in range(rng.randint(0, 3)))
    rules = {(host(), rng.choice(["", path()])): rng.choice(["allow", "block"]) for _ in range(60)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [f"http{rng.choice(['', 's'])}://{host().upper() if i % 9 == 0 else host()}{rng.choice(['', path()])}{rng.choice(['', '?q=/en', '#/fr', '?a://b'])}" for i in range(1500)]
    urls += [None, "", "no scheme", "://", "http://", "http:///en/", "x://a.com?y", "http://a\nb.com/en/", "a://" + "z." * 300 + "com/en"]
    urls += ["https://www.a.com/en/"] * 500  # one hot host
    rows = [(i, u, "h", "k", 0, 0) for i, u in enumerate(urls)] + [(None, urls[3], "h", "k", 0, 0)]
    pages = shipped.createDataFrame(rows, PAGES)
    if blocks > 1:
        kept = urlrules.ordered_blocks
        monkeypatch.setattr(urlrules, "ordered_blocks", lambda df, order, label: kept(df, order, label, rows_per_block=50))
    got = {r.page_id: tuple(r)[1:] for r in urlrules.judged(pages, urlrules.rule_table(shipped, rules)).collect()}
    assert got == {i: by_hand(u, rules) for i, u, *_ in rows}


def test_many_path_lengths_of_one_host(shipped):
    """Rules of every length, in no order, several of the same length, and a host inside the host."""
    rng = random.Random(7)
    paths = ["/" + "".join(rng.choice("ab/") for _ in range(i % 40)) for i in range(120)]
    given = {("com", p): rng.choice(["allow", "block"]) for p in paths} | {("a.com", p): "block" for p in paths[::7]}
    rules = [(h, p, v) for (h, p), v in given.items()]
    urls = [f"http://{h}{rng.choice(paths)[: rng.randint(1, 40)]}ab" for h in ("com", "a.com", "b.a.com") for _ in range(200)]
    pages = shipped.createDataFrame([(i, u, "h", "k", 0, 0) for i, u in enumerate(urls)], PAGES)
    got = {r.page_id: tuple(r)[1:] for r in urlrules.judged(pages, urlrules.rule_table(shipped, rules)).collect()}
    assert got == {i: by_hand(u, rules) for i, u in enumerate(urls)}


def test_no_pages_and_no_rules(shipped):
    none = shipped.createDataFrame([], PAGES)
    rules = urlrules.rule_table(shipped, [("com", "/", "allow")])
    assert urlrules.judged(none, rules).collect() == []
    pages = shipped.createDataFrame([(1, "http://a.com/", "", "", 0, 0)], PAGES)
    out = urlrules.judged(pages, rules.filter("false")).collect()
    assert [tuple(r) for r in out] == [(1, "a.com", "/", None, "allow")]
    nulls = shipped.createDataFrame([(None, "/", "block"), ("a.com", None, "block")], "host string, path string, verdict string")
    assert urlrules.judged(pages, nulls).first().rule is None


# --- secrets ---

BASE = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def base_by_hand(text):
    found = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            if (len(m[2]) >= 6) if kind == "assign" else len(m[0]) >= {"access": 20, "hex": 24}[kind]:
                found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x for *_, x in sorted(found)]


def secret_rows():
    rng = random.Random(7)
    hexed = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    upper = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(n))
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 22)))
    rows, hidden = [], {}
    for i in range(300):
        parts = [word() for _ in range(30)]
        kind = i % 6
        if kind == 0:
            parts.insert(5, f"Password = '{hexed(18)}'")
        elif kind == 1:
            parts.insert(5, f"AKIA{upper(16)}")
        elif kind == 2:
            parts.insert(5, hexed(40))
        elif kind == 3:
            hidden[i] = hexed(20)  # no base pattern takes it
            parts.insert(5, hidden[i])
        elif kind == 4:
            parts.insert(5, "".join(rng.choice("0123456789") for _ in range(16)))
        rows.append((i, " ".join(parts)))
    rows += [(1000, None), (1001, ""), (1002, "token=token:abcdefgh secret=ab TOKEN : é"), (1003, "AKIA" * 8 + " apikey=" + "é" * 9)]
    return rows, hidden


def test_secrets(make):
    rows, hidden = secret_rows()
    got = {r.doc_id: r for r in secretscan.secrets(make(rows)).collect()}
    assert set(got) == {d for d, _ in rows}
    added = {}
    for d, text in rows:
        r, base = got[d], base_by_hand(text)
        kinds = [b.split(":")[0] for b in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in BASE)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if not s.startswith("format")] == base
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)
        added[d] = [text[int(a) : int(b)] for k, a, b in (s.split(":") for s in spans) if k == "format"]
    caught = [d for d, value in hidden.items() if value in added[d]]
    others = [x for d, found in added.items() if d not in hidden for x in found]
    assert len(caught) >= 0.8 * len(hidden)
    assert len(others) <= 6  # of 50 numbers and some thousand words


def test_short_named_and_left_over_values(make):
    """A learned format counts in short values, behind a name, at the end of a sentence and beside a base match."""
    rng = random.Random(17)
    value = lambda n: "".join(rng.choice("BCDFGHJKLMNPQRSTVWXZ23456789") for _ in range(n))
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 14)))
    rows, hidden = [], {}
    for i in range(400):
        parts = [word() for _ in range(30)]
        if i % 2 == 0:
            parts.insert(5, f"token: {value(rng.randint(8, 40))}")
        else:
            v = value(10 if i % 8 == 1 else 24)
            shown = {1: f"pwd: {v}", 3: f"client_secret_id={v}", 5: f"(see/{v}.)", 7: f"AKIA{value(16)}/{v}"}[i % 8]
            hidden[i] = (i % 8, v)
            parts.insert(5, shown)
        rows.append((i, " ".join(parts)))
    texts = dict(rows)
    caught = {1: 0, 3: 0, 5: 0, 7: 0}
    others = 0
    for r in secretscan.secrets(make(rows)).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s.startswith("format")]
        found = [texts[r.doc_id][int(s) : int(e)] for _, s, e in spans]
        way, v = hidden.get(r.doc_id, (0, None))
        if v in found:
            caught[way] += 1
        others += sum(x != v for x in found)
    assert all(n >= 40 for n in caught.values()), caught
    assert others <= 12


def test_parts_of_a_run():
    run = "a_name=VALUE1/more22.tail333"
    found = {run[s:e] for s, e in secretscan.parts(run)}
    assert {run, "VALUE1", "more22", "tail333", "VALUE1/more22", "a_name=VALUE1/more22", "more22.tail333"} <= found
    text = "xx012345 AKIA" + "Z" * 16 + "/rest99 " + "before-" + "0a" * 14 + "g-after"
    left = [c[2] for c in secretscan.candidates(text, secretscan.base_matches(text))]
    assert left == ["xx012345", "/rest99", "before-", "g-after"]
    assert all(text[s:e] == v for s, e, v in secretscan.candidates(text, secretscan.base_matches(text)))


def test_long_values_behind_a_separator_are_parts():
    jwt = ".".join("x" * n for n in (60, 120, 80))
    run = f"client_jwt={jwt}"
    assert (11, len(run)) in secretscan.parts(run)
    assert (11, len(run)) in secretscan.parts(run, 400) and (11, len(run)) not in secretscan.parts(run, 200)
    assert secretscan.parts("a" * 50, 49) == []


def test_long_formats_are_learned_and_found(make):
    """Labelled values of three parts and 200 to 300 characters are found without their keyword, behind another name too."""
    rng = random.Random(23)
    part = lambda n: "".join(rng.choice("ABCDEFGHJKMNPQRSTVWXYZ23456789") for _ in range(n))
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 14)))
    rows, hidden = [], {}
    for i in range(240):
        v = f"{part(60)}.{part(rng.randint(100, 180))}.{part(60)}"
        hidden[i] = v
        shown = f"token: {v}" if i % 2 else (v if i % 4 else f"client_jwt={v}")
        rows.append((i, " ".join([word() for _ in range(10)] + [shown] + [word() for _ in range(10)])))
    texts = dict(rows)
    caught = 0
    for r in secretscan.secrets(make(rows)).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s.startswith("format")]
        found = [texts[r.doc_id][int(s) : int(e)] for _, s, e in spans]
        if r.doc_id % 2 == 0:
            caught += any(hidden[r.doc_id] in x for x in found)
        assert all(len(x) > 100 for x in found)
    assert caught >= 0.9 * 120, caught


def test_values_of_other_lengths_are_judged(make):
    """Labelled values have 20 to 40 characters; those of 10, of 300 and of parts to 3,000 are found by the same format."""
    rng = random.Random(31)
    value = lambda n: "".join(rng.choice("BCDFGHJKLMNPQRSTVWXZ23456789") for _ in range(n))
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 14)))
    rows, hidden = [], {}
    for i in range(300):
        shown = f"token: {value(rng.randint(20, 40))}"
        if i % 3 == 0:
            hidden[i] = value(10) if i % 9 == 0 else value(300) if i % 9 == 3 else "/".join(value(60) for _ in range(50))
            shown = f"pwd: {hidden[i]}" if i % 2 else f"client_id={hidden[i]}"
        rows.append((i, " ".join([word() for _ in range(10)] + [shown] + [word() for _ in range(10)])))
    texts, caught = dict(rows), {0: 0, 3: 0, 6: 0}
    for r in secretscan.secrets(make(rows)).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s.startswith("format")]
        covered = sum(int(e) - int(s) for _, s, e in spans if texts[r.doc_id][int(s) : int(e)] in hidden.get(r.doc_id, ""))
        if r.doc_id in hidden:
            caught[r.doc_id % 9] += covered >= 0.9 * len(hidden[r.doc_id])
    assert caught[0] >= 17 and caught[3] >= 28 and caught[6] >= 28, caught  # the scores of short ones differ more


def test_tails_of_long_runs():
    """Scores of all tails in one pass, and the spans of a long run, are those of the parts one by one."""
    rng = random.Random(37)
    value = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    formats = secretscan.Formats({"assign": [value("ABCD29", rng.randint(8, 20)) for _ in range(100)], "word": [value("etaoin", 9) for _ in range(50)]})
    model = formats.kinds["assign"][0]
    run = value("ABCD29e", 90)
    assert np.allclose(secretscan.tail_scores(model, run), [secretscan.score(model, run[i:]) for i in range(90)])
    pieces = [value("ABCD29" if rng.random() < 0.7 else "etaoin", rng.randint(6, 30)) for _ in range(120)]
    run = "".join(p + rng.choice("/=..") for p in pieces) + "ABCD2929"
    want = []
    for s, e in secretscan.parts(run):
        if all(e <= a or b <= s for a, b in want) and formats.fits(run[s:e]):
            want.append((s, e))
    assert len(want) > 1 and formats.within(run) == tuple(sorted(want))
    assert sum(e - s for s, e in formats.within("ABCD2929/" * 30_000)) >= 240_000


def test_sample_is_the_least_hashes_of_each_kind(make, monkeypatch):
    rng = random.Random(29)
    runs = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(900)]
    rows = [(i, f"x {v} token={v}") for i, v in enumerate(runs)]
    least = sorted(set(runs), key=lambda v: (hashlib.md5(v.encode()).hexdigest(), v))[:50]
    for salts in (1, 7):
        monkeypatch.setattr(secretscan, "SALTS", salts)
        got = secretscan.labelled_sample(make(rows), 50)
        assert got["hex"] == least and "assign" not in got  # a hex run counts as one kind only


def test_held_out_labelled_values_without_their_context():
    """Each fifth of the labelled values of the given documents, stripped of keyword and prefix, against a model of the others."""
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"]).column("text").to_pylist()
    labelled, ordinary, runs = {}, {k: set() for k in secretscan.ORDINARY}, set()
    for text in texts:
        base = secretscan.base_matches(text or "")
        for kind, _, _, v in base:
            if kind != "assign" or not secretscan.PLAIN.fullmatch(v):
                labelled.setdefault(kind, set()).add(v)
        for *_, r in secretscan.candidates(text or "", base):
            runs.add(r)
            if k := secretscan.shape(r):
                ordinary[k].add(r)
    usual = {k: sorted(v)[:400] for k, v in ordinary.items()}
    hits = total = 0
    for fold in range(5):
        lists = {k: sorted(v) for k, v in labelled.items() if len(v) >= 15}
        formats = secretscan.Formats({k: [w for i, w in enumerate(v) if i % 5 != fold] for k, v in lists.items()} | usual)
        held = [w for v in lists.values() for w in v[fold::5]]
        hits += sum(formats.fits(w) for w in held)
        total += len(held)
    assert total and hits >= 0.9 * total, (hits, total)
    alarms = sum(bool(formats.within(r)) for r in runs)
    assert alarms <= 0.001 * len(runs), alarms


def test_odd_rows(odd, empty):
    got = secretscan.secrets(odd).collect()
    assert len(got) == odd.count()
    assert [r.spans for r in got if r.doc_id == 18] == [",".join(base_by_hand(next(x.text for x in odd.collect() if x.doc_id == 18)))]
    assert secretscan.secrets(empty).collect() == []


def test_inference_learns_a_prefix_and_a_loop():
    rng = random.Random(1)
    words = ["AK-" + "".join(rng.choice("01") for _ in range(rng.randint(4, 12))) for _ in range(300)]
    model = secretscan.infer(words)
    assert len(model[0]) <= 12
    inside, outside = secretscan.score(model, "AK-0110100"), secretscan.score(model, "BK-0110100")
    assert inside > -1.2 and inside > outside + 0.5
    total = [sum(2.718281828459045 ** p for p, _ in steps.values()) + 2.718281828459045 ** end for steps, end in zip(*model)]
    assert all(abs(t - 1) < 1e-4 for t in total)


def test_held_out_formats():
    rows, _ = secret_rows()
    sample = {}
    for _, text in rows:
        for kind, _, _, value in secretscan.base_matches(text or ""):
            sample.setdefault(kind, []).append(value)
    models = secretscan.learn({k: v[: len(v) // 2] for k, v in sample.items()})
    for kind, values in sample.items():
        model, least = models[kind]
        rest = values[len(values) // 2 :]
        assert sum(secretscan.score(model, v) >= least for v in rest) >= 0.8 * len(rest)
