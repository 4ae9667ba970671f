"""Secrets: fixed patterns, and formats learned from them as probabilistic automata."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect, bisect_left
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

# The base kinds in their order, and the shortest match of each.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more from its start, as [0-9a-f]+ takes it
MIN_ASSIGN, MIN_ACCESS = 6, 20
#: Values of the other kinds.
PLAIN = re.compile(r"[0-9a-f]{24,}|AKIA[A-Z0-9]{16,}")
#: Kind of the spans that the automata add.
LEARNED = "format"
#: Runs that are no credentials, by their characters.
ORDINARY = ("number", "word")
#: Runs of the characters of labelled credentials, as long as the shortest, are candidates.
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{MIN_ASSIGN},}}", re.ASCII)
#: What stands between a name and its value, and at the end of a sentence: parts between them are candidates too.
SEPARATOR, PIECE, SENTENCE = re.compile(r"[=/.]+"), re.compile(r"[^=/.]+"), re.compile(r"[^.]+")

#: Labelled credentials per kind to learn from, and the longest that is learned from.
SAMPLE, LONGEST = 400, 1024
#: Longer parts of a run are scored together, and longer runs are not kept for the next time they are met.
SHORT = 256
#: Groups by another hash in which a kind's least hashes are found before those of the kind.
SALTS = 64
#: Significance of the test that keeps two states apart; smaller merges more.
ALPHA = 0.05
#: Occurrences added to each symbol and the end in every state.
PRIOR = 0.1
#: Probability of a symbol that the sample does not have.
UNSEEN = 1e-6
LOG_UNSEEN = math.log(UNSEEN)
#: Part of the held-out credentials whose score a candidate may lie below.
REJECTED = 0.05


def base_matches(text: str) -> list[tuple[str, int, int, str]]:
    """``kind, start, end, credential`` of all base matches, by start and then kind."""
    found = [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def candidates(text: str, taken: Sequence[tuple]) -> list[tuple[int, int, str]]:
    """Runs of credential characters, or what base matches leave of them."""
    if not taken:
        return [(*m.span(), m[0]) for m in CANDIDATE.finditer(text)]
    spans, at, found = sorted((s, e) for _, s, e, *_ in taken), 0, []
    upto = 0  # end of the base matches so far
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(spans) and spans[at][0] < end:
            s, e = spans[at]
            if s - max(start, upto) >= MIN_ASSIGN:
                left = max(start, upto)
                found.append((left, s, text[left:s]))
            upto = max(upto, e)
            at += 1
        start = max(start, upto)
        if end - start >= MIN_ASSIGN:
            found.append((start, end, text[start:end]))
    return found


def parts(run: str, longest: int | None = None) -> list[tuple[int, int]]:
    """Spans of a run to be judged, longest first: the whole, its parts between separators and those behind one.

    ``longest`` leaves out spans that no kind is long enough for, before they are built.
    """
    top = len(run) if longest is None else min(longest, len(run))
    if not SEPARATOR.search(run):
        return [(0, len(run))] if len(run) <= top else []
    sentences = [m.span() for m in SENTENCE.finditer(run)]
    found = {(0, len(run)), *(m.span() for m in PIECE.finditer(run)), *sentences}
    starts = [m.end() for m in SEPARATOR.finditer(run)]
    for low, high in [(0, len(run)), *sentences]:
        found |= {(s, high) for s in starts[bisect_left(starts, max(low, high - top)) : bisect_left(starts, high)]}
    return sorted((x for x in found if MIN_ASSIGN <= x[1] - x[0] <= top), key=lambda x: (x[0] - x[1], x))


@dataclass
class State:
    """A state of the automaton: strings that ended here, and per symbol their number and the next state."""

    ends: int = 0
    seen: int = 0
    counts: dict[str, int] = field(default_factory=dict)
    next: dict[str, State] = field(default_factory=dict)


def prefix_tree(words: Sequence[str]) -> State:
    root = State()
    for word in words:
        state = root
        state.seen += 1
        for c in word:
            state.counts[c] = state.counts.get(c, 0) + 1
            state = state.next.setdefault(c, State())
            state.seen += 1
        state.ends += 1
    return root


def _differ(f1: int, n1: int, f2: int, n2: int, alpha: float) -> bool:
    """Hoeffding's bound: the two frequencies cannot well come from one probability."""
    if not n1 or not n2:
        return False
    return abs(f1 / n1 - f2 / n2) > math.sqrt(0.5 * math.log(2 / alpha)) * (n1**-0.5 + n2**-0.5)


def compatible(a: State, b: State, alpha: float) -> bool:
    """No significant difference in ends or symbols, here and below."""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if _differ(a.ends, a.seen, b.ends, b.seen, alpha):
            return False
        for c in a.counts.keys() | b.counts.keys():
            if _differ(a.counts.get(c, 0), a.seen, b.counts.get(c, 0), b.seen, alpha):
                return False
            if c in a.next and c in b.next:
                todo.append((a.next[c], b.next[c]))
    return True


def fold(into: State, tree: State) -> None:
    """Add the counts of a tree to an automaton, state by state."""
    todo = [(into, tree)]
    while todo:
        a, b = todo.pop()
        a.ends += b.ends
        a.seen += b.seen
        for c, n in b.counts.items():
            a.counts[c] = a.counts.get(c, 0) + n
        for c, child in b.next.items():
            if c in a.next:
                todo.append((a.next[c], child))
            else:
                a.next[c] = child


Automaton = tuple[list[dict[str, tuple[float, int]]], list[float]]


def infer(words: Sequence[str], alpha: float = ALPHA) -> Automaton:
    """Merge compatible states of the prefix tree, nearest to the root first.

    States that differ from all accepted ones are accepted themselves; the
    others are merged into the first they fit. The result has, per state, the
    log probability of each symbol with its next state, and that of ending. Every
    symbol of the sample gets ``PRIOR`` more occurrences in every state, those a
    state has not seen lead where most do.
    """
    root = prefix_tree(words)
    accepted = [root]
    waiting = [(root, c) for c in sorted(root.next)]
    while waiting:
        parent, c = waiting.pop(0)
        state = parent.next[c]
        if any(state is s for s in accepted):
            continue
        fit = next((s for s in accepted if compatible(s, state, alpha)), None)
        if fit is None:
            accepted.append(state)
            waiting += [(state, x) for x in sorted(state.next)]
        else:
            parent.next[c] = fit
            fold(fit, state)
            known = {(id(p), x) for p, x in waiting}
            for s in accepted:
                waiting += [
                    (s, x) for x in sorted(s.next) if (id(s), x) not in known and not any(s.next[x] is t for t in accepted)
                ]
    number = {id(s): k for k, s in enumerate(accepted)}
    alphabet = sorted({c for s in accepted for c in s.counts})
    steps, ends = [], []
    for s in accepted:
        total = s.seen + PRIOR * (len(alphabet) + 1)
        usual = s.next[max(s.counts, key=lambda c: (s.counts[c], c))] if s.counts else s
        steps.append(
            {c: (math.log((s.counts.get(c, 0) + PRIOR) / total), number[id(s.next.get(c, usual))]) for c in alphabet}
        )
        ends.append(math.log((s.ends + PRIOR) / total))
    return steps, ends


def score(automaton: Automaton, word: str, least: float = -math.inf) -> float:
    """Mean log probability per symbol and end; a symbol not in the sample costs ``UNSEEN`` and stays in its state.

    A score below ``least`` is not worked out to its end: another one below ``least`` is returned.
    """
    steps, ends = automaton
    state, total, floor = 0, 0.0, (least - 1e-6) * (len(word) + 1)
    for c in word:
        step = steps[state].get(c)
        if step is None:
            total += LOG_UNSEEN
        else:
            total += step[0]
            state = step[1]
        if total < floor:
            return total / (len(word) + 1)
    return (total + ends[state]) / (len(word) + 1)


def tail_scores(automaton: Automaton, word: str) -> np.ndarray:
    """``score`` of each tail of a word, ``word[i:]`` at ``i``, in one pass from its end."""
    steps, ends = automaton
    states = range(len(steps))
    moves = {c: [steps[q].get(c, (LOG_UNSEEN, q)) for q in states] for c in set(word)}
    tables = {c: (np.array([x for x, _ in m]), np.array([q for _, q in m])) for c, m in moves.items()}
    rest, out = np.array(ends), np.empty(len(word))  # of what follows, by the state before it
    for i in range(len(word) - 1, -1, -1):
        cost, to = tables[word[i]]
        rest = cost + rest[to]
        out[i] = rest[0]
    return out / np.arange(len(word) + 1, 1, -1)


class Formats:
    """The automata of the labelled kinds, the least score of each, and the automata of ordinary runs."""

    def __init__(self, samples: dict[str, list[str]], alpha: float = ALPHA, rejected: float = REJECTED):
        labelled = {k: v for k, v in samples.items() if k not in ORDINARY}
        self.kinds = learn(labelled, alpha, rejected)
        self.ordinary = [infer(samples[k], alpha) for k in ORDINARY if len(samples.get(k, ())) >= 10]

    def fits(self, word: str, scored: Callable[[Automaton, str, float], float] = score) -> bool:
        """Likely enough in some kind of credentials, and likelier there than as an ordinary run; of any length."""
        best = max((x for m, least in self.kinds.values() if (x := scored(m, word, least)) >= least), default=None)
        return best is not None and all(best > scored(m, word, best) for m in self.ordinary)

    def within(self, run: str) -> tuple[tuple[int, int], ...]:
        """The parts of a run that fit; where they overlap, the longest.

        Parts with the same end share one pass of each automaton when they are long, so the work grows with the run.
        """
        if len(run) <= SHORT and not SEPARATOR.search(run):
            return ((0, len(run)),) if self.fits(run) else ()
        found: list[tuple[int, int]] = []
        spans = parts(run)
        first: dict[int, int] = {}
        for s, e in spans:
            first[e] = min(s, first.get(e, s))
        tails = lru_cache(maxsize=None)(lambda n, e: tail_scores(automata[n], run[first[e] : e]))
        automata = [*(m for m, _ in self.kinds.values()), *self.ordinary]
        number = {id(m): n for n, m in enumerate(automata)}
        for s, e in spans:
            at = bisect(found, (s, e))
            if (at and found[at - 1][1] > s) or (at < len(found) and found[at][0] < e):
                continue
            if e - s <= SHORT:
                fit = self.fits(run[s:e])
            else:
                fit = self.fits("", lambda m, *_: tails(number[id(m)], e)[s - first[e]])
            if fit:
                found.insert(at, (s, e))
        return tuple(found)


def learn(labelled: dict[str, list[str]], alpha: float = ALPHA, rejected: float = REJECTED) -> dict[str, tuple[Automaton, float]]:
    """Per kind its automaton and the least score that counts as its format.

    Each fifth of the credentials is scored by an automaton of the others; the
    limit is the score that all but the part ``rejected`` of them reach. Kinds
    with fewer than ten are not learned.
    """
    models = {}
    for kind, words in labelled.items():
        if len(words) < 10:
            continue
        held: list[float] = []
        for fold in range(5):
            rest = infer([w for k, w in enumerate(words) if k % 5 != fold], alpha)
            held += [score(rest, w) for w in words[fold::5]]
        models[kind] = (infer(words, alpha), sorted(held)[int(len(held) * rejected)])
    return models


def shape(word: str) -> str | None:
    """The ordinary kind of a run that no pattern labels: numbers of digits only, words of letters only."""
    if word.isascii() and word.isdigit():
        return ORDINARY[0]
    return ORDINARY[1] if word.isascii() and word.isalpha() else None


def labelled_sample(docs: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> dict[str, list[str]]:
    """Per kind at most ``sample`` different strings, those of least hash: a bounded, repeatable choice.

    A value that is an access key or a hex run counts there alone, not as an
    assigned one too. The parts of candidates, which no pattern labels, give two kinds of ordinary runs.
    Each task hands on no more than its own ``sample`` of a kind, each of ``SALTS``
    groups of a kind no more than that again, so that no task meets more than ``SALTS * sample`` of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = lru_cache(maxsize=100_000)(lambda v: hashlib.md5(v.encode()).hexdigest())
        kept: dict[str, set[str]] = {k: set() for k in (*KINDS, *ORDINARY)}
        limit: dict[str, str] = {}

        def cut(kind: str) -> None:
            if len(kept[kind]) > sample:
                least = sorted(kept[kind], key=lambda v: (hashed(v), v))[:sample]
                kept[kind], limit[kind] = set(least), hashed(least[-1])

        for batch in batches:
            runs: set[str] = set()
            values: set[tuple[str, str]] = set()
            for x in batch.column("text"):
                text = x.as_py() or ""
                base = base_matches(text)
                values.update(
                    (k, v) for k, _, _, v in base if len(v) <= longest and (k != "assign" or not PLAIN.fullmatch(v))
                )
                runs.update(CANDIDATE.findall(text) if not base else (r for *_, r in candidates(text, base)))
            pieces = {r[s:e] for r in runs for s, e in parts(r, longest)}
            values.update((k, v) for v in pieces if (k := shape(v)))
            for kind, v in values:
                if kind not in limit or hashed(v) <= limit[kind]:
                    kept[kind].add(v)
                    if len(kept[kind]) > 4 * sample:
                        cut(kind)
        for kind in kept:
            cut(kind)
        pairs = [(k, v) for k, values in kept.items() for v in values]
        yield pa.RecordBatch.from_pydict(
            {"kind": pa.array([k for k, _ in pairs], pa.string()), "value": pa.array([v for _, v in pairs], pa.string())}
        )

    values = docs.select("text").mapInArrow(run, "kind string, value string")
    chosen = values.distinct().withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(SALTS)))
    for group in (["kind", "salt"], ["kind"]):
        order = Window.partitionBy(*group).orderBy(F.md5("value"), "value")
        chosen = chosen.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample)
    out: dict[str, list[str]] = {}
    for row in sorted(chosen.collect(), key=lambda r: ((*KINDS, *ORDINARY).index(r.kind), r.n)):
        out.setdefault(row.kind, []).append(row.value)
    return out


def secrets(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    The base patterns label credentials; from a bounded sample of them one
    automaton per kind is learned. Every other run of credential characters in
    any text, what a base match leaves of one, and their parts between and behind
    separators are scored by all automata, and by those learned from ordinary runs. One
    becomes a span of kind ``format`` when a kind finds it as likely as its own
    and it is likelier than an ordinary run, however short or long it is. Offsets are code points, ends exclusive.
    A text without a match (or null, or empty) has the digest of the empty
    string and no spans; without labelled credentials nothing is added. Repeated
    rows are judged alike.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    formats = Formats(labelled_sample(slim, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = lru_cache(maxsize=100_000)(formats.within)
        within = lambda r: kept(r) if len(r) <= SHORT else formats.within(r)
        listed = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in spans)
        order = {k: n for n, k in enumerate((*KINDS, LEARNED))}
        for batch in batches:
            counts: dict[str, list[int]] = {k: [] for k in KINDS}
            digests, spans = [], []
            for x in batch.column("text"):
                text = x.as_py() or ""
                base = base_matches(text)
                for k in KINDS:
                    counts[k].append(sum(b[0] == k for b in base))
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                added = [(LEARNED, at + s, at + e) for at, _, r in candidates(text, base) for s, e in within(r)]
                spans.append(listed(sorted(base + added, key=lambda b: (b[1], order[b[0]]))))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    **{f"n_{k}": pa.array(v, pa.int64()) for k, v in counts.items()},
                    "base_sha256": pa.array(digests, pa.string()),
                    "spans": pa.array(spans, pa.string()),
                }
            )

    kind = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return slim.mapInArrow(run, kind)
