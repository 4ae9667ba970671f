"""The pipeline against a version put together from SQL, sets and the tokenizer library."""

import base64
import hashlib
from collections import Counter, defaultdict

from llm import brute
import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import tiktoken
from conftest import SF

from tidemark.llm import oracles
from tidemark.session import settle


def expected(sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    good = con.execute(f"WITH {oracles.quality_ctes('documents')} SELECT doc_id FROM verdicts WHERE kept").fetchall()
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    first = defaultdict(list)
    for (d,) in good:
        first[brute.lower(texts[d])].append(d)
    single = sorted(min(ids) for ids in first.values())
    near = brute.components([(d, brute.shingles(texts[d], 5)) for d in single], 80)
    kept = [d for d in single if near[d] == d]
    con.execute("CREATE TABLE kept AS SELECT * FROM documents WHERE doc_id IN (SELECT unnest(?))", [kept])
    copies = con.execute(f"WITH RECURSIVE {oracles.MIX.format(docs='kept')} SELECT doc_id, copies FROM cuts").fetchall()
    with open(corpus_pipeline.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tool = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for d, n in copies:
        ids = tool.encode_ordinary(texts[d])
        packed = np.array(ids, "<u4").tobytes()
        want[(d, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(texts[d].encode()).hexdigest(), packed)] += n
    return Counter({k: n for k, n in want.items() if n})


def test_run(shipped):
    out = corpus_pipeline.run(shipped, SF)
    rows = out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids").collect()
    assert Counter((*r[:4], bytes(r[4])) for r in rows) == expected(SF)


def test_stages_on_odd_and_empty_tables(shipped, odd, empty):
    for docs in (odd, empty):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = docs.count()
            docs = settle(stage(shipped, docs, SF), f"test-{name}")
            assert docs.columns == columns
            assert docs.count() <= (2 * before if name == "source_mix" else before)
        out = corpus_pipeline.STAGES[-1][1](shipped, docs, SF)
        assert out.count() == docs.count()


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "source_mix", "byte_bpe"]
