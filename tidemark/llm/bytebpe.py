"""Byte-level BPE: encode texts with the tokenizers library, keep offsets, decode through the byte table."""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import row_of, text_of

#: Pieces whose ids a Python worker remembers; past that it starts anew.
CACHE = 400_000
#: Texts encoded together.
TEXTS = 256


def byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Bytes that print (in Latin-1) stand for themselves, the others, in order,
    for the characters from 256 on.
    """
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair each token is merged from, in rank order.

    Merging the token's bytes with the ranks below its own leaves two parts;
    a token for which it does not is no merge (a byte, or never reached).
    """
    found = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) < 2:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(
                ((ranks[p], i) for i in range(len(parts) - 1) if ranks.get(p := parts[i] + parts[i + 1], rank) < rank),
                default=None,
            )
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) == 2:
            found.append((parts[0], parts[1]))
    return found


class ByteBpe:
    """Encoder and decoder of a rank file, one per Python worker."""

    def __init__(self, ranks_path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers.models import BPE

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        chars = byte_chars()
        shown = lambda token: "".join(map(chars.__getitem__, token))
        self.model = BPE(
            vocab={shown(t): r for t, r in ranks.items()}, merges=[(shown(a), shown(b)) for a, b in merges_of(ranks)]
        )
        self.pieces = regex.compile(pattern).findall
        self.shown = {b: ord(c) for b, c in enumerate(chars)}
        self.bytes: list[bytes] = [b""] * (1 + max(ranks.values()))
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: Iterable[str]) -> None:
        """Ids of new pieces by the library; each piece by itself, its bytes written as characters."""
        tokenize, shown, known = self.model.tokenize, self.shown, self.known
        for p in pieces:
            mapped = p.encode().decode("latin-1").translate(shown)
            known[p] = np.array([t.id for t in tokenize(mapped)], dtype="<u4").tobytes()

    def encode_batch(self, texts: Sequence[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.pieces(t) for t in texts]
        if len(self.known) > CACHE:
            self.known.clear()
        for pieces in split:
            self._learn({*pieces}.difference(self.known))
            yield b"".join(map(self.known.__getitem__, pieces))

    def decode_bytes(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def decode(self, ids: bytes) -> str:
        """The text. A character cut at the end of ``ids`` (a prefix of a document) is marked, not lost silently."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")

    def decode_parts(self, parts: Iterable[bytes]) -> Iterator[str]:
        """Text part by part; the bytes of a character split between parts wait for the rest."""
        decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
        for ids in parts:
            yield decoder.decode(self.decode_bytes(ids))
        yield decoder.decode(b"", final=True)

    def offsets(self, text: str, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last character of each token; tokens that share a character both cover it."""
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        char_at = np.cumsum((raw & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[np.frombuffer(ids, dtype="<u4")])
        starts = ends - self.lengths[np.frombuffer(ids, dtype="<u4")]
        return char_at[starts], char_at[ends - 1] + 1


@lru_cache(maxsize=2)
def bpe(ranks_path: str, pattern: str) -> ByteBpe:
    return ByteBpe(ranks_path, pattern)


ENCODED = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids binary"


def encoded(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    keep: Sequence[str] | None = None,
    with_ids: bool = True,
    with_offsets: bool = False,
) -> DataFrame:
    """``row`` (the columns ``keep`` of ``docs``, or all) with ``n_tokens``, digests of ids and decoded bytes, ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers. With offsets, two array
    columns give the characters each token covers. A null text counts as empty
    and has no ids; text in any script comes back byte by byte. Each row stands
    for itself: repeated rows repeat, an empty table stays empty. The vocabulary
    file must lie at ``ranks_path`` on every executor; there are no special tokens.
    """
    spans = ", starts array<int>, ends array<int>" if with_offsets else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = bpe(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                texts = part.column("text").to_pylist()
                ids = list(tool.encode_batch(texts))
                columns = {
                    "row": part.column("row"),
                    "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    "decoded_sha256": pa.array(
                        [hashlib.sha256(tool.decode_bytes(x)).hexdigest() for x in ids], pa.string()
                    ),
                    "ids": pa.array(ids if with_ids else [None] * len(ids), pa.binary()),
                }
                if with_offsets:
                    pairs = [tool.offsets(t, x) for t, x in zip(texts, ids)]
                    columns["starts"] = pa.array([p[0] for p in pairs], pa.list_(pa.int32()))
                    columns["ends"] = pa.array([p[1] for p in pairs], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    source = docs.select(row_of(docs.select(*keep) if keep else docs), text_of().alias("text"))
    return source.mapInArrow(run, StructType([source.schema["row"], *StructType.fromDDL(ENCODED + spans)]))


def decoded(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``row`` (all columns of ``tokens``) and ``text`` from column ``ids``; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = bpe(ranks_path, pattern)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            text = pa.array([None if x is None else tool.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "text": text})

    source = tokens.select(row_of(tokens), F.col("ids"))
    return source.mapInArrow(run, StructType([source.schema["row"], *StructType.fromDDL("text string")]))


def bpe_report(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    out = encoded(docs.select("doc_id", "text"), ranks_path, pattern, keep=["doc_id"], with_ids=False)
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
