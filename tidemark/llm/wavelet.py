"""Token ids as one wavelet matrix per shard: a compressed file with access, count and occurrence lookup."""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.bytebpe import byte_chars
from tidemark.llm.common import broadcast_checked, slices, text_of
from tidemark.session import folder

MAGIC = b"WVM1"
#: Bits between two entries of a plane's rank directory.
STRIDE = 4096
#: Ids after which a shard ends with its document.
SHARD_TOKENS = 2_000_000
#: Words whose ids a Python worker remembers.
CACHE = 1_000_000
#: Characters of the longest word that is kept.
KEPT = 64
#: Bytes of text encoded together.
TEXTS = 16 << 20
#: Letters before this one are composed and change case one by one; only the dotted capital I does not.
LETTERS = "\u0180"


def _packer():
    import zstandard

    return zstandard.ZstdCompressor(level=1)


class WaveletShard:
    """Ids of consecutive documents.

    Plane ``k`` holds bit ``k`` (highest first) of every id, in the order left by
    a stable partition on the plane before: zeros first, then ones. The file has
    a header, the sizes of its parts, and the parts, each compressed by itself:
    document ids, null marks, document starts, then per plane its bits and the
    number of ones before every ``STRIDE`` bits. A plane is opened on first use.
    """

    def __init__(self, payload: bytes):
        import zstandard

        magic, self.bits, self.n, self.docs = struct.unpack_from("<4sIQQ", payload)
        if magic != MAGIC:
            raise ValueError("not a wavelet shard")
        count = 3 + 2 * self.bits
        sizes = struct.unpack_from(f"<{count}Q", payload, 24)
        at = 24 + 8 * count
        self._parts = []
        for size in sizes:
            self._parts.append(payload[at : at + size])
            at += size
        self._open = zstandard.ZstdDecompressor().decompress
        self._planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @staticmethod
    def build(doc_ids: Sequence[int | None], ids: Sequence[np.ndarray], bits: int = 16) -> bytes:
        """The file's bytes for documents in the given order."""
        pack = _packer().compress
        lengths = np.array([len(x) for x in ids], dtype=np.uint64)
        starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
        current = np.concatenate([*ids, np.empty(0, np.uint32)]).astype(np.uint16 if bits <= 16 else np.uint32)
        parts = [
            pack(np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes()),
            pack(np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes()),
            pack(starts.tobytes()),
        ]
        for k in range(bits):
            ones = (current & current.dtype.type(1 << (bits - 1 - k))).astype(bool)
            packed = np.packbits(ones)
            # Ones per stride, counted byte by byte; the last stride may be short.
            counted = np.bitwise_count(packed)
            before = np.add.reduceat(counted, np.arange(0, len(packed), STRIDE // 8), dtype=np.int64) if len(packed) else []
            directory = np.concatenate([[0], np.cumsum(before)]).astype("<u8")
            parts += [pack(packed.tobytes()), pack(directory.tobytes())]
            mask, values = pa.array(ones), pa.array(current)  # Arrow filters by random bits far faster
            current = np.concatenate([values.filter(pc.invert(mask)).to_numpy(), values.filter(mask).to_numpy()])
        head = struct.pack("<4sIQQ", MAGIC, bits, int(starts[-1]), len(doc_ids))
        return head + struct.pack(f"<{len(parts)}Q", *map(len, parts)) + b"".join(parts)

    def doc_ids(self) -> list[int | None]:
        ids = np.frombuffer(self._open(self._parts[0]), dtype="<i8").tolist() if self.docs else []
        null = self._open(self._parts[1]) if self.docs else b""
        return [None if is_null else d for d, is_null in zip(ids, null)]

    def starts(self) -> np.ndarray:
        """First place of each document, and the end."""
        return np.frombuffer(self._open(self._parts[2]), dtype="<u8").astype(np.int64)

    def _plane(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        if k not in self._planes:
            raw, directory = self._open(self._parts[3 + 2 * k]) if self.n else b"", self._open(self._parts[4 + 2 * k])
            self._planes[k] = np.frombuffer(raw, np.uint8), np.frombuffer(directory, "<u8").astype(np.int64)
        return self._planes[k]

    def _ones(self, k: int, i: int) -> int:
        """Ones before place ``i`` of plane ``k``: the directory, then at most ``STRIDE`` bits."""
        raw, directory = self._plane(k)
        block = i // STRIDE
        rest = np.unpackbits(raw[block * STRIDE // 8 : (i + 7) // 8])[: i - block * STRIDE]
        return int(directory[block]) + int(rest.sum())

    def _bit(self, k: int, i: int) -> int:
        return int(self._plane(k)[0][i >> 3] >> (7 - (i & 7))) & 1

    def _zeros(self, k: int) -> int:
        return self.n - int(self._plane(k)[1][-1])

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        value = 0
        for k in range(self.bits):
            bit = self._bit(k, i)
            ones = self._ones(k, i)
            value = value << 1 | bit
            i = self._zeros(k) + ones if bit else i - ones
        return value

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        if token >> self.bits:
            return 0, 0
        for k in range(self.bits):
            a, b = self._ones(k, low), self._ones(k, high)
            low, high = (self._zeros(k) + a, self._zeros(k) + b) if token >> (self.bits - 1 - k) & 1 else (low - a, high - b)
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of ``token`` in places ``low`` to ``high``, end exclusive."""
        a, b = self._range(token, low, self.n if high is None else high)
        return b - a

    def _select(self, k: int, bit: int, j: int) -> int:
        """Place of the ``j``-th (from 0) ``bit`` of plane ``k``: search the directory, then one block."""
        raw, directory = self._plane(k)
        seen = directory if bit else np.arange(len(directory)) * STRIDE - directory
        block = int(np.searchsorted(seen[:-1], j, side="right")) - 1
        inside = np.unpackbits(raw[block * STRIDE // 8 : (block + 1) * STRIDE // 8])
        return block * STRIDE + int(np.flatnonzero(inside == bit)[j - int(seen[block])])

    def occurrence(self, token: int, j: int) -> int:
        """Place of the ``j``-th occurrence (from 0) of ``token``."""
        low, high = self._range(token, 0, self.n)
        if not 0 <= j < high - low:
            raise IndexError(f"{token} occurs {high - low} times")
        at = low + j
        for k in reversed(range(self.bits)):
            bit = token >> (self.bits - 1 - k) & 1
            at = self._select(k, bit, at - self._zeros(k) if bit else at)
        return at

    def tokens(self) -> np.ndarray:
        """All ids: the partitions undone from the last plane to the first."""
        values = np.zeros(self.n, dtype=np.uint16 if self.bits <= 16 else np.uint32)
        for k in reversed(range(self.bits)):
            ones = np.unpackbits(self._plane(k)[0], count=self.n).astype(bool)
            zeros = self.n - int(ones.sum())
            before = np.empty_like(values)
            before[~ones] = values[:zeros]
            before[ones] = values[zeros:] | values.dtype.type(1 << (self.bits - 1 - k))
            values = before
        return values


# The steps before the model in vocabularies that are encoded word by word.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def splits_into_words(settings: dict) -> bool:
    """Whether a vocabulary drops white space, lower-cases and maps bytes as ``WordBpe`` does by itself."""
    before = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True}
    return (
        (settings.get("normalizer") or {}).get("normalizers") == NORMALIZERS
        and len(before) == 2
        and before[0] == split
        and before[1].get("type") == "ByteLevel"
        and not before[1].get("add_prefix_space")
        and not before[1].get("use_regex")
        and settings["model"].get("type") == "BPE"
        and not settings["model"].get("dropout")
        and not settings.get("truncation")
        and not settings.get("padding")
    )


class WordBpe:
    """Ids of texts by a vocabulary of the tokenizers library.

    A vocabulary that drops white space cannot join characters across it, so a
    text's ids are those of its words in a row, and a word is encoded once per
    worker. Any other vocabulary encodes whole texts by the library. One with
    ids that ``dtype`` does not hold is an error.
    """

    def __init__(self, path: str, dtype: str = "<u2"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.tool.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tool.model
        self.dtype = np.dtype(dtype)
        if max(self.tool.get_vocab().values(), default=0) > np.iinfo(self.dtype).max:
            raise ValueError(f"{path} has ids that {dtype} does not hold")
        with open(path, encoding="utf-8") as f:
            self.by_word = splits_into_words(json.load(f))
        self.shown = {b: ord(c) for b, c in enumerate(byte_chars())}
        self.known: dict[str, bytes] = {"": b""}
        self.packers: dict[int, Callable[..., bytes]] = {}
        self.marks = {m: self._pack(self.tool.encode(m, add_special_tokens=False).ids) for m in ("", *".,;:!?")}

    def _pack(self, ids: list[int]) -> bytes:
        n = len(ids)
        if n not in self.packers:
            self.packers[n] = struct.Struct(f"<{n}{self.dtype.char}").pack
        return self.packers[n](*ids)

    def _learn(self, words: Iterable[str]) -> None:
        """Ids of new words: letters up to ``LETTERS`` straight by the model, others through the whole tool.

        For such letters the tool's steps come to lower case and the bytes'
        characters. One mark after a letter is a piece of its own in any case.
        """
        known, tokenize, shown, marks, others = self.known, self.model.tokenize, self.shown, self.marks, []
        for w in words:
            core, mark = (w, "") if w.isalpha() else (w[:-1], w[-1])
            plain = core.isascii() or (max(core) < LETTERS and "\u0130" not in core)
            if not plain or len(w) > KEPT or mark not in marks or not core.isalpha():
                others.append(w)
                continue
            low = core.lower()
            ids = known.get(low)
            if ids is None:
                mapped = low if low.isascii() else low.encode().decode("latin-1").translate(shown)
                ids = known[low] = self._pack([t.id for t in tokenize(mapped)])
            known[w] = ids + marks[mark]
        for w, e in zip(others, self.tool.encode_batch_fast(others, add_special_tokens=False)):
            known[w] = self._pack(e.ids)

    def _pieces(self, words: list[str]) -> list[bytes]:
        """Ids of different words. Long ones are not kept, so the cache stays bounded in bytes too."""
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > CACHE:
            known.clear()
            known[""] = b""
            new = [w for w in words if w]
        self._learn(new)
        pieces = [known[w] for w in words]
        for w in new:
            if len(w) > KEPT:
                del known[w]
        return pieces

    def encode_batch(self, texts: pa.Array | Sequence[str], end: bytes = b"") -> Iterator[np.ndarray]:
        """Ids of each text, with the bytes of ``end`` after them. Each different word of the batch is looked up once."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        last = np.frombuffer(end, dtype=self.dtype)
        if not self.by_word:
            for e in self.tool.encode_batch_fast(texts.to_pylist(), add_special_tokens=False):
                yield np.concatenate([np.array(e.ids, dtype=self.dtype), last])
            return
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        different = pa.ListArray.from_arrays(pa.array([0, len(words.dictionary)], pa.int32()), words.dictionary)
        pieces = self._pieces(pc.binary_join(different, " ")[0].as_py().split(" "))  # far faster than one by one
        sizes = np.array([len(p) for p in pieces], dtype=np.int64) // self.dtype.itemsize
        ids = np.frombuffer(b"".join(pieces), dtype=self.dtype)
        begins = np.cumsum(sizes) - sizes
        codes = words.indices.to_numpy()
        counts = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(counts)])
        out = ids[np.repeat(begins[codes] - ends[:-1], counts) + np.arange(ends[-1])]
        places = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])]
        for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
            yield np.concatenate([out[a:b], last])


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


SHARD = "part int, seq int, n_docs bigint, n_tokens bigint, payload binary"


def write_shards(docs: DataFrame, vocabulary: str, end_id: int, path: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` in ascending ``doc_id`` order and write one wavelet file per shard under ``path``.

    Rows are dealt by ranges of the id, so no task sees more than its range.
    A document lies in one shard; a shard ends with the document that reaches
    ``shard_tokens``. Null ids come first, a null text has only the end id, and
    rows with the same id follow each other ordered by text. Spark writes the
    files, one row each, so a lost task leaves nothing behind. The vocabulary
    file must lie at its path on every executor; its ids must fit 16 bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool, end = word_bpe(vocabulary), np.array([end_id], dtype="<u2").tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "seq": pa.array([seq], pa.int32()),
                    "n_docs": pa.array([len(ids)], pa.int64()),
                    "n_tokens": pa.array([sum(map(len, ids))], pa.int64()),
                    "payload": pa.array([WaveletShard.build(doc_ids, ids)], pa.binary()),
                }
            )

        total = 0
        for batch in batches:
            for part_ in slices(batch, "text", TEXTS):
                for doc, x in zip(part_.column("doc_id").to_pylist(), tool.encode_batch(part_.column("text"), end)):
                    doc_ids.append(doc)
                    ids.append(x)
                    total += len(x)
                    if total >= shard_tokens:
                        yield shard()
                        doc_ids, ids, total, seq = [], [], 0, seq + 1
        if ids:
            yield shard()

    ranged = docs.select("doc_id", text_of().alias("text")).repartitionByRange("doc_id")
    shards = ranged.sortWithinPartitions("doc_id", "text").mapInArrow(run, SHARD)
    options = {"maxRecordsPerFile": 1, "compression": "uncompressed", "parquet.enable.dictionary": "false"}
    shards.write.options(**options).parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """``part, seq, before``: ids in all earlier shards, from totals per part and places inside each."""
    sizes = shards.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inner = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)).alias("inside"))
    return inside.join(F.broadcast(parts), "part").select("part", "seq", (F.col("start") + F.col("inside")).alias("before"))


def documents_of(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read back from the files, ``start`` over all shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard = WaveletShard(batch.column("payload")[k].as_py())
                starts, ids = shard.starts(), shard.tokens().astype("<u4")
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                n = shard.docs
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([batch.column("part")[k].as_py()] * n, pa.int32()),
                        "seq": pa.array([batch.column("seq")[k].as_py()] * n, pa.int32()),
                        "doc_id": pa.array(shard.doc_ids(), pa.int64()),
                        "place": pa.array(starts[:-1], pa.int64()),
                        "n_tokens": pa.array(np.diff(starts), pa.int64()),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    kind = "part int, seq int, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint"
    rows = shards.select("part", "seq", "payload").mapInArrow(run, kind)
    return rows.join(broadcast_checked(shard_starts(shards)), ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_counts(shards: DataFrame, tokens: Sequence[int]) -> DataFrame:
    """``part, seq, token, n``: counted in the files, no id is decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = WaveletShard(row["payload"])
                found = [(row["part"], row["seq"], t, shard.count(t)) for t in tokens]
                names = ("part", "seq", "token", "n")
                yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in found])

    return shards.select("part", "seq", "payload").mapInArrow(run, "part long, seq long, token long, n long")


def wavelet_report(docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """Write all shards to the shared folder, read them back: one row per document."""
    spark = docs.sparkSession
    path = folder(spark, "wavelet-shards")
    write_shards(docs, vocabulary, end_id, path)
    return documents_of(read_shards(spark, path))
