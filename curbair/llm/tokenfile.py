"""Token ids in binary files with Elias-Fano coded document boundaries.

A file holds the ids of consecutive documents in one array and two monotone sequences
in Elias-Fano form: where each document ends, and the document ids. A sequence of ``n``
values up to ``u`` takes about ``2 + log2(u / n)`` bits a value: the low bits as they
are, the high bits in unary, with a sample of every 256th one's position so that
``select`` reaches any value without a table of offsets.

Layout, little-endian: magic, id width in bytes, number of documents, documents without
an id, number of ids, then for the ends and the document ids the block of
``EliasFano.to_bytes``, then the ids.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from curbair.llm.common import slices
from curbair.llm.files import get, put, task_name
from curbair.llm.words import WordTable, cut_words
from curbair.sources.staging import fresh_path, staged

MAGIC = b"CBTOKEF1"
SAMPLE = 256
#: A file is closed once it holds this many ids; a longer document has one of its own.
FILE_IDS = 8 << 20
#: Documents of a file read before their rows are handed on.
READ = 4096
_HEAD = struct.Struct("<8sBxxxIIQ")
_EF = struct.Struct("<QqQBxxxI")


class EliasFano:
    """A non-decreasing sequence of integers in near-minimal space."""

    def __init__(self, n: int, base: int, top: int, low_bits: int, low: bytes, high: bytes, sample: np.ndarray):
        self.n, self.base, self.top, self.low_bits = n, base, top, low_bits
        self._low, self._high, self._sample = low, high, sample

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        if n == 0:
            return cls(0, 0, 0, 0, b"", b"", np.empty(0, np.uint32))
        if (np.diff(values) < 0).any():
            raise ValueError("the sequence decreases")
        base, top = int(values[0]), int(values[-1]) - int(values[0])
        gaps = (values.astype(np.int64) - base).astype(np.uint64)
        low_bits = max(0, (top // n).bit_length() - 1)
        low = np.zeros(n * low_bits, np.uint8).reshape(n, low_bits)
        for bit in range(low_bits):
            low[:, bit] = (gaps >> np.uint64(bit)) & np.uint64(1)
        ones = (gaps >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, np.uint8)
        high[ones] = 1
        return cls(n, base, top, low_bits, np.packbits(low, bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = _EF.pack(self.n, self.base, self.top, self.low_bits, len(self._high))
        return head + self._low + self._high + self._sample.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        n, base, top, low_bits, high = _EF.unpack_from(data, at)
        at += _EF.size
        low = -(-n * low_bits // 8)
        sample = np.frombuffer(data, np.uint32, -(-n // SAMPLE), at + low + high)
        parts = data[at : at + low], data[at + low : at + low + high]
        return cls(n, base, top, low_bits, *parts, sample), at + low + high + sample.nbytes

    def _low_of(self, i: int) -> int:
        first = i * self.low_bits
        chunk = int.from_bytes(self._low[first // 8 : (first + self.low_bits + 7) // 8], "little")
        return chunk >> (first % 8) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value: from the nearest sampled one, over the unary bits after it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        position, left = int(self._sample[i // SAMPLE]), i % SAMPLE
        byte = position // 8
        word = int.from_bytes(self._high[byte : byte + 8], "little") >> position % 8 << position % 8
        while (ones := word.bit_count()) <= left:
            left, byte = left - ones, byte + 8
            word = int.from_bytes(self._high[byte : byte + 8], "little")
        position = byte * 8
        for half in (32, 16, 8):  # which half of the word holds it
            ones = (low := word & (1 << half) - 1).bit_count()
            if ones <= left:
                left, word, position = left - ones, word >> half, position + half
            else:
                word = low
        for _ in range(left):
            word &= word - 1
        position += (word & -word).bit_length() - 1
        return self.base + ((position - i) << self.low_bits | self._low_of(i))

    def values(self) -> np.ndarray:
        """The whole sequence."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self._high, np.uint8), bitorder="little"))
        out = (ones - np.arange(self.n)) << self.low_bits
        if self.low_bits:
            bits = np.unpackbits(np.frombuffer(self._low, np.uint8), count=self.n * self.low_bits, bitorder="little")
            for bit, column in enumerate(bits.reshape(self.n, self.low_bits).T):
                out |= column.astype(np.int64) << bit
        return out + self.base


def pack(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One file. Documents are in ascending order of their ids, those without one first."""
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    missing = sum(d is None for d in doc_ids)
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    return b"".join([
        _HEAD.pack(MAGIC, width, len(doc_ids), missing, len(ids)),
        EliasFano.of(np.cumsum(lengths, dtype=np.int64)).to_bytes(), EliasFano.of(known).to_bytes(),
        ids.astype(f"<u{width}").tobytes()])


class TokenFile:
    """A packed file: its documents by position, without decoding the others."""

    def __init__(self, data: bytes):
        magic, self.width, self.documents, self.missing, self.tokens = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.ends, at = EliasFano.from_bytes(data, _HEAD.size)
        self.names, at = EliasFano.from_bytes(data, at)
        self.ids = np.frombuffer(data, f"<u{self.width}", self.tokens, at)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.missing else self.names.select(i - self.missing)

    def span(self, i: int) -> tuple[int, int]:
        return self.ends.select(i - 1) if i else 0, self.ends.select(i)

    def document(self, i: int) -> np.ndarray:
        return self.ids[slice(*self.span(i))]


# fixed values: the words of a tokenizer whose ids are those of its words
_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]


def check_tokenizer(path: str) -> None:
    """Raise unless the tokenizer gives a text the ids of its words one after the other.

    Words are cut at blanks and before punctuation (``words.cut_words``), so blanks must
    be dropped, no token may hold a letter or digit in front of punctuation, and nothing
    but these normalizers may change a text before it is cut. An added token must begin
    with ``<|`` and hold no blank.
    """
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)

    def listed(part: dict | None, name: str) -> list[dict]:
        return [] if part is None else part[name] if part["type"] == "Sequence" else [part]

    cutters = listed(rules.get("pre_tokenizer"), "pretokenizers")
    split = cutters[0] if cutters else {}
    ok = (split.get("type") == "Split" and split["pattern"] == {"Regex": _WORDS}
          and (split["behavior"], split["invert"]) == ("Removed", True)
          and all(c["type"] == "ByteLevel" and not c["add_prefix_space"] and not c["use_regex"] for c in cutters[1:])
          and all(n in _NORMALIZERS for n in listed(rules.get("normalizer"), "normalizers"))
          and all(a["content"].startswith("<|") and not any(map(str.isspace, a["content"])) and not a["normalized"]
                  for a in rules.get("added_tokens") or ()))
    if not ok:
        raise ValueError(f"{path}: its ids of a text are not those of its words one after the other")


def library_encoder(path: str) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    """Ids of words by the tokenizers library, many to a call, told apart by offsets."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text = b" ".join(words).decode("utf-8", "surrogatepass")
        blank = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 32
        got = tokenizer.encode(text, add_special_tokens=False)
        # the word a token is of: the number of blanks before its first character
        word = np.cumsum(blank)[[first for first, _ in got.offsets]] if len(got) else np.empty(0, np.int64)
        return np.array(got.ids, np.uint32), np.bincount(word, minlength=len(words))

    return encode


_MANIFEST = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("uri", pa.string()),
                       ("documents", pa.int64()), ("tokens", pa.int64())])


def _write(folder: str, tokenizer: str, end_id: int, file_ids: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(library_encoder(tokenizer))
        part, number = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            uri = f"{folder}/{task_name('ids', number, '.bin')}"
            put(uri, pack(names, np.concatenate(lengths), np.concatenate(ids)))
            return pa.RecordBatch.from_pylist(
                [{"part": part, "number": number, "uri": uri, "documents": len(names), "tokens": held}], _MANIFEST)

        for batch in slices(batches, "text"):
            flat, counts = table.ids(cut_words(batch.column("text").to_pylist()))
            ends = np.cumsum(counts)
            flat, counts = np.insert(flat, ends, end_id), counts + 1
            ends = np.cumsum(counts)
            docs, first, taken = batch.column("doc_id").to_pylist(), 0, 0
            while first < len(docs):  # as many documents as the file still takes, one at least
                last = max(first + 1, int(np.searchsorted(ends, taken + file_ids - held, side="right")))
                names += docs[first:last]
                lengths.append(counts[first:last])
                ids.append(flat[taken : ends[last - 1]])
                held += int(ends[last - 1]) - taken
                first, taken = last, int(ends[last - 1])
                if held >= file_ids or first < len(docs):
                    yield close()
                    number, names, lengths, ids, held = number + 1, [], [], [], 0
        if names:
            yield close()

    return run


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 1, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode every whole text, end it with ``end_id`` and write files below ``folder``.

    Files follow ascending document ids over partitions and numbers. Returns the
    manifest (part, number, uri, documents, tokens). A NULL text is empty: its document
    is the end id alone. NULL ids come first, repeated ids next to each other (their
    order is by text). An empty table writes no file; other columns are not read. A
    tokenizer that words alone do not determine the ids of raises ``ValueError``.
    """
    check_tokenizer(tokenizer)
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # texts with one id can still be cut apart between partitions
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text"]
    ordered = rows.repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order)
    return staged(ordered.mapInArrow(
        _write(folder, tokenizer, end_id, file_ids),
        "part int, number int, uri string, documents long, tokens long"), "token-manifest")


_ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                   ("ids_crc32", pa.int64())])


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, offset in zip(batch.column("uri").to_pylist(), batch.column("offset").to_pylist(), strict=True):
            held = TokenFile(get(uri))
            start = 0
            for first in range(0, held.documents, READ):
                rows: list[tuple] = []
                for i in range(first, min(first + READ, held.documents)):
                    end = held.ends.select(i)  # and the next one's start
                    rows.append((held.doc_id(i), start + offset, end - start,
                                 zlib.crc32(held.ids[start:end].astype("<u4").tobytes())))
                    start = end
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ROWS, strict=True)], schema=_ROWS)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it),
    n_tokens and the crc32 of its ids as 32-bit integers."""
    from pyspark.sql import Window

    # one row per partition of the writer: bounded by its number of tasks
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("sum"))
    before = parts.withColumn("before", F.sum("sum").over(Window.orderBy("part")) - F.col("sum")).select("part", "before")
    inside = Window.partitionBy("part").orderBy("number")
    files = manifest.withColumn("inside", F.sum("tokens").over(inside) - F.col("tokens")).join(before, "part").select(
        "uri", (F.col("before") + F.col("inside")).alias("offset"))
    spread = files.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "uri")
    return spread.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, **settings) -> DataFrame:
    """Write the files below the shared folder and read them back."""
    return read_token_files(write_token_files(docs, fresh_path(docs.sparkSession, "ids"), tokenizer, **settings))
