"""Alignment of two tokenizers over a corpus, each distinct text once.

Documents are shuffled by their full text (combined map-side, so that a text that a third
of all documents share is one row per task), and every distinct text is encoded and
aligned once. Positions where tokens of both sides end cut the tokens into groups; all
tokens of a group are linked. The number of documents that hold a linked pair is the sum
over distinct texts of their multiplicity, and what a text measures is joined back to its
documents by the text's SHA-256.

A text is cut at single blanks between words where neither tokenizer reaches across, and
a worker keeps what it has aligned per cut; tokenizers of another kind get whole texts.

Counts of pairs reach the texts in two ways: the most frequent pairs, as many as a fixed
limit takes, are broadcast as one sorted array; what a text holds beyond these are rare
pairs, which are joined by shuffle.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curbair.llm.common import pack, pack_sorted, slices, summed, unpack, unpack_sorted
from curbair.operators.joins import fits_broadcast, lookup_join
from curbair.sources.staging import discard, staged

MARK = "▁"
#: Cuts whose alignment a worker remembers, and characters encoded in one call.
REMEMBERED, CALL_CHARS = 250_000, 1 << 19
#: Bytes of text that a task holds as objects.
TEXT_BYTES = 1 << 20
#: Distinct pairs a task counts before it hands its counts on.
TASK_PAIRS = 2_000_000
#: Pairs whose counts are broadcast, at 17 bytes each; the rest is joined by shuffle.
FREQUENT = 2_000_000
#: Measures of texts up to this size are broadcast to their documents.
SMALL_BYTES = 8 << 20

_CUT = re.compile(r"(?<=\S) (?=\S)")
MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def _byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand
    for themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Two tokenizers and what they make of the cuts seen so far.

    ``a`` is a byte-level tokenizers file, ``b`` a SentencePiece model.
    """

    def __init__(self, a_path: str, b_path: str, remembered: int = REMEMBERED):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as schema
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(a_path)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(b_path, "rb") as file:
            model = schema.ModelProto.FromString(file.read())
        kind = schema.ModelProto.SentencePiece
        self._b_bytes = [bytes([int(p.piece[1:-1], 16)]) if p.type == kind.BYTE
                         else p.piece.replace(MARK, " ").encode() for p in model.pieces]
        alphabet = _byte_alphabet()
        added = self._a.get_added_tokens_decoder()
        vocabulary = self._a.get_vocab(with_added_tokens=True)
        self._a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self._a_bytes[i] = token.encode() if i in added else bytes(alphabet[c] for c in token)
        self._a_length, self._b_length = (np.array(list(map(len, t)), np.int64) for t in (self._a_bytes, self._b_bytes))
        self.width = len(self._b_bytes)

        with open(a_path, encoding="utf-8") as file:
            layout = json.load(file)
        before = layout["pre_tokenizer"] or {}
        spec = model.normalizer_spec
        self._independent = (
            layout["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and spec.name == "identity" and not spec.precompiled_charsmap and not spec.remove_extra_whitespaces
            and not model.trainer_spec.treat_whitespace_as_suffix
            and not any(MARK in p.piece.lstrip(MARK) for p in model.pieces))
        self._remembered = remembered
        self._clear()

    def _clear(self) -> None:
        self._index: dict[str, int] = {}
        self._fragments: list[str] = []
        self._measures = np.zeros((0, len(MEASURES)), np.int64)
        self._sound = np.zeros(0, bool)
        self._first = self._number = np.zeros(0, np.int64)  # of each cut's pairs
        self._codes, self._times = np.empty((2, 1 << 16), np.int64)
        self._used = 0

    def cuts(self, text: str) -> list[str]:
        """Parts of a text that get the same tokens alone, each with a blank in front."""
        return _CUT.split(text) if self._independent else [text]

    def _encoded(self, text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        """Ids of both sides and whether their bytes are those of the text."""
        a = self._a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self._b.encode(text, num_threads=1)
        whole = b" " + text.encode()
        sound = (b"".join(map(self._a_bytes.__getitem__, a)) == whole
                 and b"".join(map(self._b_bytes.__getitem__, b)) == whole)
        return np.array(a, np.int64), np.array(b, np.int64), sound

    def _learn(self, new: list[str]) -> None:
        """Align cuts that were not seen before. Those that begin and end with a word are
        encoded together, joined by blanks; the few others one by one."""
        joined, size = [], 0
        for part in new:
            whole = self._independent and part and not part[0].isspace() and not part[-1].isspace()
            if joined and (not whole or size > CALL_CHARS):
                self._add(joined)
                joined, size = [], 0
            if whole:
                joined.append(part)
                size += len(part) + 1
            else:
                self._add([part])
        if joined:
            self._add(joined)

    def _add(self, parts: list[str]) -> None:
        text = " ".join(parts)
        a, b, sound = self._encoded(text)
        ends_a, ends_b = np.cumsum(self._a_length[a]), np.cumsum(self._b_length[b])
        stops = np.cumsum([len(p.encode()) + 1 for p in parts])
        if not sound or not len(a):
            if len(parts) > 1:  # some part does not keep its bytes: find out which
                for part in parts:
                    self._add([part])
                return
            self._append([""], np.zeros((1, len(MEASURES)), np.int64), False, a[:0], a[:0], np.zeros(1, np.int64))
            return
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        part_of = np.searchsorted(stops, common)
        if not np.isin(stops, common).all():
            raise RuntimeError("a token reaches across a cut")
        size_a, size_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        measures = np.zeros((len(parts), len(MEASURES)), np.int64)
        for column, values in enumerate((size_a, size_b, np.ones_like(size_a), size_a * size_b)):
            np.add.at(measures[:, column], part_of, values)

        ids_a, ids_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        at_a, at_b = np.cumsum(size_a).tolist(), np.cumsum(size_b).tolist()
        written = [f"{','.join(ids_a[i:j])}|{','.join(ids_b[k:n])}"
                   for i, j, k, n in zip([0, *at_a], at_a, [0, *at_b], at_b, strict=False)]
        last = np.cumsum(np.bincount(part_of, minlength=len(parts))).tolist()
        fragments = [";".join(written[i:j]) for i, j in zip([0, *last], last, strict=False)]

        # within a group, distinct ids of one side meet those of the other once, with the
        # number of occurrences that stand for them
        keys_a, times_a = summed(group_a * len(self._a_bytes) + a, np.ones_like(a))
        keys_b, times_b = summed(group_b * self.width + b, np.ones_like(b))
        of_a, id_a = np.divmod(keys_a, len(self._a_bytes))
        of_b, id_b = np.divmod(keys_b, self.width)
        number_b = np.bincount(of_b, minlength=len(common))
        first_b = np.cumsum(number_b) - number_b
        meets = number_b[of_a]
        left = np.repeat(np.arange(len(of_a)), meets)
        right = first_b[of_a[left]] + np.arange(len(left)) - np.repeat(np.cumsum(meets) - meets, meets)
        numbers = np.bincount(part_of[of_a[left]], minlength=len(parts))
        self._append(fragments, measures, True, id_a[left] * self.width + id_b[right],
                     times_a[left] * times_b[right], numbers)

    def _append(self, fragments, measures, sound: bool, codes, times, numbers) -> None:
        end = self._used + len(codes)
        if end > len(self._codes):
            more = np.empty((2, 2 * end - self._used), np.int64)
            self._codes = np.concatenate([self._codes[: self._used], more[0]])
            self._times = np.concatenate([self._times[: self._used], more[1]])
        self._codes[self._used : end], self._times[self._used : end] = codes, times
        self._pending.append((fragments, measures, np.full(len(fragments), sound),
                              self._used + np.cumsum(numbers) - numbers, numbers))
        self._used = end

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Measures and groups of each text, then the distinct pairs of every text: the
        text's number, the pair's code (a's id times ``width`` plus b's) and its links.

        A text that one side cannot give back has zeros, no groups and no pairs.
        """
        if len(self._index) > self._remembered or self._used > 16 * self._remembered:
            self._clear()
        cut = [self.cuts(t) if t else [] for t in texts]
        new = list(dict.fromkeys(p for parts in cut for p in parts if p not in self._index))
        if new:
            self._pending: list = []
            ordered = sorted(new, key=lambda p: p[:1].isspace() or p[-1:].isspace())  # the joined ones first
            self._learn(ordered)
            for part in ordered:
                self._index[part] = len(self._index)
            fragments, measures, sound, first, number = zip(*self._pending, strict=True)
            for part in fragments:
                self._fragments += part
            self._measures = np.concatenate([self._measures, *measures])
            self._sound = np.concatenate([self._sound, *sound])
            self._first = np.concatenate([self._first, *first])
            self._number = np.concatenate([self._number, *number])
        look, write = self._index.__getitem__, self._fragments.__getitem__
        measured = np.zeros((len(texts), len(MEASURES)), np.int64)
        groups, used, owner = [""] * len(texts), [], []
        for i, parts in enumerate(cut):
            listed = list(map(look, parts))
            at = np.array(listed, np.int64)
            if not len(at) or not self._sound[at].all():
                continue
            measured[i] = self._measures[at].sum(axis=0)
            groups[i] = ";".join(map(write, listed))
            used.append(at)
            owner.append(np.full(len(at), i))
        if not used:
            return measured, groups, *(np.empty((3, 0), np.int64))
        at, owner = np.concatenate(used), np.concatenate(owner)
        number = self._number[at]
        ends = np.cumsum(number)
        place = np.arange(ends[-1]) + np.repeat(self._first[at] - (ends - number), number)
        span = len(self._a_bytes) * self.width
        keys, times = summed(np.repeat(owner, number) * span + self._codes[place], self._times[place])
        owner, codes = np.divmod(keys, span)
        return measured, groups, owner, codes, times


_LOADED: dict[tuple, Aligner] = {}


def _aligner(a_path: str, b_path: str) -> Aligner:
    """A worker's aligner, kept from task to task."""
    if (a_path, b_path) not in _LOADED:
        _LOADED.clear()
        _LOADED[a_path, b_path] = Aligner(a_path, b_path)
    return _LOADED[a_path, b_path]


_ALIGNED = pa.schema([("key", pa.binary()), ("copies", pa.int64()), *[(m, pa.int64()) for m in MEASURES],
                      ("groups_sha256", pa.string()), ("codes", pa.binary()), ("times", pa.binary())])
_ALIGNED_DDL = (f"key binary, copies long, {', '.join(f'{m} long' for m in MEASURES)}, groups_sha256 string, "
                "codes binary, times binary")


def _align_pass(a_path: str, b_path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_path, b_path)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def counts() -> pa.RecordBatch:
            codes, documents = held.pop()
            return pa.RecordBatch.from_pylist([{"codes": pack_sorted(codes), "times": pack(documents)}], _ALIGNED)

        for part in slices(batches, "text", TEXT_BYTES):
            texts = part.column("text").to_pylist()
            copies = part.column("copies").to_numpy()
            measured, groups, owner, codes, times = aligner.align(texts)
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
            yield pa.RecordBatch.from_arrays([
                part.column("key"), part.column("copies"), *[pa.array(measured[:, i]) for i in range(len(MEASURES))],
                pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]),
                pa.array([pack_sorted(codes[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                pa.array([pack(times[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
            ], schema=_ALIGNED)
            held.append(summed(codes, copies[owner]))
            # merge neighbours of like size, so that each count is merged a few times only
            while len(held) > 1 and len(held[-2][0]) < 2 * len(held[-1][0]):
                x, y = held.pop(), held.pop()
                held.append(summed(np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]])))
            if len(held[-1][0]) > TASK_PAIRS:
                yield counts()
        while held:
            while len(held) > 1:
                x, y = held.pop(), held.pop()
                held.append(summed(np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]])))
            yield counts()

    return run


def aligned_texts(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """One row per distinct text, staged: ``key`` (SHA-256 of the text), ``copies``, the
    measures, ``groups_sha256``, and its distinct pairs packed in ``codes`` and ``times``.

    Rows without a key hold what a task has counted: pairs and the number of documents.
    NULL and empty texts have no row; an empty table gives an empty table.
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter("text != ''")
    distinct = texts.groupBy("text").agg(F.count(F.lit(1)).alias("copies")).select(
        F.unhex(F.sha2("text", 256)).alias("key"), "copies", "text")
    return staged(distinct.mapInArrow(_align_pass(a_path, b_path), _ALIGNED_DDL), "aligned")


_PAIRS = pa.schema([("code", pa.int64()), ("documents", pa.int64())])


def _opened(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for codes, times in zip(batch.column("codes"), batch.column("times"), strict=True):
            codes, times = unpack_sorted(codes.as_py()), unpack(times.as_py())
            for i in range(0, len(codes), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes[i : i + (1 << 16)]), pa.array(times[i : i + (1 << 16)])], schema=_PAIRS)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(code, a, b, documents, best): in how many documents each pair is linked, and
    whether no other pair of its ``a`` is in more. Staged."""
    counted = staged(
        aligned.filter("key is null").select("codes", "times").mapInArrow(_opened, "code long, documents long")
        .groupBy("code").agg(F.sum("documents").alias("documents"))
        .select("code", F.expr(f"code div {width}").alias("a"), (F.col("code") % width).alias("b"), "documents"), "pairs")
    # one row per id of the vocabulary
    top = counted.groupBy(F.col("a").alias("of")).agg(F.max("documents").alias("top"))
    top = F.broadcast(top) if fits_broadcast(top) else top
    return staged(counted.join(top, F.col("a") == F.col("of")).select(
        "code", "a", "b", "documents", (F.col("documents") == F.col("top")).alias("best")), "pair-counts")


def _least_frequent(counts: DataFrame, limit: int) -> int:
    """The smallest power of two that at most ``limit`` pairs reach in documents."""
    sizes = counts.groupBy(F.floor(F.log2("documents")).cast("int").alias("power")).count().collect()  # 64 rows at most
    left, least = limit, 64
    for power, n in sorted(((r[0], r[1]) for r in sizes), reverse=True):
        left -= n
        if left < 0:
            break
        least = power
    return least


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            columns = [pack(batch.column(c).to_numpy().astype(np.int64)) for c in ("code", "documents", "best")]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=["c", "d", "b"])


def _frequent(counts: DataFrame, power: int):
    """Codes, documents and best of the pairs in at least 2 ** ``power`` documents, one
    sorted array each; no more than ``_least_frequent`` was given as limit."""
    rows = counts.filter(F.floor(F.log2("documents")) >= power).select("code", "documents", F.col("best").cast("int"))
    parts = rows.mapInArrow(_packed, "c binary, d binary, b binary").collect()
    codes, documents, best = ([unpack(r[i]) for r in parts] or [np.empty(0, np.int64)] for i in range(3))
    codes, documents, best = map(np.concatenate, (codes, documents, best))
    order = np.argsort(codes)
    return codes[order], documents[order], best[order].astype(bool)


_SUMS = pa.schema([("key", pa.binary()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("code", pa.int64()),
                   ("times", pa.int64())])


def _measure_pass(table):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, documents, best = table.value
        for part in slices(batches, "codes", TEXT_BYTES):
            names = part.column("key").to_pylist()
            codes = [unpack_sorted(v) for v in part.column("codes").to_pylist()]
            times = np.concatenate([unpack(v) for v in part.column("times").to_pylist()])
            owner = np.repeat(np.arange(len(codes)), list(map(len, codes)))
            codes = np.concatenate(codes)
            at = np.searchsorted(known, codes)
            at[at == len(known)] = 0
            found = known[at] == codes if len(known) else np.zeros(len(codes), bool)
            at = at[found]
            sums = np.zeros((2, len(names)), np.int64)
            if len(at):
                np.add.at(sums[0], owner[found], times[found] * best[at])
                np.add.at(sums[1], owner[found], times[found] * documents[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(sums[0]), pa.array(sums[1]),
                 pa.nulls(len(names), pa.int64()), pa.nulls(len(names), pa.int64())], schema=_SUMS)
            if not found.all():
                rare = ~found
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i in owner[rare].tolist()], pa.binary()),
                     pa.nulls(int(rare.sum()), pa.int64()), pa.nulls(int(rare.sum()), pa.int64()),
                     pa.array(codes[rare]), pa.array(times[rare])], schema=_SUMS)

    return run


def text_measures(aligned: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """(key, n_best, count_sum) per distinct text; ``frequent`` only changes the work."""
    power = _least_frequent(counts, frequent)
    table = aligned.sparkSession.sparkContext.broadcast(_frequent(counts, power))
    sums = staged(aligned.filter("key is not null").select("key", "codes", "times").mapInArrow(
        _measure_pass(table), "key binary, n_best long, count_sum long, code long, times long"), "text-sums")
    # a pair met here is in fewer than 2 ** power documents, so no key of this join is hot
    # unless hardly any pair can be broadcast
    rare = sums.filter("code is not null").select("key", "code", "times").join(
        counts.filter(F.floor(F.log2("documents")) < power).select("code", "documents", "best"), "code").select(
        "key", (F.col("times") * F.col("best").cast("long")).alias("n_best"),
        (F.col("times") * F.col("documents")).alias("count_sum"))
    return sums.filter("code is null").select("key", "n_best", "count_sum").unionByName(rare).groupBy("key").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignments(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """Per document: its id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``a_path`` is a byte-level tokenizers file, ``b_path`` a SentencePiece model, readable
    at these paths on every executor. ``n_best`` counts links whose pair is in the most
    documents of all pairs of its ``a`` (ties included), ``count_sum`` sums the documents
    of all links. A text that is NULL, empty or not given back by one side has no tokens:
    zeros and an empty digest. Repeated rows count as documents and give repeated results;
    a NULL id stays NULL; other columns are not read. An empty table gives an empty table.
    """
    aligned = aligned_texts(docs, a_path, b_path, text_col)
    counts = pair_counts(aligned, Aligner(a_path, b_path).width)
    sums = text_measures(aligned, counts, frequent)
    columns = [*MEASURES, "groups_sha256"]
    measures = staged(
        aligned.filter("key is not null").select("key", *columns).join(sums, "key", "left"), "text-measures")
    discard(aligned, counts)
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).select(
        "id", F.when(F.col("text") != "", F.unhex(F.sha2("text", 256))).alias("key"))
    joined = lookup_join(named, measures, ["key"], small=fits_broadcast(measures, SMALL_BYTES), computed=True)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return joined.select(
        F.col("id").alias(id_col), *map(zero, MEASURES), zero("n_best"), zero("count_sum"),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
